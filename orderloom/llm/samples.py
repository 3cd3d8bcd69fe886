"""Bounded samples of labelled rows, and calibration of scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import staged

SLOTS = 1 << 20


def fold(doc_id: str | Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def known_labels(labels: DataFrame, label: str, eligible: Column) -> DataFrame:
    """(doc_id, label) of every eligible id.  Labels other than 0 and 1 and null ids are
    passed over; an id with both labels counts as 1."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & eligible)
    return staged(known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")), "labels")


def sampled(known: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, float]]:
    """About `per_class` ids of each class at most of known labels, chosen by a hash of the
    id, and for each class how many labelled ids a chosen one stands for."""
    n = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = {c: min(1.0, per_class / n[c]) for c in n}
    slot = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(SLOTS))
    chosen = [(F.col("label") == c) & (slot < max(1, int(share[c] * SLOTS))) for c in n]
    keep = chosen[0] if chosen else F.lit(False)
    for more in chosen[1:]:
        keep = keep | more
    return staged(known.filter(keep), "sample"), {c: 1 / share[c] for c in n}


def labelled_sample(labels: DataFrame, label: str, eligible: Column, per_class: int) -> tuple[DataFrame, dict[int, float]]:
    """A sample of the eligible ids, as `sampled` has it."""
    return sampled(known_labels(labels, label, eligible), per_class)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def temperature(logits: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(scale, shift) of logits under which the weighted log loss is least."""
    scale, shift = 1.0, 0.0
    if len(set(truth.tolist())) < 2:
        return scale, shift
    # Soft targets keep the scale finite where a threshold parts the classes.
    n1, n0 = weight[truth == 1].sum(), weight[truth == 0].sum()
    soft = np.where(truth == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(100):
        p = sigmoid(scale * logits + shift)
        error, curve = weight * (p - soft), weight * p * (1 - p)
        gradient = np.array([(error * logits).sum() + 1e-3 * (scale - 1), error.sum() + 1e-3 * shift])
        hessian = np.array(
            [[(curve * logits**2).sum() + 1e-3, (curve * logits).sum()], [(curve * logits).sum(), curve.sum() + 1e-3]]
        )
        step = np.linalg.solve(hessian + 1e-9 * np.eye(2), gradient)
        step = np.clip(step, -1, 1)
        scale, shift = max(1e-3, scale - step[0]), shift - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(scale), float(shift)


class Adam:
    """Adaptive steps for a dictionary of arrays."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.t = weights, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in gradients.items():
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.001 * (g * g - self.second[k])
            first, second = self.first[k] / (1 - 0.9**self.t), self.second[k] / (1 - 0.999**self.t)
            self.weights[k] -= self.rate * first / (np.sqrt(second) + 1e-8)
