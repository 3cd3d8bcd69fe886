"""Toxicity by a convolutional text classifier in numpy.

Words are hashed into embeddings: a word's is the sum of three, of the word and of its
first 5 and 7 bytes, so forms of a stem share what is learned.  Filters over 1, 2 and
3 words run over the whole text; each keeps its maximum, and a logistic layer turns
these into a logit.  It is trained on a bounded sample of labelled texts.  Then every
text is scored once.  The logits of all other labelled texts calibrate it, by counts for
each language, with the classes weighed as they are among all labels.  For each language, a
threshold on the calibrated score is set from these counts too, wherever it falls.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import words as W
from .samples import Adam, fold, known_labels, sampled, sigmoid, temperature
from .scratch import staged

ROWS = 1 << 15
SIZE = 16
FILTERS = 16
WIDTHS = (1, 2, 3)
PREFIXES = (5, 7)
PAD = ROWS
# The sample to learn from: about so many ids of each class, and of their texts those
# of at most so many words.
PER_CLASS = 4000
SAMPLE_WORDS = 4096
SCORE_BYTES = 1 << 18
# Logits are counted in steps of so much, within a range, each with its mean.
LOGIT_STEP = 1 / 256
LOGIT_RANGE = 32
THRESHOLD = 0.7
FEWEST = 20
# What recall counts against precision where thresholds are set: clean texts should stay.
BETA = 0.5


class Net(NamedTuple):
    """embed: ROWS + 1 rows, the last for padding; filters and offsets by width; then the
    logistic layer; scale and shift calibrate its logits."""

    embed: np.ndarray
    filters: dict[int, np.ndarray]
    offsets: dict[int, np.ndarray]
    out: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0


def word_ids(texts: pa.Array, limit: int = W.CHUNK_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of rows: rows, three embedding rows of each word, and each text's bounds."""
    for rows, buffer, bounds in W.chunks(texts, limit):
        lower = W.LOWER[buffer]
        words = W.runs(W.ALNUM[lower], bounds)
        prefix = W.Prefix(W.BYTE_VALUES[lower])
        ends = [words.end] + [np.minimum(words.start + n, words.end) for n in PREFIXES]
        ids = [(W.mix(prefix.ranges(words.start, end), i) >> np.uint64(64 - 15)).astype(np.int32) for i, end in enumerate(ends)]
        yield rows, np.column_stack(ids).reshape(-1, len(ends)), words.first


def padded(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids with padding, so that no filter spans two texts and each has a place:
    ids, and the start and end of each text's places."""
    gap = max(WIDTHS)
    counts = np.diff(first)
    start = first[:-1] + gap * np.arange(len(counts))
    out = np.full((int(first[-1]) + gap * len(counts) + gap, ids.shape[1]), PAD, dtype=np.int32)
    where = np.arange(len(ids)) + np.repeat(start + 1 - first[:-1], counts)
    out[where] = ids
    return out, start, start + 1 + counts


def convolve(net: Net, ids: np.ndarray, width: int, x: np.ndarray) -> np.ndarray:
    """The response of each filter of a width at each place."""
    n = len(ids) - width + 1
    total = x[:n] @ net.filters[width][0]
    for j in range(1, width):
        total += x[j : n + j] @ net.filters[width][j]
    return total + net.offsets[width]


def embed(net: Net, ids: np.ndarray) -> np.ndarray:
    x = net.embed[ids[:, 0]]
    for i in range(1, ids.shape[1]):
        x += net.embed[ids[:, i]]
    return x


def logits(net: Net, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The logit of each text."""
    ids, start, end = padded(ids, first)
    x, pairs = embed(net, ids), np.column_stack([start, end]).ravel()
    pooled = [np.maximum.reduceat(convolve(net, ids, w, x), pairs, axis=0)[::2] for w in WIDTHS]
    return np.maximum(np.concatenate(pooled, axis=1), 0) @ net.out + net.bias


def fresh(rng: np.random.Generator) -> Net:
    table = rng.normal(0, 0.1, (ROWS + 1, SIZE)).astype(np.float32)
    table[PAD] = 0
    filters = {w: rng.normal(0, 1 / np.sqrt(w * SIZE), (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS}
    offsets = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
    return Net(table, filters, offsets, rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32), 0.0)


def fit(ids: list[np.ndarray], truth: np.ndarray, epochs: int = 8, batch: int = 32, seed: int = 3) -> Net:
    """A net for texts given as word ids."""
    rng = np.random.default_rng(seed)
    net = fresh(rng)
    bias = np.zeros(1, np.float32)
    dense = {f"f{w}": net.filters[w] for w in WIDTHS} | {f"o{w}": net.offsets[w] for w in WIDTHS} | {"out": net.out, "bias": bias}
    adam, squares = Adam(dense, 0.005), np.full(ROWS + 1, 1e-4, np.float32)
    balance = np.where(truth == 1, 0.5 / max(1e-9, truth.mean()), 0.5 / max(1e-9, 1 - truth.mean()))
    for _ in range(epochs):
        order = rng.permutation(len(ids))
        for i in range(0, len(order), batch):
            own = order[i : i + batch]
            first = np.r_[0, np.cumsum([len(ids[d]) for d in own])]
            places, start, end = padded(np.concatenate([ids[d] for d in own]), first)
            x = embed(net, places)
            top, best = {}, {}
            for w in WIDTHS:
                response = convolve(net, places, w, x)
                best[w] = np.stack([a + response[a:b].argmax(axis=0) for a, b in zip(start, end)])
                top[w] = np.take_along_axis(response, best[w], axis=0)
            pooled = np.maximum(np.concatenate([top[w] for w in WIDTHS], axis=1), 0)
            error = (sigmoid(pooled @ net.out + bias) - truth[own]) * balance[own] / len(own)
            gradients = {"out": pooled.T @ error + 1e-4 * net.out, "bias": np.array([error.sum()])}
            back = error[:, None] * net.out[None, :] * (pooled > 0)
            rows, steps = [], []
            for k, w in enumerate(WIDTHS):
                g = back[:, k * FILTERS : (k + 1) * FILTERS].astype(np.float32)
                gradients[f"o{w}"] = g.sum(axis=0)
                change = np.zeros_like(net.filters[w])
                for j in range(w):
                    at = best[w] + j
                    change[j] = np.einsum("df,dfs->sf", g, x[at])
                    step = g[:, :, None] * net.filters[w][j].T[None]
                    for c in range(places.shape[1]):
                        rows.append(places[at, c].ravel())
                        steps.append(step.reshape(-1, SIZE))
                gradients[f"f{w}"] = change
            rows, where = np.unique(np.concatenate(rows), return_inverse=True)
            change = np.zeros((len(rows), SIZE), np.float32)
            np.add.at(change, where, np.concatenate(steps))
            change[rows == PAD] = 0
            squares[rows] += (change**2).mean(axis=1)
            net.embed[rows] -= 0.05 * change / np.sqrt(squares[rows])[:, None]
            adam.step({k: g.astype(np.float32) for k, g in gradients.items()})
    return net._replace(bias=float(bias[0]))


class Judge(NamedTuple):
    """A net, each language's threshold on scores, and the one for all others."""

    net: Net
    thresholds: dict[str, float]
    default: float


def set_threshold(raw: np.ndarray, truth: np.ndarray, cases: np.ndarray, weight: np.ndarray, default: float) -> float:
    """The middle of the range of logits that, as thresholds, have the best F measure, in
    which precision counts more (`BETA`); the default where there are too few cases of a
    class.  An entry stands for so many cases and has their weight."""
    if cases[truth == 1].sum() < FEWEST or cases[truth == 0].sum() < FEWEST:
        return default
    order = np.argsort(-raw, kind="stable")
    hits, false = np.cumsum((weight * truth)[order]), np.cumsum((weight * (1 - truth))[order])
    measure = (1 + BETA**2) * hits / (hits + false + BETA**2 * hits[-1])
    measure[:-1][raw[order][:-1] == raw[order][1:]] = -1
    i = int(measure.argmax())
    low = raw[order][i + 1] if i + 1 < len(raw) else raw[order][i]
    return float((raw[order][i] + low) / 2)


class Fit(NamedTuple):
    """A net, all known labels, the ids it was fitted on (None if it wasn't) and how many of
    each class they are."""

    net: Net
    known: DataFrame
    ids: DataFrame | None
    n: tuple[int, int]


def fitted(docs: DataFrame, labels: DataFrame, text: str, label: str, held_out: tuple[int, int]) -> Fit:
    """A net from labelled documents whose fold is not the one held out: about `PER_CLASS`
    labels of each class, and the texts of at most `SAMPLE_WORDS` words among theirs."""
    folds, out = held_out
    eligible = fold("doc_id", folds) != out
    known = known_labels(labels, label, eligible)
    chosen, _ = sampled(known, PER_CLASS)

    def ids_of(texts: pa.Array) -> pa.Array:
        found: list[bytes | None] = []
        for _, ids, first in word_ids(texts):
            found += [ids[a:b].astype(np.uint16).tobytes() if b - a <= SAMPLE_WORDS else None for a, b in zip(first[:-1], first[1:])]
        return pa.array(found, pa.binary())

    # Bounded by PER_CLASS; of an id's texts one is taken.
    texts = docs.filter(eligible).select("doc_id", F.col(text).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", F.arrow_udf(ids_of, "binary")("text").alias("ids"))
    found = staged(rows.filter("ids IS NOT NULL").dropDuplicates(["doc_id"]), "sample-ids").toPandas().sort_values("doc_id")
    truth = found["label"].to_numpy(dtype=int)
    if len(set(truth.tolist())) < 2:
        flat = fresh(np.random.default_rng(0))._replace(out=np.zeros(FILTERS * len(WIDTHS), np.float32))
        return Fit(flat, known, None, (0, 0))
    ids = [np.frombuffer(x, np.uint16).reshape(-1, 1 + len(PREFIXES)) for x in found["ids"]]
    part = np.random.default_rng(1).permutation(len(ids)) % 5 == 0
    net = fit([x for x, p in zip(ids, part) if not p], truth[~part])
    # Bounded by PER_CLASS, as the sample is.
    own = [(x,) for x in found["doc_id"][~part].tolist()]
    own = docs.sparkSession.createDataFrame(own, StructType([texts.schema["doc_id"]]))
    return Fit(net, known, own, tuple(int((truth[~part] == c).sum()) for c in (0, 1)))


def raw_logit(spark: SparkSession, net: Net, text: str | Column = "text") -> Column:
    """The logit of a text, before calibration.  Null and empty texts have that of no words."""
    shared = spark.sparkContext.broadcast(tuple(net))

    def raw(texts: pa.Array) -> pa.Array:
        net = Net(*shared.value)
        out = np.zeros(len(texts))
        for rows, ids, first in word_ids(texts, SCORE_BYTES):
            out[rows] = logits(net, ids, first)
        return pa.array(out)

    return F.arrow_udf(raw, "double")(text)


def logit_counts(rows: DataFrame, known: DataFrame, own: DataFrame):
    """For pandas: lang, raw (mean logit), n0 and n1 (cases of a class) of each step of the
    logits of all labelled rows of (doc_id, lang, raw) whose id is not among the net's own."""
    rows = rows.join(known, "doc_id").join(own, "doc_id", "left_anti")
    step = F.floor(F.greatest(F.least("raw", F.lit(LOGIT_RANGE)), F.lit(-LOGIT_RANGE)) / LOGIT_STEP).alias("step")
    classes = [F.count_if(F.col("label") == c).alias(f"n{c}") for c in (0, 1)]
    counts = rows.groupBy("lang", step).agg(F.avg("raw").alias("raw"), *classes)
    return counts.toPandas().sort_values(["lang", "step"])


def judged(found: Fit, rows: DataFrame) -> Judge:
    """The net calibrated, and thresholds set, by all labelled rows of (doc_id, lang, raw)
    that it was not fitted on.  Without labels of both classes every score is the same."""
    net = found.net
    if found.ids is None:
        return Judge(net, {}, THRESHOLD)
    counts = logit_counts(rows, found.known, found.ids)
    cases = np.concatenate([counts["n0"], counts["n1"]]).astype(float)
    raw, langs = np.tile(counts["raw"].to_numpy(), 2), np.tile(counts["lang"].to_numpy(dtype=object), 2)
    classes = np.repeat([0, 1], len(counts))
    raw, langs, classes, cases = raw[cases > 0], langs[cases > 0], classes[cases > 0], cases[cases > 0]
    weight = cases.copy()
    for c in (0, 1):
        weight[classes == c] *= 1 + found.n[c] / max(1, cases[classes == c].sum())
    scale, shift = temperature(raw, classes, weight)
    net = net._replace(scale=scale, shift=shift)

    def calibrated(at: float) -> float:
        return float(sigmoid(np.array(scale * at + shift)))

    default = set_threshold(raw, classes, cases, weight, np.nan)
    thresholds = {}
    for name in sorted({x for x in langs if x is not None}):
        own = langs == name
        thresholds[name] = set_threshold(raw[own], classes[own], cases[own], weight[own], default)
    return Judge(
        net,
        {name: THRESHOLD if np.isnan(at) else calibrated(at) for name, at in thresholds.items()},
        THRESHOLD if np.isnan(default) else calibrated(default),
    )


def learn(
    docs: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang", label: str = "toxic", held_out: tuple[int, int] = (3, 1)
) -> Judge:
    """A judge from labelled documents whose fold (of `held_out[0]`) is not `held_out[1]`.

    A bounded sample of their texts is learned from, but a fifth; this and all other
    labelled texts, of any length, calibrate and set the thresholds.
    """
    found = fitted(docs, labels, text, label, held_out)
    raw = raw_logit(docs.sparkSession, found.net, text).alias("raw")
    return judged(found, staged(docs.select("doc_id", F.col(lang).cast("string").alias("lang"), raw), "logits"))


def toxicity(spark: SparkSession, judge: Judge, text: str | Column = "text") -> Column:
    """The score of a text, 0 to 1.  Null and empty texts have the score of no words."""
    shared = spark.sparkContext.broadcast(tuple(judge.net))

    def score(texts: pa.Array) -> pa.Array:
        net = Net(*shared.value)
        out = np.zeros(len(texts))
        for rows, ids, first in word_ids(texts, SCORE_BYTES):
            out[rows] = sigmoid(net.scale * logits(net, ids, first) + net.shift)
        return pa.array(out)

    return F.arrow_udf(score, "double")(text)


def threshold(judge: Judge, lang: str | Column = "lang") -> Column:
    """The threshold of a row's language; null and unknown languages have the default."""
    pairs = [F.lit(x) for pair in judge.thresholds.items() for x in pair]
    column = F.col(lang) if isinstance(lang, str) else lang
    return F.coalesce(F.create_map(*pairs)[column], F.lit(judge.default)) if pairs else F.lit(judge.default)


def score_of(judge: Judge, raw: str) -> Column:
    """The score of a logit."""
    at = F.lit(judge.net.scale) * F.col(raw) + F.lit(judge.net.shift)
    return 1 / (1 + F.exp(-F.greatest(F.least(at, F.lit(60.0)), F.lit(-60.0))))


def scored(
    docs: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang", label: str = "toxic", held_out: tuple[int, int] = (3, 1)
) -> DataFrame:
    """One row per document: doc_id, score, predicted (1 from 0.7 on), threshold (of its
    language) and rejected (score at or above that).

    The language picks the threshold and nothing else; the score is of the text alone.
    Rows with null or repeated ids, texts or languages are scored like others; no rows
    give no rows; other columns are not read.
    """
    found = fitted(docs, labels, text, label, held_out)
    raw = raw_logit(docs.sparkSession, found.net, text).alias("raw")
    rows = staged(docs.select("doc_id", F.col(lang).cast("string").alias("lang"), raw), "logits")
    judge = judged(found, rows)
    rows = rows.select("doc_id", threshold(judge).alias("threshold"), score_of(judge, "raw").alias("score"))
    return rows.select(
        "doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "threshold",
        (F.col("score") >= F.col("threshold")).alias("rejected"),
    )


def clean_documents(
    docs: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang", label: str = "toxic", held_out: tuple[int, int] = (3, 1)
) -> DataFrame:
    """The documents that are not rejected; columns stay as they are."""
    found = fitted(docs, labels, text, label, held_out)
    held = docs.select(F.struct("*").alias("doc"), raw_logit(docs.sparkSession, found.net, text).alias("raw"))
    rows = staged(held, "logits")
    language = F.col("doc")[lang].cast("string")
    judge = judged(found, rows.select(F.col("doc")["doc_id"].alias("doc_id"), language.alias("lang"), "raw"))
    kept = rows.filter(score_of(judge, "raw") < threshold(judge, language))
    return kept.select(*[F.col("doc")[name].alias(name) for name in docs.columns])
