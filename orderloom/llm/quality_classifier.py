"""A quality classifier on random-indexing word vectors.

Every token has a sparse random index vector that its hash gives.  A token's word
vector is the sum of the index vectors of its neighbours, up to two places away,
over all documents: each task sums its own, and the sums are added up a tree.
Tokens are hashed into a fixed number of rows, with regions of their own for words,
words in capitals, and marks, so the table is bounded.

A document is its mean word vector, with how much neighbours and the whole text
resemble themselves.  A two-layer network in numpy gives a logit from that; its
temperature is set on a part of the labelled sample that it was not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .samples import Adam, fold, labelled_sample, sigmoid, temperature
from .scratch import staged

SIZE = 32
# Rows of words, words in capitals, and marks.
REGIONS = (1 << 14, 1 << 12, 1 << 12)
ROWS = sum(REGIONS)
REACH = 2
BLOCK = 1 << 11
# Sums that are added at a time, and levels of the tree: enough for 16 million tasks.
FAN_IN = 64
LEVELS = 4
PER_CLASS = 6000
HIDDEN = 32
THRESHOLD = 0.7
CAPITAL = W.byte_class((0x41, 0x5A))
SMALL = W.byte_class((0x61, 0x7A))


def tokens(buffer: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row of each token, its hash, and each text's bounds.  Tokens are runs of
    letters and digits, and runs of other characters but white space."""
    word, mark = W.ALNUM[buffer], W.NOT_SPACE[buffer] & ~W.ALNUM[buffer]
    prefix = W.Prefix(W.BYTE_VALUES[W.LOWER[buffer]])
    words, marks = W.runs(word, bounds), W.runs(mark, bounds)
    capitals = np.r_[0, np.cumsum(CAPITAL[buffer])]
    small = np.r_[0, np.cumsum(SMALL[buffer])]
    n_capitals = capitals[words.end] - capitals[words.start]
    loud = (n_capitals > 1) & (small[words.end] == small[words.start])
    start = np.concatenate([words.start, marks.start])
    hashes = np.concatenate([prefix.ranges(words.start, words.end), prefix.ranges(marks.start, marks.end)])
    kind = np.concatenate([loud.astype(np.int64), np.full(len(marks.start), 2)])
    order = np.argsort(start, kind="stable")
    hashes, kind = W.mix(hashes[order] ^ kind[order].astype(np.uint64)), kind[order]
    sizes, offsets = np.array(REGIONS, dtype=np.uint64), np.r_[0, np.cumsum(REGIONS)[:-1]]
    rows = (hashes % sizes[kind]).astype(np.int64) + offsets[kind]
    return rows, hashes, words.first + marks.first


def index_vectors(hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The places and signs of the two parts of each token's index vector."""
    parts = []
    for shift in (20, 40):
        bits = hashes >> np.uint64(shift)
        parts.append(((bits % np.uint64(SIZE)).astype(np.int64), 1 - 2 * ((bits >> np.uint64(10)) & np.uint64(1)).astype(np.int64)))
    return parts


def add_contexts(table: np.ndarray, rows: np.ndarray, hashes: np.ndarray, bounds: np.ndarray) -> None:
    """Adds every token's neighbours' index vectors to its row."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for place, sign in index_vectors(hashes):
        for step in range(1, REACH + 1):
            together = owner[step:] == owner[:-step]
            for a, b in ((slice(step, None), slice(None, -step)), (slice(None, -step), slice(step, None))):
                cells = rows[a][together] * SIZE + place[b][together]
                table += np.bincount(cells, weights=sign[b][together], minlength=len(table))


def context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow on texts: the task's table of context sums, in blocks of rows."""
    table = np.zeros(ROWS * SIZE)
    for batch in batches:
        for _, buffer, bounds in W.chunks(batch.column(0)):
            add_contexts(table, *tokens(buffer, bounds))
    blocks = table.astype(np.int64).reshape(-1, BLOCK * SIZE)
    some = np.flatnonzero(blocks.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(some), pa.array([TaskContext.get().partitionId()] * len(some), pa.int64()), pa.array([blocks[b].tobytes() for b in some], pa.binary())],
        names=["block", "part", "sums"],
    )


def add_blocks(table: pa.Table) -> pa.Table:
    total = np.zeros(BLOCK * SIZE, dtype=np.int64)
    for x in table["sums"]:
        total += np.frombuffer(x.as_py(), np.int64)
    return pa.table([table["block"][:1], table["part"][:1], pa.array([total.tobytes()], pa.binary())], names=["block", "part", "sums"])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The table of word vectors of all texts: unit length, with the common direction
    taken out.  Its size is fixed, ROWS x SIZE."""
    schema = "block long, part long, sums binary"
    sums = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(context_sums, schema)
    for _ in range(LEVELS):
        above = sums.withColumn("part", F.floor(F.col("part") / FAN_IN))
        sums = above.groupBy("block", "part").applyInArrow(add_blocks, schema)
    sums = staged(sums, "context-sums")
    table = np.zeros((ROWS // BLOCK, BLOCK * SIZE))
    for row in sums.collect():  # a block each
        table[row["block"]] += np.frombuffer(row["sums"], np.int64)
    table = unit(table.reshape(ROWS, SIZE))
    return unit(table - table.mean(axis=0)).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def pooled(vectors: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Each document's features: its mean word vector; the length of that, and of the
    mean index vector; how alike neighbours are; the shares of the three regions; the
    logarithm of its length."""
    out = np.zeros((len(texts), features()))
    ends = np.cumsum(REGIONS)
    for at, buffer, bounds in W.chunks(texts):
        rows, hashes, first = tokens(buffer, bounds)
        n = np.diff(first)
        some = np.flatnonzero(n)
        if not len(some):
            continue
        cut, count = first[some], n[some, None]
        x = vectors[rows]
        mean = np.add.reduceat(x, cut, axis=0, dtype=np.float64) / count
        alike = np.zeros(len(rows))
        alike[1:] = np.einsum("ij,ij->i", x[1:], x[:-1])
        alike[cut] = 0
        again = np.zeros(len(rows))
        again[1:] = hashes[1:] == hashes[:-1]
        again[cut] = 0
        kind = np.searchsorted(ends, rows, side="right")
        shares = [np.add.reduceat((kind == k).astype(float), cut)[:, None] / count for k in range(len(REGIONS))]
        owner = np.repeat(np.arange(len(some)), n[some])
        index = np.zeros(len(some) * SIZE)
        for place, sign in index_vectors(hashes):
            index += np.bincount(owner * SIZE + place, weights=sign, minlength=len(index))
        index = index.reshape(-1, SIZE) / count
        out[at.start + some] = np.column_stack(
            [
                mean, np.linalg.norm(mean, axis=1), np.linalg.norm(index, axis=1),
                np.add.reduceat(alike, cut)[:, None] / count, np.add.reduceat(again, cut)[:, None] / count, *shares, np.log(count),
            ]
        )
    return out


def features() -> int:
    return SIZE + 4 + len(REGIONS) + 1


class Net(NamedTuple):
    """centre and spread of the features, two layers, and the calibration."""

    centre: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    scale: float = 1.0
    shift: float = 0.0


def logits(net: Net, x: np.ndarray) -> np.ndarray:
    hidden = np.tanh((x - net.centre) / net.spread @ net.w1 + net.b1)
    return (hidden @ net.w2 + net.b2)[:, 0]


def fit(x: np.ndarray, truth: np.ndarray, epochs: int = 40, batch: int = 64, seed: int = 5) -> Net:
    rng = np.random.default_rng(seed)
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - centre) / spread
    weights = {
        "w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN),
        "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 1)), "b2": np.zeros(1),
    }
    adam = Adam(weights, 0.003)
    balance = np.where(truth == 1, 0.5 / max(1e-9, truth.mean()), 0.5 / max(1e-9, 1 - truth.mean()))
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(order), batch):
            own = order[i : i + batch]
            hidden = np.tanh(x[own] @ weights["w1"] + weights["b1"])
            error = ((sigmoid((hidden @ weights["w2"] + weights["b2"])[:, 0]) - truth[own]) * balance[own] / len(own))[:, None]
            back = error @ weights["w2"].T * (1 - hidden**2)
            adam.step(
                {
                    "w1": x[own].T @ back + 1e-4 * weights["w1"], "b1": back.sum(axis=0),
                    "w2": hidden.T @ error + 1e-4 * weights["w2"], "b2": error.sum(axis=0),
                }
            )
    return Net(centre, spread, **weights)


def learn(
    docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", held_out: tuple[int, int] = (4, 2)
) -> tuple[np.ndarray, Net | None]:
    """Word vectors from all texts, and a network from labelled documents whose fold (of
    `held_out[0]`) is not `held_out[1]`: about `PER_CLASS` of each class at most.  None
    without labels of both classes."""
    folds, out = held_out
    vectors = word_vectors(docs, text)
    chosen, stands_for = labelled_sample(labels, label, fold("doc_id", folds) != out, PER_CLASS)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(texts: pa.Array) -> pa.Array:
        return pa.array(list(pooled(shared.value, texts)), pa.list_(pa.float64()))

    rows = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")  # bounded by PER_CLASS
    rows = rows.select("doc_id", "label", F.arrow_udf(pool, "array<double>")("text").alias("x"))
    found = staged(rows.dropDuplicates(["doc_id"]), "sample-features").toPandas().sort_values("doc_id")
    truth = found["label"].to_numpy(dtype=int)
    if len(set(truth.tolist())) < 2:
        return vectors, None
    x = np.array(found["x"].tolist())
    part = np.random.default_rng(1).permutation(len(x)) % 5 == 0
    net = fit(x[~part], truth[~part])
    weight = np.where(truth[part] == 1, stands_for[1], stands_for[0])
    scale, shift = temperature(logits(net, x[part]), truth[part], weight)
    return vectors, net._replace(scale=scale, shift=shift)


def quality(spark: SparkSession, vectors: np.ndarray, net: Net | None, text: str | Column = "text") -> Column:
    """The probability of a text's label 1; 0.5 without a network."""
    shared = spark.sparkContext.broadcast((vectors, tuple(net) if net else None))

    def score(texts: pa.Array) -> pa.Array:
        vectors, plain = shared.value
        if plain is None:
            return pa.array(np.full(len(texts), 0.5))
        own = Net(*plain)
        return pa.array(sigmoid(own.scale * logits(own, pooled(vectors, texts)) + own.shift))

    return F.arrow_udf(score, "double")(text)


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, score and predicted (1 from 0.7 on).

    Null and empty texts have the features of no words, all zero.  Rows with null or
    repeated ids are scored like others; no rows give no rows; other columns are not
    read.
    """
    vectors, net = learn(docs, labels, text, **options)
    rows = staged(docs.select("doc_id", quality(docs.sparkSession, vectors, net, text).alias("score")), "scores")
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
