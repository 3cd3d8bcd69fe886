"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is how often each of its documents should be taken:
a whole number of copies and a fraction.  The fractions are rounded together.  Two
documents at a time pass expected words from one to the other, up or down at random
so that no expectation changes, until one of them is whole; the source's words stay
what they were.  Blocks of documents do this each for itself and leave one fraction,
the fractions of 64 blocks go on together, and so up a tree to the last one, which
chance rounds.  So a source's words miss its target by less than one document.

Blocks and draws follow from hashes of id and text, not from how rows are dealt.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import staged

WEIGHTS = (3, 1, 2)
BLOCK_DOCS = 4096
FAN_IN = 64


def word_count(text: str = "text") -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """The rows with `rank`, their place in the order from 0.  Each task numbers its
    range of the order; only the rows per range come to the driver."""
    held = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    held = staged(held, "ranked")
    task, place = F.shiftrightunsigned("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = sorted(tuple(r) for r in held.groupBy(task.alias("task")).count().collect())
    before, offsets = 0, []
    for index, n in counts:
        offsets += [F.lit(index), F.lit(before)]
        before += n
    offset = F.create_map(*offsets)[task] if offsets else F.lit(0)
    return held.withColumn("rank", place + offset).drop("at")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, n_docs, target) per source of `sizes` (source, size).

    Sources in code point order, null last, weigh `weights` in turn.  They share
    `share` times all sizes by weight; a target stops at `most` times its source's
    size, and what that leaves goes to the others by weight until none is above.
    """
    if share > most:
        raise ValueError("share can't be above most")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = ranked(sources, F.col("source").isNull(), F.col("source"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = staged(sources.select("source", "source_size", "n_docs", turn.alias("weight")), "sources")
    cap = most * F.col("source_size")
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, before = 0.0, None
    while level != before:
        full = cap <= level * F.col("weight")
        capped, open_weight = sources.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if not open_weight:
            break
        # More is left for the open ones as more are full, so the level only rises.
        level, before = max(level, (budget - (capped or 0.0)) / open_weight), level
    target = F.least(cap, level * F.col("weight"))
    return sources.select("source", "source_size", "n_docs", target.alias("target"))


def pivot(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """The fractions after passing on: all 0 or 1 but at most one, whose index is
    returned (-1: none).  sum(size * p) stays."""
    p = p.copy()
    draws = rng.random(len(p))
    held = -1
    for j in range(len(p)):
        if held < 0:
            held = j
            continue
        i = held
        up = min((1 - p[i]) * size[i], p[j] * size[j])
        down = min(p[i] * size[i], (1 - p[j]) * size[j])
        if draws[j] * (up + down) < down:
            i_full, j_none = (1 - p[i]) * size[i] <= p[j] * size[j], p[j] * size[j] <= (1 - p[i]) * size[i]
            p[i] = 1.0 if i_full else p[i] + up / size[i]
            p[j] = 0.0 if j_none else p[j] - up / size[j]
        else:
            i_none, j_full = p[i] * size[i] <= (1 - p[j]) * size[j], (1 - p[j]) * size[j] <= p[i] * size[i]
            p[i] = 0.0 if i_none else p[i] - down / size[i]
            p[j] = 1.0 if j_full else p[j] + down / size[j]
        held = i if 0 < p[i] < 1 else j if 0 < p[j] < 1 else -1
    return p, held


def rounder(seed: int, level: int, last: bool):
    """For applyInArrow on a block: its rows with their fractions rounded; at most one
    is left open, none by the last level."""

    def round_block(table: pa.Table) -> pa.Table:
        order = np.lexsort((np.asarray(table["size"]), np.asarray(table["order"])))
        table = table.take(pa.array(order))
        size, p = np.asarray(table["size"]).astype(float), np.asarray(table["p"])
        first = int(np.asarray(table["order"])[0]) & ((1 << 64) - 1)
        rng = np.random.Generator(np.random.Philox(key=[first, (seed << 8) + level]))
        p, held = pivot(size, p, rng)
        if last and held >= 0:
            p[held], held = float(rng.random() < p[held]), -1
        done = np.ones(len(p), dtype=bool)
        if held >= 0:
            done[held] = False
        for name, values in (("p", p), ("done", done)):
            table = table.set_column(table.schema.get_field_index(name), name, pa.array(values))
        return table

    return round_block


def mix(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 7
) -> DataFrame:
    """The rows (source, size, order and others) with source_size, target, copies and
    taken (copies times size).

    Every row is taken the whole part of target / source_size times, or once more;
    rows without words are not taken.  Sources without words have target 0.  Null is
    a source of its own.  Rows of equal `order` and size are interchangeable.  No rows
    give no rows.
    """
    by_source = staged(targets(rows.select("source", "size"), weights, share, most), "targets")
    joined = rows.alias("r").join(by_source.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
    times = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    blocks = F.ceil(F.col("n_docs") / BLOCK_DOCS)
    units = joined.select("r.*", "source_size", "target", times.alias("times"), F.pmod("order", blocks).alias("block"))
    units = units.withColumn("copies", F.floor("times").cast("long")).withColumn("p", F.col("times") - F.col("copies"))
    units = units.drop("times").withColumn("done", F.col("p") == 0)
    units = staged(units, "units")
    most_docs = by_source.agg(F.max("n_docs")).first()[0] or 0
    levels = 1 + max(0, math.ceil(math.log(max(1, math.ceil(most_docs / BLOCK_DOCS)), FAN_IN) - 1e-9))
    decided, left = [units.filter("done")], units.filter("NOT done")
    for level in range(levels):
        last = level == levels - 1
        rounded = left.groupBy("source", "block").applyInArrow(rounder(seed, level, last), units.schema)
        rounded = staged(rounded, f"rounded-{level}")
        decided.append(rounded.filter("done"))
        left = rounded.filter("NOT done").withColumn("block", F.floor(F.col("block") / FAN_IN).cast("long"))
    whole = decided[0]
    for part in decided[1:]:
        whole = whole.unionByName(part)
    copies = F.col("copies") + F.col("p").cast("long")
    return whole.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).drop("p", "done", "block", "order")


def sized(docs: DataFrame, *others: str | Column, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    order = F.xxhash64(F.lit(11), F.col(doc_id), F.col(text))
    return docs.select(*others, F.col(source).cast("string").alias("source"), word_count(text).alias("size"), order.alias("order"))


def mixed_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """One row per document: doc_id, source, size (words), source_size, target, copies
    and taken.  As `mix`; null texts have no words; other columns are not read."""
    rows = sized(docs, F.col(doc_id).alias("doc_id"), doc_id=doc_id, text=text, source=source)
    return mix(staged(rows, "sizes"), **options)


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken; columns stay as they are."""
    names = docs.columns
    held = sized(docs, F.struct("*").alias("doc"), doc_id=doc_id, text=text, source=source)
    held = staged(held.withColumn("row", F.monotonically_increasing_id()), "documents")
    taken = mix(held.select("row", "source", "size", "order"), **options).filter("copies > 0").select("row", "copies")
    # Dealt by row at any size, so small and large inputs go the same way.
    repeated = held.select("row", "doc").join(taken.hint("merge"), "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*[F.col("doc")[name].alias(name) for name in names])
