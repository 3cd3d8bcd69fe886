"""Sharding by histogram sort.

Rows are ordered by three 64-bit parts: a key (40 bits of their text's hash, then 24 bits
of a hash of their id), a tie (a hash of both) and a number of the row.  So copies lie
side by side, and a group of any size can still be cut, repeated rows too; which of
several equal rows comes first makes no difference to the result.

Splitters are found by counting: each round, every task counts the exact bytes and
rows below a set of probes, the counts are summed, and new probes are set between the
two that enclose each target, until a splitter meets its tolerance or nothing lies
between.  Where one key alone encloses a target, the search goes on among that key's
ties, and then among a tie's rows.  Then the rows move once, each to its range, and are
numbered there.

A shard is made of many ranges, as many as its bytes need, so no task gets a whole
shard.  A shard's end prefers the edge of a group of copies that is near enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import utf8_bytes
from .scratch import staged

GROUP_BITS = 24
# Bytes of a range at most, unless one row has more.
RANGE_BYTES = 64 << 20
RANGE_ROWS = 1 << 18
PROBES = 16
LOWEST, HIGHEST = -(1 << 63), 1 << 63
# The parts of a row's place in the order.
ORDER = ("key", "tie", "row")

Counts = tuple[int, int]
Point = tuple[int, int, int]


def sort_key(doc_id: str | Column, text: str | Column) -> Column:
    """Groups equal texts; within a group, ids decide."""
    group = F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    return group.bitwiseAND(-(1 << GROUP_BITS)).bitwiseOR(F.xxhash64(F.lit(3), doc_id).bitwiseAND((1 << GROUP_BITS) - 1))


def below(rows: DataFrame, part: str, probes: dict[tuple, set[int]]) -> dict[tuple, dict[int, Counts]]:
    """Exact (bytes, rows) with `part` of the order below each probe, among the rows whose
    earlier parts are the probes' key."""
    fixed = ORDER[: ORDER.index(part)]
    groups = [(prefix, np.array(sorted(points), dtype=np.int64)) for prefix, points in probes.items()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = [np.zeros(len(points) + 1, np.int64) for _, points in groups]
        n = [np.zeros(len(points) + 1, np.int64) for _, points in groups]
        for batch in batches:
            values, sizes = np.asarray(batch.column(part)), np.asarray(batch.column("size"))
            for i, (prefix, points) in enumerate(groups):
                own = slice(None)
                if fixed:
                    own = np.logical_and.reduce([np.asarray(batch.column(c)) == x for c, x in zip(fixed, prefix)])
                at = np.searchsorted(points, values[own], side="right")
                order = np.argsort(at, kind="stable")
                running = np.r_[0, np.cumsum(sizes[own][order])]
                edges = np.searchsorted(at[order], np.arange(len(points) + 2))
                size[i] += np.diff(running[edges])
                n[i] += np.diff(edges)
        group = np.concatenate([np.full(len(x), i) for i, x in enumerate(n)])
        at = np.concatenate([np.arange(len(x)) for x in n])
        size, n = np.concatenate(size), np.concatenate(n)
        some = np.flatnonzero(n)
        columns = [group[some], at[some], size[some], n[some]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["group", "at", "size", "n"])

    if fixed:
        # Only keys that a splitter cuts: fewer than there are ranges.
        rows = rows.filter(F.col("key").isin([prefix[0] for prefix in probes]))
    # One row per probe at most reaches the driver.
    counted = rows.select(*fixed, part, "size").mapInArrow(count, "group long, at long, size long, n long")
    totals = counted.groupBy("group", "at").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect()
    found = {(r["group"], r["at"]): (r["size"], r["n"]) for r in totals}
    result: dict[tuple, dict[int, Counts]] = {}
    for i, (prefix, points) in enumerate(groups):
        size, n, own = 0, 0, {}
        for j, point in enumerate(points.tolist()):
            more = found.get((i, j), (0, 0))
            size, n = size + more[0], n + more[1]
            own[point] = (size, n)
        result[prefix] = own
    return result


class Target:
    """A wanted number of bytes, the two known places that enclose it, and which is chosen;
    `straddled` if the rows of one value reach across it."""

    def __init__(self, wanted: int, step: int):
        self.wanted, self.step = wanted, step
        self.low, self.high = LOWEST, HIGHEST
        self.chosen: int | None = None
        self.straddled = False


def search(
    rows: DataFrame, part: str, wanted: dict[tuple, list[int]], known: dict[tuple, dict[int, Counts]], tolerance: float, group_tolerance: float
) -> dict[tuple, list[Target]]:
    """Chooses a value of `part` for every wanted number of bytes, by groups of rows that
    share the earlier parts.  `known` has the counts below the values of each group, at
    first those below and up to its end, and is added to."""
    step = 1 << GROUP_BITS if part == "key" else 1
    targets = {prefix: [Target(w, step) for w in own] for prefix, own in wanted.items()}
    while True:
        probes: dict[tuple, set[int]] = {}
        for prefix, own in targets.items():
            counts = known[prefix]
            for t in own:
                if t.chosen is not None:
                    continue
                near = min((t.low, t.high), key=lambda k: abs(counts[k][0] - t.wanted))
                error = abs(counts[near][0] - t.wanted)
                if error <= tolerance or counts[t.high][1] - counts[t.low][1] <= 1:
                    t.chosen = near
                elif t.high - t.low > t.step:
                    units = (t.high - t.low) // t.step
                    count = min(PROBES, units - 1)
                    more = {t.low + t.step * (units * (i + 1) // (count + 1)) for i in range(count)}
                    probes.setdefault(prefix, set()).update(more - counts.keys())
                elif t.step > 1 and error > group_tolerance:
                    t.step = 1
                else:
                    t.chosen, t.straddled = near, t.step == 1 and error > group_tolerance
        if all(t.chosen is not None for own in targets.values() for t in own):
            return targets
        probes = {prefix: points for prefix, points in probes.items() if points}
        if probes:
            for prefix, found in below(rows, part, probes).items():
                size, n = known[prefix][LOWEST]
                known[prefix] |= {value: (size + more[0], n + more[1]) for value, more in found.items()}
        for prefix, own in targets.items():
            points = sorted(known[prefix])
            sizes = [known[prefix][k][0] for k in points]
            for t in own:
                if t.chosen is None:
                    # The last known place with fewer bytes below it, and the next.
                    i = max(1, int(np.searchsorted(sizes, t.wanted, side="left")))
                    t.low, t.high = max(t.low, points[i - 1]), min(t.high, points[i])


def point_at(prefix: tuple, value: int) -> Point:
    """Where the rows of a group begin that have at least this value of its next part."""
    if value == HIGHEST and prefix:
        return point_at(prefix[:-1], prefix[-1] + 1)
    return (*prefix, value, *[LOWEST] * (len(ORDER) - len(prefix) - 1))


def splitters(rows: DataFrame, wanted: list[int], total: Counts, tolerance: float, group_tolerance: float) -> dict[int, tuple[Point, Counts]]:
    """For each wanted number of bytes, a point of the order with about so many below it, and
    the exact (bytes, rows) there.  It is a group's edge if one is within `group_tolerance`,
    else the point that comes nearest."""
    result: dict[int, tuple[Point, Counts]] = {}
    groups: dict[tuple, list[int]] = {(): wanted}
    known: dict[tuple, dict[int, Counts]] = {(): {LOWEST: (0, 0), HIGHEST: total}}
    for part in ORDER:
        deeper: dict[tuple, list[int]] = {}
        inside: dict[tuple, dict[int, Counts]] = {}
        for prefix, targets in search(rows, part, groups, known, tolerance, group_tolerance).items():
            counts = known[prefix]
            for t in targets:
                result[t.wanted] = (point_at(prefix, t.chosen), counts[t.chosen])
                if t.straddled:
                    deeper.setdefault((*prefix, t.low), []).append(t.wanted)
                    inside[(*prefix, t.low)] = {LOWEST: counts[t.low], HIGHEST: counts[t.high]}
        if not deeper:
            break
        groups, known = deeper, inside
    return result


def histogram_shards(
    keyed: DataFrame, shards: int = 8, tolerance: float = 0.0005, group_tolerance: float = 0.005
) -> DataFrame:
    """The rows (size, key, tie, row and others) with shard and slot (gapless from 0 per shard).

    `keyed` is read several times, so it is staged.  Shards differ from total / shards
    bytes by the tolerance, a part of that, or by what one row makes inevitable.  No rows
    give no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    size, rows = keyed.agg(F.sum("size"), F.count("*")).first()
    total = (size or 0, rows)
    parts = max(1, -(-total[0] // (shards * RANGE_BYTES)), -(-rows // (shards * RANGE_ROWS)))
    ideal = total[0] / shards
    ends = [round(ideal * (i + 1)) for i in range(shards - 1)]
    inner = [round(ideal * (s + j / parts)) for s in range(shards) for j in range(1, parts)]
    found = splitters(keyed, sorted(set(ends)), total, tolerance * ideal, group_tolerance * ideal)
    loose = ideal / parts / 4
    found_inner = splitters(keyed, sorted(set(inner)), total, loose, loose) if inner else {}
    last: Point = (HIGHEST, LOWEST, LOWEST)
    shard_ends = sorted(found[w] for w in ends) + [(last, total)]
    # Ranges: each shard's own splitters, cut to lie within it.
    edges, low = [], ((LOWEST, LOWEST, LOWEST), (0, 0))
    for shard, high in enumerate(shard_ends):
        cuts = sorted({k: c for k, c in found_inner.values() if low[0] < k < high[0]}.items())
        for start in [low, *cuts]:
            edges.append((start[0], shard, start[1][1] - low[1][1]))
        low = high
    # Empty shards share a start with the next; the last of equal starts holds the rows.
    table = {start: (shard, first) for start, shard, first in edges}
    starts = sorted(s for s in table if s < last)
    return numbered(keyed, starts, [table[s] for s in starts])


def ranges_of(points: list[Point], columns: list[np.ndarray]) -> np.ndarray:
    """For each row, given by the parts of its place, how many of the ascending points are
    at or before it."""
    heads = np.array([p[0] for p in points], dtype=np.int64)
    at = np.searchsorted(heads, columns[0], side="left")
    last = np.searchsorted(heads, columns[0], side="right")
    if len(columns) == 1:
        return last
    for head in np.unique(columns[0][last > at]):
        own = columns[0] == head
        inside = [p[1:] for p in points if p[0] == head]
        at[own] += ranges_of(inside, [c[own] for c in columns[1:]])
    return at


def numbered(keyed: DataFrame, starts: list[Point], places: list[tuple[int, int]]) -> DataFrame:
    """The one exchange: every row to its range, in its order there."""
    shards, firsts = (np.array(column, dtype=np.int64) for column in zip(*places))

    def home(key: pa.Array, tie: pa.Array, row: pa.Array) -> pa.Array:
        at = ranges_of(starts, [np.asarray(part) for part in (key, tie, row)]) - 1
        return pa.StructArray.from_arrays(
            [pa.array(at), pa.array(shards[at]), pa.array(firsts[at])], names=["range", "shard", "first"]
        )

    dealt = keyed.withColumn("home", F.arrow_udf(home, "range long, shard long, first long")(*ORDER))
    dealt = dealt.select("*", F.col("home.range").alias("range"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*ORDER)) - 1
    placed = dealt.withColumn("place", place).withColumn("slot", F.col("home.first") + F.col("place"))
    return placed.withColumn("shard", F.col("home.shard").cast("int")).drop("home", "range", "place", *ORDER)


def keyed_rows(docs: DataFrame, doc_id: str, text: str, *others: Column) -> DataFrame:
    """What `histogram_shards` takes: size is the text's bytes plus 1, as a separator."""
    tie = F.xxhash64(F.lit(4), F.col(doc_id), F.col(text))
    row = F.monotonically_increasing_id()
    return docs.select(
        *others, (utf8_bytes(text) + 1).alias("size"), sort_key(F.col(doc_id), text).alias("key"), tie.alias("tie"), row.alias("row")
    )


def shard_plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 8, **options) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard and slot.  Null texts have
    no bytes and size 1; repeated rows each have a slot; other columns are not read."""
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    rows = keyed_rows(docs, doc_id, text, F.col(doc_id).alias("doc_id"), crc.alias("text_crc32"))
    return histogram_shards(staged(rows, "keyed"), shards, **options)


def sharded_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 8, **options) -> DataFrame:
    """The documents, all columns, with shard and slot, which replace columns of such names."""
    names = [name for name in docs.columns if name not in ("shard", "slot")]
    rows = keyed_rows(docs, doc_id, text, F.struct(*[F.col(f"`{n}`") for n in names]).alias("doc"))
    placed = histogram_shards(staged(rows, "keyed"), shards, **options)
    return placed.select(*[F.col("doc")[name].alias(name) for name in names], "shard", "slot")
