"""Repeated hashes of a corpus, found in one compact exchange.

Tasks gather hashes in buffers.  A buffer keeps one entry per distinct hash (one
that is marked, if any is), sorts them, and sends each bucket of the hash space
one packed row: differences of the sorted hashes and the entries' places in the
buffer, in byte planes that compress well.  So a hash that a third of all
documents share costs one entry per buffer, and no pair is ever formed.  The
bucket's task finds the hashes that several buffers have, and each buffer's
owners get their places back.  Places of a hash that a buffer has twice or more
are known before the exchange.

The number of buckets follows the data, so a bucket's size does not grow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

# Hashes in a buffer, and about as many in a bucket.
BUFFER = 3_000_000
BUCKET = 1_000_000
MARK = np.uint32(1 << 31)

PACKED = "bucket int, buffer long, kind int, entries long, hashes binary, places binary, owners binary"
OWNED = "buffer long, kind int, places binary, owners binary"
ENTRIES, KNOWN, OWNERS = 0, 1, 2


class Hashed(NamedTuple):
    """Hashes of some documents: high picks the bucket, low is compared; place is
    the index within the batch of words at `first`; key has two columns."""

    key: np.ndarray
    first: np.ndarray
    place: np.ndarray
    high: np.ndarray
    low: np.ndarray
    marked: np.ndarray


def planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unplanes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def pack(parts: list[Hashed], buffer: int, buckets: int) -> pa.RecordBatch:
    """The rows one buffer sends."""
    words, keys, firsts, places = 0, [], [], []
    for part in parts:
        keys.append(part.key)
        firsts.append(part.first[:-1] + words)
        places.append(part.place + words)
        words += int(part.first[-1])
    place = np.concatenate(places).astype(np.uint32)
    low = np.concatenate([part.low for part in parts])
    marked = np.concatenate([part.marked for part in parts])
    high = np.concatenate([part.high for part in parts])
    bucket = ((high >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    # By bucket, then hash; of equal hashes a marked one comes first.
    order = np.lexsort((~marked, low, bucket)) if buckets > 1 else np.lexsort((~marked, low))
    bucket, low, place, marked = bucket[order], low[order], place[order], marked[order]
    same = np.zeros(len(low), dtype=bool)
    same[1:] = (low[1:] == low[:-1]) & (bucket[1:] == bucket[:-1])
    repeated = same.copy()
    repeated[:-1] |= same[1:]
    known = np.sort(place[repeated])
    keep = ~same
    bucket, low, place = bucket[keep], low[keep], place[keep] | np.where(marked[keep], MARK, np.uint32(0))
    # Only buckets that the buffer has something for: of many buckets most are empty.
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    rows: list[tuple] = []
    for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)]):
        step = low[i:j].copy()
        step[1:] -= low[i : j - 1]
        rows.append((int(bucket[i]), buffer, ENTRIES, j - i, planes(step), planes(place[i:j]), None))
    home = int(buffer % buckets)
    owners = np.column_stack([np.concatenate(keys), np.concatenate(firsts)]).astype(np.int64)
    rows.append((home, buffer, OWNERS, 0, None, None, owners.tobytes()))
    if len(known):
        rows.append((home, buffer, KNOWN, 0, None, known.tobytes(), None))
    names = [c.split()[0] for c in PACKED.split(", ")]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)


def sender(hashed: Callable[[pa.RecordBatch], Iterator[Hashed]], buckets: int) -> Callable:
    """For mapInArrow: gathers hashes in buffers and sends each as packed rows."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        parts: list[Hashed] = []
        held = sent = 0
        for batch in batches:
            for part in hashed(batch):
                if len(part.place):
                    parts.append(part)
                    held += len(part.place)
                if held >= BUFFER:
                    yield pack(parts, (task << 32) + sent, buckets)
                    parts, held, sent = [], 0, sent + 1
        if parts:
            yield pack(parts, (task << 32) + sent, buckets)

    return send


def matcher(wide: bool, need_mark: bool) -> Callable[[pa.Table], pa.Table]:
    """For applyInArrow on a bucket: the places whose hash several buffers have, at
    least one of them marked if `need_mark`; other rows pass."""
    kind = np.uint64 if wide else np.uint32

    def match(table: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in OWNED.split(", ")]
        is_entry = np.asarray(table["kind"]) == ENTRIES
        passed = table.filter(pa.array(~is_entry)).select(names)
        entries = table.filter(pa.array(is_entry))
        if not len(entries):
            return passed
        buffers = np.asarray(entries["buffer"])
        low = np.concatenate([np.cumsum(unplanes(x.as_py(), kind), dtype=kind) for x in entries["hashes"]])
        place = np.concatenate([unplanes(x.as_py(), np.uint32) for x in entries["places"]])
        row = np.repeat(np.arange(len(buffers)), np.asarray(entries["entries"]))
        order = np.argsort(low, kind="stable")
        low = low[order]
        new = np.ones(len(low), dtype=bool)
        new[1:] = low[1:] != low[:-1]
        group = np.cumsum(new) - 1
        hit = np.bincount(group) > 1
        if need_mark:
            hit &= np.bincount(group, weights=(place[order] & MARK) > 0) > 0
        found = order[hit[group]]
        found = found[np.lexsort((place[found] & ~MARK, row[found]))]
        row, place = row[found], place[found] & ~MARK
        edges = np.searchsorted(row, np.arange(len(buffers) + 1))
        rows = [r for r in range(len(buffers)) if edges[r] < edges[r + 1]]
        sent = pa.table(
            [
                pa.array(buffers[rows], pa.int64()),
                pa.array([KNOWN] * len(rows), pa.int32()),
                pa.array([place[edges[r] : edges[r + 1]].tobytes() for r in rows], pa.binary()),
                pa.nulls(len(rows), pa.binary()),
            ],
            names=names,
        )
        return pa.concat_tables([passed.cast(sent.schema), sent])

    return match


def resolve(table: pa.Table) -> pa.Table:
    """For applyInArrow on a buffer: the word positions found in each of its documents."""
    owners = next(x.as_py() for x in table["owners"] if x.as_py() is not None)
    owners = np.frombuffer(owners, np.int64).reshape(-1, 3)
    places = [np.frombuffer(x.as_py(), np.uint32) for x in table["places"] if x.as_py() is not None]
    place = np.unique(np.concatenate(places)).astype(np.int64) if places else np.zeros(0, np.int64)
    owner = np.searchsorted(owners[:, 2], place, side="right") - 1
    positions = (place - owners[owner, 2]).astype(np.int32)
    edges = np.searchsorted(owner, np.arange(len(owners) + 1))
    rows = np.flatnonzero(edges[1:] > edges[:-1])
    return pa.table(
        [
            pa.array(owners[rows, 0], pa.int64()),
            pa.array(owners[rows, 1], pa.int64()),
            pa.array([positions[edges[r] : edges[r + 1]].tobytes() for r in rows], pa.binary()),
        ],
        names=["text_key_1", "text_key_2", "positions"],
    )


def repeated_places(
    texts: DataFrame, hashed: Callable[[pa.RecordBatch], Iterator[Hashed]], buckets: int, wide: bool, need_mark: bool
) -> DataFrame:
    """The positions of repeated hashes: text_key_1, text_key_2, positions (packed int32)."""
    packed = texts.mapInArrow(sender(hashed, buckets), PACKED)
    found = packed.groupBy("bucket").applyInArrow(matcher(wide, need_mark), OWNED)
    return found.groupBy("buffer").applyInArrow(resolve, "text_key_1 long, text_key_2 long, positions binary")
