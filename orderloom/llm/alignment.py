"""Alignment of two tokenizers' tokens by pointer jumping.

Both tokenizers cut the same bytes of a text.  Every token points to the token of the
other side that it overlaps and that reaches farthest right, or to itself if none
reaches beyond it (of two that end together the second side's is the last).  Replacing
every pointer by its target's pointer doubles the reach each time, so after a logarithmic
number of passes all tokens of a connected component point to its last token, which names
their group.  A pass is one array lookup over the tokens of many texts.

How often a pair of ids is linked is counted over all texts and looked up again for every
link.  Frequent pairs (2^20 at most, by a threshold from a histogram of counts) go to all
tasks as sorted arrays; links of the rest, whose pairs are rare and so none of them hot,
are joined by pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .encoding import Encode, id_bytes, id_encoder
from .scratch import staged

# Pairs whose counts every task gets: 16 MB at most.
FREQUENT = 1 << 20
# Distinct pairs that a counting task holds before it passes them on.
HELD_PAIRS = 1 << 20
# Bytes of text aligned at once, and tokens whose links are listed at once; a longer text is
# handled alone.
RUN_BYTES = W.CHUNK_BYTES
RUN_TOKENS = 1 << 17
OUTPUT = "n_a long, n_b long, n_groups long, n_links long, groups string, a_ids binary, b_ids binary"


class Tokenizer(NamedTuple):
    """A file's name and content, and whether it sees the space that is put before a text
    (else it puts one itself)."""

    name: str
    data: bytes
    spaced: bool


def tokenizer(path: str) -> Tokenizer:
    with open(path, "rb") as file:
        return Tokenizer(path, file.read(), not path.endswith(".model"))


def cut(of: Tokenizer) -> Encode:
    """Cuts texts into ids whose bytes, side by side, are a space and the text; None where
    they are others."""
    encode = id_encoder(of.name, of.data, special=False, check=True)
    return (lambda texts: encode([" " + t for t in texts])) if of.spaced else encode


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For every token of side a, then of side b, the last token of its component.  Both
    sides cut one byte range; the ends of their tokens ascend."""
    n = len(a_end)
    reach_b = np.searchsorted(b_end, a_end)  # has the last byte of a token of side a
    reach_a = np.searchsorted(a_end, b_end)
    beyond = a_end[reach_a] > b_end if n else np.zeros(0, dtype=bool)
    pointer = np.concatenate([n + reach_b, np.where(beyond, reach_a, n + np.arange(len(b_end)))])
    while True:
        farther = pointer[pointer]
        if np.array_equal(farther, pointer):
            return pointer
        pointer = farther


def links(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of a, token of b) of all overlapping pairs, and where each overlap ends: an
    overlap is what two neighbouring ends of either side enclose."""
    ends = np.concatenate([a_end, b_end])
    ends.sort(kind="stable")  # merges two ascending runs
    ends = ends[np.r_[True, ends[1:] != ends[:-1]]] if len(ends) else ends
    return np.searchsorted(a_end, ends), np.searchsorted(b_end, ends), ends


class Digits:
    """Decimal text of ids."""

    def __init__(self, most: int):
        self.width = len(str(most))
        numbers = [str(i).encode() for i in range(most + 1)]
        self.sizes = np.array([len(x) for x in numbers], dtype=np.int8)
        self.text = np.frombuffer(b"".join(x.ljust(self.width + 1) for x in numbers), np.uint8).reshape(-1, self.width + 1)

    def joined(self, ids: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, each with the byte `behind` it, and their sizes."""
        cells, sizes = self.text[ids], self.sizes[ids]
        cells[np.arange(len(ids)), sizes] = behind
        return cells[np.arange(self.width + 1) <= sizes[:, None]], sizes.astype(np.int64) + 1


def offsets(sizes: list[int] | np.ndarray) -> np.ndarray:
    return np.cumsum(np.r_[0, np.asarray(sizes, dtype=np.int64)])


def id_type(sizes: np.ndarray) -> str:
    """The narrowest integers that hold the ids of a vocabulary, as stored."""
    return "<u2" if len(sizes) <= 1 << 16 else "<u4"


def packed_ids(ids: np.ndarray, bounds: np.ndarray, kind: str) -> pa.Array:
    """The ids of each text as a binary value."""
    data = ids.astype(kind)
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * data.itemsize).astype(np.int32)), pa.py_buffer(data)]
    )


def flat_ids(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and each text's bounds."""
    _, offsets_, data = column.buffers()
    bounds = np.frombuffer(offsets_, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    ids = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return ids.view(kind).astype(np.int64), (bounds - bounds[0]) // np.dtype(kind).itemsize


def aligned_run(
    a: list[np.ndarray], b: list[np.ndarray], a_size: np.ndarray, b_size: np.ndarray, digits: Digits
) -> list[pa.Array]:
    """The columns of OUTPUT for texts cut into the ids `a` and `b`; of a size each id has
    in bytes."""
    a_bound, b_bound = offsets([len(x) for x in a]), offsets([len(x) for x in b])
    a_ids = np.concatenate([*a, np.zeros(0, np.int64)])
    b_ids = np.concatenate([*b, np.zeros(0, np.int64)])
    a_end, b_end = np.cumsum(a_size[a_ids]), np.cumsum(b_size[b_ids])
    label = terminals(a_end, b_end)
    is_last = label[len(a_ids) :] == len(a_ids) + np.arange(len(b_ids))
    group = offsets(is_last)
    n_groups = np.diff(group[b_bound])
    # Overlaps end where a token of either side does: at all ends, those of groups counted once.
    n_links = np.diff(a_bound) + np.diff(b_bound) - n_groups

    # Tokens in the order of groups, side a before side b in each.
    side = np.repeat([0, 1], [len(a_ids), len(b_ids)])
    key = 2 * group[label - len(a_ids)] + side
    order = np.argsort(key, kind="stable")
    key = key[order]
    follows = np.r_[key[1:], -1]
    behind = np.where(follows == key, ord(","), np.where(key % 2 == 0, ord("|"), ord(";"))).astype(np.uint8)
    data, sizes = digits.joined(np.concatenate([a_ids, b_ids])[order], behind)
    # No separator at a text's end.
    ends = offsets(sizes)[a_bound + b_bound]
    some = np.diff(ends) > 0
    stays = np.ones(len(data), dtype=bool)
    stays[ends[1:][some] - 1] = False
    text_bounds = offsets(np.diff(ends) - some)
    groups = pa.Array.from_buffers(
        pa.large_string(), len(a), [None, pa.py_buffer(text_bounds), pa.py_buffer(data[stays])]
    ).cast(pa.string())
    counts = [pa.array(np.diff(x)) for x in (a_bound, b_bound)]
    ids = [packed_ids(a_ids, a_bound, id_type(a_size)), packed_ids(b_ids, b_bound, id_type(b_size))]
    return [*counts, pa.array(n_groups), pa.array(n_links), groups, *ids]


def align(docs: DataFrame, a_path: str, b_path: str, keys: list[str], text: str = "text") -> DataFrame:
    """Returns `keys`, n_a, n_b, n_groups, n_links, groups, a_ids and b_ids of every row; ids
    are packed as 16-bit little-endian integers, or 32-bit ones of larger vocabularies.

    A text with a space before it is cut whole by both tokenizers; strings of special tokens
    are plain text, none are added.  `groups` names the ids between byte offsets at which
    tokens of both sides end: `a1,a2|b1;a3|b2,b3`.  A link is a pair of tokens whose bytes
    overlap.  Null and empty texts, and those that either tokenizer's bytes do not give
    back, have no tokens: zeros, no ids, empty `groups`.  Repeated rows stay; no rows
    give no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer(a_path), tokenizer(b_path)))  # two files of a few MB
    names = OUTPUT.split(", ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts: list[Encode] = []
        none = np.zeros(0, np.int64)
        for batch in batches:
            if not cuts:
                cuts = [cut(t) for t in shared.value]
                a_size, b_size = (np.array([len(x) for x in id_bytes(t.name, t.data)]) for t in shared.value)
                digits = Digits(max(len(a_size), len(b_size)) - 1)
            texts = batch.column(batch.num_columns - 1)
            for rows, _, _ in W.chunks(texts, RUN_BYTES):
                own = texts[rows].to_pylist()
                both = [[none if not t else ids for t, ids in zip(own, encode(own))] for encode in cuts]
                both = [(x, y) if x is not None and y is not None else (none, none) for x, y in zip(*both)]
                columns = [c[rows] for c in batch.columns[:-1]] + aligned_run(*map(list, zip(*both)), a_size, b_size, digits)
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *[n.split(" ")[0] for n in names]])

    rows = docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("text_"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, kept + OUTPUT)


def link_codes(batch: pa.RecordBatch, a_size: np.ndarray, b_size: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of rows: rows, the pair of ids (a in the upper 32 bits) of every link, and where
    each row's links are."""
    a_all, b_all = batch.column("a_ids"), batch.column("b_ids")
    a_kind, b_kind = id_type(a_size), id_type(b_size)
    tokens = flat_ids(a_all, a_kind)[1]
    row = 0
    while row < batch.num_rows:
        last = int(np.searchsorted(tokens, tokens[row] + RUN_TOKENS, side="right")) - 1
        rows = slice(row, min(max(last, row + 1), batch.num_rows))
        (a_ids, _), (b_ids, bounds) = flat_ids(a_all[rows], a_kind), flat_ids(b_all[rows], b_kind)
        a_end, b_end = np.cumsum(a_size[a_ids]), np.cumsum(b_size[b_ids])
        at_a, at_b, ends = links(a_end, b_end)
        yield rows, a_ids[at_a] << 32 | b_ids[at_b], np.searchsorted(ends, np.r_[0, b_end][bounds], side="right")
        row = rows.stop


def pair_counts(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(pair, n, best) of all pairs of linked ids: how many links hold the pair, and whether
    no pair with its second id has more."""
    sizes = shared_sizes(aligned, a_path, b_path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        new: list[tuple[np.ndarray, np.ndarray]] = []
        for codes in chain((c for batch in batches for _, c, _ in link_codes(batch, *sizes.value)), [None]):
            if codes is not None:
                new.append(np.unique(codes, return_counts=True))
            if codes is None or sum(len(c) for c, _ in new) > HELD_PAIRS // 2:
                pairs, where = np.unique(np.concatenate([pairs, *[c for c, _ in new]]), return_inverse=True)
                n = np.bincount(where, weights=np.concatenate([n, *[m for _, m in new]]), minlength=len(pairs)).astype(np.int64)
                new = []
            if len(pairs) > HELD_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])
                pairs, n = pairs[:0], n[:0]
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])

    counted = aligned.select("a_ids", "b_ids").mapInArrow(count, "pair long, n long")
    counts = staged(counted.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    second = F.col("pair").bitwiseAND((1 << 32) - 1).alias("second")
    # One row per id of the second vocabulary at most.
    most = counts.groupBy(second).agg(F.max("n").alias("most"))
    return counts.withColumn("second", second).join(most, "second").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def shared_sizes(df: DataFrame, a_path: str, b_path: str):
    """The number of bytes of each id of both files, for tasks."""
    both = (np.array([len(x) for x in id_bytes(t.name, t.data)]) for t in (tokenizer(a_path), tokenizer(b_path)))
    return df.sparkSession.sparkContext.broadcast(tuple(both))


def frequent_from(counts: DataFrame, most: int = FREQUENT) -> int:
    """The least power of two such that at most `most` pairs have so many links."""
    size = F.floor(F.log2("n")).cast("int").alias("size")
    found = sorted(((r["size"], r["count"]) for r in counts.groupBy(size).count().collect()), reverse=True)
    total, least = 0, 64
    for power, n in found:
        total += n
        if total > most:
            return 1 << least if least < 63 else (1 << 63) - 1
        least = power
    return 1


def with_pair_counts(aligned: DataFrame, a_path: str, b_path: str, row: str, most: int = FREQUENT) -> DataFrame:
    """The rows of `aligned` (what `align` returned, stored, with a unique column `row`) but
    their ids, and n_best and count_sum: over a row's links, how many have a pair of ids
    that is its second id's most frequent one, and the sum of the pairs' counts."""
    spark = aligned.sparkSession
    sizes = shared_sizes(aligned, a_path, b_path)
    counts = staged(pair_counts(aligned, a_path, b_path), "pair-ranks")
    least = frequent_from(counts, most)
    top = counts.filter(F.col("n") >= least).orderBy("pair").toArrow()  # `most` rows at most
    table = spark.sparkContext.broadcast(tuple(top[name].to_numpy() for name in ("pair", "n", "best")))
    others = [name for name in aligned.columns if name not in ("a_ids", "b_ids")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = table.value
        for batch in batches:
            for rows, codes, bounds in link_codes(batch, *sizes.value):
                at = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
                found = known[at] == codes if len(known) else np.zeros(len(codes), dtype=bool)
                sums = W.sums(np.where(found, n[at], 0) if len(known) else np.zeros(len(codes), np.int64), bounds)
                bests = W.sums(found & best[at] if len(known) else found, bounds)
                rare = pa.ListArray.from_arrays(pa.array(offsets(~found)[bounds].astype(np.int32)), pa.array(codes[~found]))
                columns = [batch.column(name)[rows] for name in others] + [pa.array(bests), pa.array(sums), rare]
                yield pa.RecordBatch.from_arrays(columns, names=[*others, "n_best", "count_sum", "rare_"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in aligned.select(*others).schema.fields)
    # Stored, as ids go to Python in bounded batches then.
    scored = staged(aligned.mapInArrow(score, f"{kept}n_best long, count_sum long, rare_ array<long>"), "pair-scores")
    if least <= 1:
        return scored.drop("rare_")
    pairs = scored.filter(F.size("rare_") > 0).select(F.col(row).alias("row_"), F.explode("rare_").alias("pair"))
    per_row = pairs.groupBy("row_", "pair").agg(F.count("*").alias("links")).join(counts.filter(F.col("n") < least), "pair")
    more = per_row.groupBy("row_").agg(
        F.sum(F.col("links") * F.col("n")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best")
    )
    joined = scored.drop("rare_").join(more, F.col(row) == F.col("row_"), "left")
    total = {"n_best": "more_best", "count_sum": "more_sum"}
    return joined.select(*others, *[(F.col(k) + F.coalesce(F.col(v), F.lit(0))).alias(k) for k, v in total.items()])

