"""Near duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints within 3 bits have a value that is within 2 bits of one and
within 1 bit of the other.  Which of the two goes further is settled by parity:
links of odd length join an even and an odd fingerprint (by their number of set
bits).  Every even fingerprint emits its variants at 0 and 2 bits, every odd one
those at 1 bit, so all variants are even and every link within 3 bits meets at one:

* 1 bit: the even end itself, which the odd end reaches with one bit;
* 2 bits: one of two even ends itself, or a value between two odd ends;
* 3 bits: any value one bit from the odd and two from the even end.

Variants are dealt by a linear code of their bits (a few parities), so a task that
gets a fingerprint can list just the variants that fall to its bucket: a
fingerprint is sent once per bucket, and its variants, up to 2,017, are never
shuffled.  In a bucket, all owners of one variant link to one of them, the variant
itself or else an odd one, as these are within 3 bits of all that need it; the bits are
compared again, and only a spanning forest of each bucket leaves it.  So no pairs
are listed, however dense a group is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .scratch import staged

RADIUS = 3
SEED = 42
# Variants that a bucket's task sorts at once.
BUCKET_VARIANTS = 4_000_000
# A bucket beyond this many has, for most fingerprints, one variant at most.
MOST_BUCKETS = 1 << 20


def fingerprints(texts: pa.Array, shingle: int) -> np.ndarray:
    """The 64-bit SimHash of each text: a bit is set if it is in over half the hashes
    of the text's shingles."""
    out = np.zeros(len(texts), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for rows, buffer, bounds in W.chunks(texts):
        data = W.LOWER[buffer].tobytes()
        hashes: list[int] = []
        first = np.zeros(len(bounds), dtype=np.int64)
        for d in range(len(bounds) - 1):
            words = data[bounds[d] : bounds[d + 1]].split()
            if words:
                joined = b" ".join(words)
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                width = min(shingle, len(words))
                starts = [0, *ends[: len(words) - width].tolist()]
                hashes.extend([digest(joined[i : j - 1], SEED) for i, j in zip(starts, ends[width - 1 :].tolist())])
            first[d + 1] = len(hashes)
        if hashes:
            n = np.diff(first)
            some = np.flatnonzero(n)
            bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            set_bits = np.add.reduceat(bits, first[some], axis=0, dtype=np.int32)
            flags = (2 * set_bits > n[some, None]).astype(np.uint8)
            out[rows.start + some] = np.packbits(flags, axis=1, bitorder="little").view("<u8").ravel()
    return out


def simhash(text: str | Column, shingle: int = 3) -> Column:
    """The fingerprint of a text as a long.  A text of fewer words than a shingle is
    one shingle; null and texts without words have fingerprint 0."""
    return F.arrow_udf(lambda texts: pa.array(fingerprints(texts, shingle).view(np.int64)), "long")(text)


def parity(values: np.ndarray) -> np.ndarray:
    return (np.bitwise_count(values) & 1).astype(np.int64)


def flips(odd: bool, radius: int) -> np.ndarray:
    """What an odd or an even fingerprint is XORed with to give its variants."""
    ones = [1 << i for i in range(64)]
    if odd:
        masks = ones if radius >= 1 else []
    else:
        masks = [0] + ([a | b for a, b in combinations(ones, 2)] if radius >= 2 else [])
    return np.array(masks, dtype=np.uint64)


def checks(bits: int) -> np.ndarray:
    """The parity checks that make a bucket's number of a value."""
    return W.mix(np.arange(bits, dtype=np.uint64), 5)


def buckets_of(values: np.ndarray, bits: int) -> np.ndarray:
    bucket = np.zeros(len(values), dtype=np.int64)
    for i, check in enumerate(checks(bits)):
        bucket |= parity(values & check) << i
    return bucket


def by_syndrome(masks: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The masks sorted by bucket number, and where each number's masks begin."""
    numbers = buckets_of(masks, bits)
    order = np.argsort(numbers, kind="stable")
    return masks[order], np.searchsorted(numbers[order], np.arange((1 << bits) + 1))


def dealer(bits: int, radius: int) -> Callable:
    """For mapInArrow: sends each fingerprint to the buckets that its variants fall in."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = [np.unique(buckets_of(flips(odd, radius), bits)) for odd in (False, True)]
        for batch in batches:
            values = np.asarray(batch.column(0)).view(np.uint64)
            for odd in (0, 1):
                own = values[parity(values) == odd]
                step = max(1, (1 << 20) // max(1, len(reached[odd])))
                for i in range(0, len(own), step):
                    part = own[i : i + step]
                    bucket = (buckets_of(part, bits)[:, None] ^ reached[odd][None, :]).ravel()
                    owner = np.repeat(part, len(reached[odd]))
                    order = np.argsort(bucket, kind="stable")
                    bucket, owner = bucket[order], owner[order]
                    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, int)
                    ends = np.r_[edges[1:], len(bucket)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket[edges], pa.int64()), pa.array([owner[a:b].tobytes() for a, b in zip(edges, ends)], pa.binary())],
                        names=["bucket", "owners"],
                    )

    return deal


def forest(nodes: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each node is linked to, directly or through others."""
    label = np.arange(nodes)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def linker(bits: int, radius: int) -> Callable:
    """For applyInArrow on a bucket: links (a, b) that span what its variants join."""

    def link(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        owners = np.unique(np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table["owners"]]))
        keys, who = [], []
        odd_owner = parity(owners)
        shift = buckets_of(owners, bits) ^ bucket
        for odd in (0, 1):
            masks, edges = by_syndrome(flips(bool(odd), radius), bits)
            own = np.flatnonzero(odd_owner == odd)
            own = own[np.argsort(shift[own], kind="stable")]
            at = np.searchsorted(shift[own], np.arange((1 << bits) + 1))
            for s in np.flatnonzero((np.diff(at) > 0) & (np.diff(edges) > 0)):
                group, mask = own[at[s] : at[s + 1]], masks[edges[s] : edges[s + 1]]
                keys.append((owners[group][:, None] ^ mask[None, :]).ravel())
                who.append(np.repeat(group, len(mask)).astype(np.int32))
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if keys:
            variant, who = np.concatenate(keys), np.concatenate(who)
            order = np.argsort(variant)
            variant, who = variant[order], who[order]
            same = np.zeros(len(variant) + 1, dtype=bool)
            same[1:-1] = variant[1:] == variant[:-1]
            met = same[1:] | same[:-1]
            variant, who = variant[met], who[met]
            # Of the owners of a variant, the first by this order is the one to link to.
            rank = np.where(owners[who] == variant, 0, np.where(odd_owner[who] == 1, 1, 2))
            order = np.lexsort((who, rank, variant))
            variant, who, rank = variant[order], who[order], rank[order]
            opens = np.r_[True, variant[1:] != variant[:-1]] if len(variant) else np.zeros(0, bool)
            head = np.maximum.accumulate(np.where(opens, np.arange(len(variant)), 0)) if len(variant) else np.zeros(0, int)
            tail = np.flatnonzero(~opens & (rank[head] < 2))
            a, b = who[head[tail]].astype(np.int64), who[tail].astype(np.int64)
            close = np.bitwise_count(owners[a] ^ owners[b]) <= radius
            label = forest(len(owners), a[close], b[close])
            b = np.flatnonzero(label != np.arange(len(owners)))
            a = label[b]
        return pa.table([pa.array(owners[a].view(np.int64)), pa.array(owners[b].view(np.int64))], names=["a", "b"])

    return link


def ball_links(values: DataFrame, column: str, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct values of a long column: every two values within
    `radius` bits (1 to 3) are linked, directly or through others; every link is one
    within `radius` bits or stands for a chain of such."""
    if not 1 <= radius <= 3:
        raise ValueError("radius must be 1, 2 or 3")
    distinct = values.select(F.col(column).alias("value")).filter("value IS NOT NULL").distinct()
    distinct = staged(distinct, "fingerprints")
    n = distinct.count()
    mean = (len(flips(False, radius)) + len(flips(True, radius))) / 2
    bits = 0
    while n * mean > BUCKET_VARIANTS << bits and 1 << bits < MOST_BUCKETS:
        bits += 1
    dealt = distinct.mapInArrow(dealer(bits, radius), "bucket long, owners binary")
    return staged(dealt.groupBy("bucket").applyInArrow(linker(bits, radius), "a long, b long").distinct(), "near-links")


def near_duplicate_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = RADIUS
) -> DataFrame:
    """One row per document: doc_id, simhash (long), root (the group's smallest
    fingerprint) and component_id (its smallest doc_id).

    Documents whose fingerprints differ in at most `radius` bits are linked; a group
    is what links reach.  Equal fingerprints are linked, those of texts without words
    (zero) like others.  Null ids are passed over for component_id, which is null if
    the whole group has none.  Repeated rows stay, each with its group.  No rows give
    no rows.  Other columns are not read.
    """
    marked = docs.select(F.col(doc_id).alias("doc_id"), simhash(text, shingle).alias("simhash"))
    return grouped(staged(marked, "simhash"), radius)


def grouped(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """As `near_duplicate_groups`, of rows with doc_id and simhash; other columns stay."""
    smallest = marked.groupBy("simhash").agg(F.min("doc_id").alias("first_id"))
    roots = components(ball_links(marked, "simhash", radius), "a", "b")
    placed = smallest.join(roots, smallest.simhash == roots.node, "left").select(
        "simhash", "first_id", F.coalesce("root", "simhash").alias("root")
    )
    placed = staged(placed, "placed")
    groups = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = placed.select("simhash", "root").join(groups, "root")
    return marked.join(ids, "simhash")


def first_of_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = RADIUS) -> DataFrame:
    """The documents with one left of each group of near duplicates: that with the
    smallest id (nulls last), of rows that share it any one.  Columns stay as they are."""
    names = docs.columns
    held = docs.select(F.struct("*").alias("doc"), F.col(doc_id).alias("doc_id"), simhash(text, shingle).alias("simhash"))
    held = staged(held.withColumn("row", F.monotonically_increasing_id()), "documents")
    groups = grouped(held.select("row", "doc_id", "simhash"), radius)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    kept = groups.groupBy("root").agg(F.min_by("row", order).alias("row")).select("row")
    return held.join(kept, "row", "left_semi").select(*[F.col("doc")[name].alias(name) for name in names])
