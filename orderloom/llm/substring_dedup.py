"""Exact substring duplicates by fixed-block anchors.

Any repeated span of `width` words holds a whole block of the grid that cuts each
document into blocks of (width + 1) // 2 words.  So:

1. index the hash of every grid block and probe the index with the hash of every
   rolling window of a block's length (`exchange`): the anchors;
2. extend: every span of `width` words around an anchor is compared, as 64 bits of a
   second hash and those that pick its bucket, with all other extended spans.  Overlapping repeated spans join to
   the maximal exact repeat;
3. remove the words of these spans.

Texts that occur more than once are repeats as a whole and need no anchors, but
their spans are compared with everyone's.

Nothing here grows with a group: a hash counts once per buffer, and no pairs are
formed.  Steps 2 and 3 move each text once, by its key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .exchange import BUCKET, Hashed, repeated_places
from .keys import TEXT_KEY, text_key, utf8_bytes
from .scratch import staged

# Bytes of text that give about as many words as a bucket of hashes takes.
BUCKET_BYTES = 6 * BUCKET
SECOND_BASE = 0xC2B2AE3D27D4EB4F


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([np.asarray(batch.column(name)) for name in TEXT_KEY])


def _rolling(block: int):
    """Hashes of all rolling windows; those on the grid are marked."""

    def hashed(batch: pa.RecordBatch) -> Iterator[Hashed]:
        keys = _keys(batch)
        for rows, buffer, bounds in W.chunks(batch.column("text")):
            words = W.runs(W.NOT_SPACE[buffer], bounds)
            hashes = W.word_hashes(buffer, words)
            place = W.window_starts(words, block)
            high = W.window_hashes(hashes, place, block)
            grid = (place - words.first[words.docs()[place]]) % block == 0
            yield Hashed(keys[rows], words.first, place, high, high.astype(np.uint32), grid)

    return hashed


def _extended(block: int, width: int):
    """Hashes of the spans of `width` words around each anchor, or of all spans of
    a copied text."""

    def hashed(batch: pa.RecordBatch) -> Iterator[Hashed]:
        keys = _keys(batch)
        copied = np.asarray(batch.column("copied"))
        anchors = batch.column("positions")
        for rows, buffer, bounds in W.chunks(batch.column("text")):
            words = W.runs(W.NOT_SPACE[buffer], bounds)
            hashes = W.word_hashes(buffer, words)
            near = np.zeros(len(hashes) + 1, dtype=np.int64)
            for d, (whole, packed) in enumerate(zip(copied[rows], anchors[rows.start : rows.stop])):
                first, last = words.first[d], words.first[d + 1]
                if whole:
                    near[first] += 1
                    near[last] -= 1
                elif packed.is_valid:
                    at = np.frombuffer(packed.as_py(), np.int32) + first
                    np.add.at(near, np.maximum(at - (width - block), first), 1)
                    np.add.at(near, at + 1, -1)
            place = W.window_starts(words, width)
            place = place[np.cumsum(near)[place] > 0]
            low = W.window_hashes(hashes, place, width)
            high = W.window_hashes(W.mix(hashes, 1), place, width, SECOND_BASE)
            yield Hashed(keys[rows], words.first, place, high, low, np.zeros(len(place), dtype=bool))

    return hashed


def repeated_spans(docs: DataFrame, text: str = "text", width: int = 35) -> DataFrame:
    """Where repeated spans start: one row per distinct text that has any, with
    text_key_1, text_key_2, copied (the whole text occurs twice or more) and
    positions (packed int32: starts, in words, of spans of `width` words that occur
    elsewhere; null for copied texts, all of whose spans do)."""
    if width < 1:
        raise ValueError("width must be positive")
    block = (width + 1) // 2
    texts = docs.select(*text_key(text), F.coalesce(F.col(text), F.lit("")).alias("text"))
    per_text = docs.select(*text_key(text), utf8_bytes(text).alias("size"))
    copies = staged(per_text.groupBy(*TEXT_KEY).agg(F.count("*").alias("n"), F.sum("size").alias("size")), "copies")
    total = copies.agg(F.sum("size")).first()[0] or 0
    buckets = 1 + total // BUCKET_BYTES
    copied = copies.filter("n > 1").select(*TEXT_KEY)

    anchors = staged(repeated_places(texts, _rolling(block), buckets, wide=False, need_mark=True), "anchors")
    single = anchors.join(copied, list(TEXT_KEY), "left_anti").withColumn("copied", F.lit(False))
    whole = copied.withColumn("positions", F.lit(None).cast("binary")).withColumn("copied", F.lit(True))
    near = staged(single.unionByName(whole), "anchored")
    candidates = texts.join(near, list(TEXT_KEY))
    spans = staged(repeated_places(candidates, _extended(block, width), buckets, wide=True, need_mark=False), "spans")
    single = spans.join(copied, list(TEXT_KEY), "left_anti").withColumn("copied", F.lit(False))
    return single.unionByName(whole)


def removed(text: str | Column, copied: str, positions: str, width: int) -> Column:
    """n_words, n_removed and kept_text of a text whose repeated spans are known."""

    def cut(texts: pa.Array, copied: pa.Array, positions: pa.Array) -> pa.Array:
        n_words, n_removed, kept = [], [], []
        for rows, buffer, bounds in W.chunks(texts):
            data = buffer.tobytes()
            for d in range(len(bounds) - 1):
                row = rows.start + d
                found = data[bounds[d] : bounds[d + 1]].split()
                n = len(found)
                if copied[row].as_py() and n >= width:
                    found = []
                elif positions[row].is_valid and n:
                    gone = W.covered(n, np.frombuffer(positions[row].as_py(), np.int32).astype(np.int64), width)
                    found = [found[i] for i in np.flatnonzero(~gone)]
                n_words.append(n)
                n_removed.append(n - len(found))
                kept.append(b" ".join(found))
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["n_words", "n_removed", "kept_text"],
        )

    return F.arrow_udf(cut, "n_words long, n_removed long, kept_text string")(text, copied, positions)


def remove_repeats(docs: DataFrame, keys: list[str], text: str = "text", width: int = 35) -> DataFrame:
    """The texts without the words of repeated spans.

    Returns `keys`, n_words, n_removed and kept_text (the words that stay, joined by
    one space).  A word goes if it lies in `width` consecutive words of a text that
    also start elsewhere, in the same text or another; every occurrence goes.

    Null and empty texts have no words; shorter texts than `width` stay whole.
    Repeated rows are copies of one another, so all their words go.  No rows give no
    rows.  Other columns are not read, and may have any name.
    """
    spans = repeated_spans(docs, text, width)
    rows = docs.select(*keys, *text_key(text), F.col(text).alias("__text"))
    joined = rows.join(spans, list(TEXT_KEY), "left")
    cut = joined.select(*keys, removed("__text", "copied", "positions", width).alias("__cut"))
    return cut.select(*keys, "__cut.*")
