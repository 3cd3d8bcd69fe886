"""Words, lines and windows of a batch of texts as numpy arrays.

A batch's texts lie side by side in one byte buffer.  A hash of any byte range is
a difference of prefix sums of a polynomial modulo 2^64, so all words of a batch,
and all windows over them, take a few passes over the arrays and no loop.
Every word hash is mixed before windows are built from it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 19

BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & _MASK)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix(np.arange(256, dtype=np.uint64) << np.uint64(20))


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, set within the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# Bytes of words, in UTF-8: all but ASCII white space; letters, digits and all beyond ASCII.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2^64; kept for the next call."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if size <= 4 * CHUNK_BYTES:
            _powers[base] = known
    return known[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class Prefix:
    """Hashes of ranges of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        n = len(values)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * powers(base, n), out=self.sums[1:])
        self.unshift = powers(inverse(base), n + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of [start, end) for each pair."""
        return mix((self.sums[end] - self.sums[start]) * self.unshift[start])


class Words(NamedTuple):
    """first[d]: index of document d's first word; start, end: bytes of each word."""

    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offsets of each; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of rows with at most `limit` bytes, or one row: rows, bytes, offsets."""
    buffer, bounds = text_bytes(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        last = int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1
        last = min(max(last, row + 1), rows)
        yield slice(row, last), buffer[bounds[row] : bounds[last]], bounds[row : last + 1] - bounds[row]
        row = last


def runs(flags: np.ndarray, bounds: np.ndarray) -> Words:
    """Maximal runs of set flags that stay within the documents at `bounds`."""
    n = len(flags)
    opens, closes = flags.copy(), flags.copy()
    opens[1:] &= ~flags[:-1]
    closes[:-1] &= ~flags[1:]
    edges = bounds[(bounds > 0) & (bounds < n)]
    opens[edges] = flags[edges]
    closes[edges - 1] = flags[edges - 1]
    start = np.flatnonzero(opens)
    return Words(np.searchsorted(start, bounds), start, np.flatnonzero(closes) + 1)


def word_hashes(buffer: np.ndarray, words: Words, prefix: Prefix | None = None) -> np.ndarray:
    prefix = prefix or Prefix(BYTE_VALUES[buffer])
    return prefix.ranges(words.start, words.end)


def window_starts(words: Words, width: int) -> np.ndarray:
    """The word indexes at which a window of `width` words of one document begins."""
    last = np.repeat(words.first[1:], words.counts)
    return np.flatnonzero(np.arange(len(words.start)) + width <= last)


def window_hashes(hashes: np.ndarray, starts: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    return Prefix(hashes, base).ranges(starts, starts + width)


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Flags of the n words that lie in any window."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + width, minlength=n + 1)
    return np.cumsum(steps)[:n] > 0


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of [bounds[d], bounds[d+1]) for each document."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
