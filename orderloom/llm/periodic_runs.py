"""Periodic runs of words, by the dictionary of basic factors.

A basic factor is a stretch of 2^k words.  Level by level, every factor that a document
holds twice gets a name: the first level names words, each further one the pair of names
of a factor's halves.  Two occurrences of a factor within twice its length (starts no
more than its length apart) overlap or touch, and the successors of such an occurrence
form an arithmetic progression whose step is the factor's period.  So three equally
spaced successors propose the step as a period; neighbouring proposals of one step are
one stretch, which is extended as far as its period goes.

A run of smallest period q and at least 4q words is proposed at the shortest factor
length f >= q: its first factor occurs again after q words and after 2q, as f < 2q, and
not earlier, since f + q words with a shorter period as well would give the whole run a
shorter one.  Steps up to f/2 are left to the level that has them.

Words are compared as such, not by hashes.  A document is read by one task; nothing is
shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

RUN = "struct<start: long, length: long, period: long>"
OUTPUT = f"n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string"


def word_names(buffer: np.ndarray, words: W.Words, in_word: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words."""
    ends = np.cumsum(np.r_[0, words.end - words.start])
    column = pa.Array.from_buffers(
        pa.large_binary(), len(words.start), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(buffer[in_word])]
    )
    return pc.dictionary_encode(column).indices.to_numpy().astype(np.int64)


def progressions(at: np.ndarray, name: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches (start, end, step) in which three successive occurrences of a factor of
    `length` words are `step` words apart.  `at` ascends; only steps above length / 2."""
    order = np.argsort(name, kind="stable")
    place, label = at[order], name[order]
    step, same = np.diff(place), label[1:] == label[:-1]
    three = same[:-1] & same[1:] & (step[:-1] == step[1:]) & (step[:-1] <= length) & (2 * step[:-1] > length)
    first, apart = place[:-2][three], step[:-1][three]
    order = np.lexsort((first, apart))
    first, apart = first[order], apart[order]
    opens = np.ones(len(first), dtype=bool)
    opens[1:] = (first[1:] != first[:-1] + 1) | (apart[1:] != apart[:-1])
    start = np.flatnonzero(opens)
    last = np.r_[start[1:], len(first)][: len(start)] - 1
    return first[start], first[last] + 2 * apart[start] + length, apart[start]


def extended(values: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
    """Moves both ends out, in place, as long as values a period apart are equal."""
    active = np.arange(len(start))
    while len(active):
        active = active[start[active] > 0]
        before = start[active] - 1
        active = active[values[before] == values[before + period[active]]]
        start[active] -= 1
    active = np.arange(len(end))
    while len(active):
        active = active[end[active] < len(values)]
        active = active[values[end[active]] == values[end[active] - period[active]]]
        end[active] += 1


def periodic_stretches(
    names: np.ndarray, first: np.ndarray, min_length: int, min_periods: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs (start, end, smallest period) of the documents that lie side by side in
    `names`, document d from first[d] to first[d + 1]; ordered by start, then period."""
    if min_periods < 4:
        raise ValueError("shorter runs than four periods may have no three equal steps")
    n = len(names)
    # A document's words share no value with another's, so no factor spans two documents twice.
    values = np.repeat(np.arange(len(first) - 1), np.diff(first)) * (names.max(initial=0) + 1) + names
    known = np.full(n, -1, dtype=np.int64)
    at, codes, length = np.arange(n), values, 1
    found = []
    while len(at):
        _, label, count = np.unique(codes, return_inverse=True, return_counts=True)
        twice = count[label] > 1
        at, label = at[twice], label[twice]
        found.append(progressions(at, label, length))
        known[at] = label
        left = at[at + length < n]
        right = known[left + length]
        codes = (known[left] * (len(count) + 1) + right)[right >= 0]
        known[at] = -1
        at, length = left[right >= 0], 2 * length
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, end, period = (np.concatenate(part) for part in zip(*found))
    extended(values, start, end, period)
    long = end - start >= np.maximum(min_length, min_periods * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((end, period, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1]) | (period[1:] != period[:-1])
    return start[new], end[new], period[new]


def strongest(lengths: list[int], periods: list[int]) -> int:
    """The index of the greatest exact length / period; of equals the first."""
    return max(range(len(lengths)), key=lambda i: (Fraction(lengths[i], periods[i]), -i))


def kept_text(buffer: np.ndarray, words: W.Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all documents' kept words, one space between, and each document's bounds."""
    data = np.append(buffer, np.uint8(0x20))
    last = np.zeros(len(kept), dtype=bool)
    index = np.flatnonzero(kept)
    if len(index):
        owner = np.searchsorted(words.first, index, side="right")
        last[index[np.r_[owner[1:] != owner[:-1], True]]] = True
    # The byte behind a word that another follows is white space: it becomes the one space.
    spaced = kept & ~last
    data[words.end[spaced]] = 0x20
    steps = np.zeros(len(data) + 1, dtype=np.int8)
    steps[words.start[kept]] += 1
    np.subtract.at(steps, words.end[kept] + spaced[kept], 1)
    taken = np.cumsum(steps, dtype=np.int8)[: len(data)] > 0
    sizes = np.cumsum(np.r_[0, (words.end - words.start + spaced) * kept])
    return data[taken], sizes[words.first]


def find_runs(texts: pa.Array, min_length: int, min_periods: int) -> pa.StructArray:
    """The columns of OUTPUT for each text."""
    parts = []
    for _, buffer, bounds in W.chunks(texts):
        in_word = W.NOT_SPACE[buffer]
        words = W.runs(in_word, bounds)
        start, end, period = periodic_stretches(word_names(buffer, words, in_word), words.first, min_length, min_periods)
        repeat = np.zeros(len(words.start) + 1, dtype=np.int64)
        np.add.at(repeat, start + period, 1)
        np.subtract.at(repeat, end, 1)
        data, ends = kept_text(buffer, words, np.cumsum(repeat)[:-1] == 0)

        owner = np.searchsorted(words.first, start, side="right") - 1
        edges = np.searchsorted(owner, np.arange(len(bounds)))
        columns = [start - words.first[owner], end - start, period]
        runs = pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["start", "length", "period"])
        best = [
            int(i) + strongest(columns[1][i:j].tolist(), columns[2][i:j].tolist()) if j > i else None
            for i, j in zip(edges[:-1], edges[1:])
        ]
        parts.append(
            pa.StructArray.from_arrays(
                [
                    pa.array(words.counts),
                    pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), runs),
                    runs.take(pa.array(best, pa.int64())),
                    pa.Array.from_buffers(
                        pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
                    ).cast(pa.string()),
                ],
                names=["n_words", "runs", "strongest", "collapsed"],
            )
        )
    return pa.concat_arrays(parts)


def periodic_runs(
    docs: DataFrame, keys: list[str], text: str = "text", min_length: int = 6, min_periods: int = 4
) -> DataFrame:
    """Returns `keys`, n_words, runs, strongest and collapsed for every row's whole text.

    Words are runs of anything but ASCII white space, numbered from 0.  A run is a stretch
    whose words a smallest period apart are equal, at least `min_length` words and
    `min_periods` (4 or more) periods long, that no neighbouring word extends.  `runs`
    are ordered by start, then period; `strongest` has the greatest length / period, of
    equals the first, and is null without runs.  `collapsed` is the text without the words
    that any run holds after its first period, the rest joined by one space.

    A null or empty text has no words, no runs and an empty collapsed text.  Repeated rows
    stay; no rows give no rows; other columns are not read.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = find_runs(batch.column(batch.num_columns - 1), min_length, min_periods)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found.flatten()], names=[*batch.schema.names[:-1], *found.type.names])

    rows = docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("text_"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(find, f"{schema}, {OUTPUT}" if schema else OUTPUT)
