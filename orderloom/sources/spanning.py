"""Records that span lines, read by many tasks.

A reader that starts in the middle of a file cannot tell whether it is inside a record:
in CSV that depends on the number of quotes before, in pretty-printed JSON on the open
brackets.  So a file's splits are read twice.  First each split says what it does to the
state, whatever that was: whether it flips the quotes, how far it rises and falls.  Run
over the splits of a file, these give the state in which each begins.  Then every split
is cut into records; a record that begins in one split and ends in another is put
together from its parts, which are few.

The first pass gives one short row per split, as many as the plan of the scan has, and
only these come to the driver.  Both passes need the same splits, so run them under the
same settings; otherwise the second fails.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPLIT = "file long, start long"
PARTS = f"{SPLIT}, owner long, first boolean, text string"


class Cut(NamedTuple):
    """Lines cut into records: the end of one that began before (None if there is no end),
    whole records, and the beginning of one that goes on (None if there is none)."""

    head: str | None
    records: list[str]
    tail: str | None


class Form(NamedTuple):
    """How a format is cut.  `measure` sums up lines as integers, `joined` two such sums;
    `states` has for each split of a file the state before it, whether that is inside a
    record, and whether a record ends in it; `cut` takes lines and the state before them,
    and gives the state behind them too."""

    measure: Callable[[pa.Array], tuple[int, ...]]
    joined: Callable[[tuple[int, ...], tuple[int, ...]], tuple[int, ...]]
    states: Callable[[list[tuple[int, ...]]], list[tuple[int, bool, bool]]]
    cut: Callable[[pa.Array, int], tuple[Cut, int]]


def split_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with the file and the start of the split that they were read from."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def split_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Array]]:
    """Lines of one split at a time, in order."""
    for batch in batches:
        file, start = np.asarray(batch.column("file")), np.asarray(batch.column("start"))
        edges = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(file)]):
            if b > a:
                yield int(file[a]), int(start[a]), batch.column("value")[a:b]


def split_states(lines: DataFrame, form: Form) -> dict[tuple[int, int], tuple[int, int | None, bool]]:
    """For each split: the state before it; the split in which the record that it begins in
    began, None if it begins with one; and whether its first record began the file and
    doesn't end in it."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple[int, ...]] = {}
        for file, start, values in split_runs(batches):
            more = form.measure(values)
            found[file, start] = form.joined(found[file, start], more) if (file, start) in found else more
        columns = [[k[0] for k in found], [k[1] for k in found], list(found.values())]
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["file", "start", "sums"])

    rows = lines.mapInArrow(summarise, f"{SPLIT}, sums array<long>").collect()
    files: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r["file"], r["start"])):
        files.setdefault(row["file"], []).append((row["start"], tuple(row["sums"])))
    states: dict[tuple[int, int], tuple[int, int | None, bool]] = {}
    for file, splits in files.items():
        owner = None
        for i, ((start, _), (state, inside, ends)) in enumerate(zip(splits, form.states([sums for _, sums in splits]))):
            states[file, start] = state, owner if inside else None, i == 0 and not ends
            if ends or not inside:
                owner = start
    return states


def spanning_records(spark: SparkSession, path: str | list[str], form: Form, header: bool) -> DataFrame:
    """The text of every record, as `value`; of a form with `header` without each file's
    first."""
    lines = split_lines(spark, path)
    states = split_states(lines, form)  # one entry per split
    names = [f.split()[0] for f in PARTS.split(", ")]

    def rows(file: int, start: int, found: list[tuple[int | None, bool, str]]) -> pa.RecordBatch:
        owners, firsts, texts = zip(*found)
        columns = [[file] * len(found), [start] * len(found), owners, firsts, texts]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        held: list[str] = []
        state = owner = first = None
        fresh = False

        def left() -> list[tuple[int | None, bool, str]]:
            # What the split ends with goes on in the next one.
            return [(at[1] if owner is None else owner, first and owner is None and not fresh, "\n".join(held))] if held else []

        for file, start, values in split_runs(batches):
            if (file, start) != at:
                if at is not None and held:
                    yield rows(*at, left())
                if (file, start) not in states:
                    raise ValueError("the splits of a file have changed between two passes")
                at, held = (file, start), []
                state, owner, first = states[at]
                fresh = False
                is_first = start == 0
            (head, records, tail), state = form.cut(values, state)
            found: list[tuple[int | None, bool, str]] = []
            if head is not None:
                text = "\n".join([*held, head])
                held = []
                if owner is not None:
                    found.append((owner, False, text))
                elif not (header and is_first and not fresh):
                    found.append((None, False, text))
                owner, fresh = None, True
            for record in records:
                if not (header and is_first and not fresh):
                    found.append((None, False, record))
                fresh = True
            if tail is not None:
                held.append(tail)
            if found:
                yield rows(file, start, found)
        if at is not None and held:
            yield rows(*at, left())

    parts = lines.mapInArrow(cut, PARTS)
    whole = parts.where(F.col("owner").isNull()).select(F.col("text").alias("value"))
    # The parts of one record: as many as splits it reaches over.
    broken = parts.where(F.col("owner").isNotNull()).groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("start", "text"))).alias("parts"), F.bool_or("first").alias("first")
    )
    if header:
        broken = broken.where(~F.col("first"))
    together = broken.select(F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("value"))
    return whole.unionAll(together)


# --- CSV: a line ends a record if the quotes so far are even -----------------------


def quotes(lines: pa.Array) -> np.ndarray:
    return np.asarray(pc.count_substring(lines, '"')).astype(np.int64)


def quote_sums(lines: pa.Array) -> tuple[int, ...]:
    """Whether the quotes are odd, and whether a line ends a record if they were even before,
    and if they were odd."""
    odd = np.cumsum(quotes(lines)) % 2
    return int(odd[-1]), int((odd == 0).any()), int((odd == 1).any())


def quote_join(a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
    after = b[1:] if a[0] == 0 else b[:0:-1]
    return a[0] ^ b[0], a[1] | after[0], a[2] | after[1]


def quote_states(sums: list[tuple[int, ...]]) -> list[tuple[int, bool, bool]]:
    state, states = 0, []
    for odd, *ends in sums:
        states.append((state, state == 1, bool(ends[state])))
        state ^= odd
    if state:
        raise ValueError("a quoted field of a CSV file has no end")
    return states


def cut_csv(lines: pa.Array, state: int) -> tuple[Cut, int]:
    odd = (np.cumsum(quotes(lines)) + state) % 2
    ends, texts = np.flatnonzero(odd == 0).tolist(), lines.to_pylist()
    if not ends:
        return Cut(None, [], "\n".join(texts)), int(odd[-1])
    spans = [texts[a + 1] if b == a + 1 else "\n".join(texts[a + 1 : b + 1]) for a, b in zip([-1, *ends[:-1]], ends)]
    tail = "\n".join(texts[ends[-1] + 1 :]) if ends[-1] + 1 < len(texts) else None
    return Cut(spans[0], spans[1:], tail), int(odd[-1])


CSV = Form(quote_sums, quote_join, quote_states, cut_csv)

# --- JSON: a record is what the outermost braces, or those in the outermost list, hold ---

ESCAPED = re.compile(rb"\\.")
OPEN, CLOSE = np.zeros((2, 256), dtype=bool)
OPEN[list(b"[{")] = True
CLOSE[list(b"]}")] = True
BETWEEN = np.zeros(256, dtype=bool)
BETWEEN[list(b" \t\r\n,")] = True
# A state is a depth and, in its lowest bit, whether records are in a list.


def brackets(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, those within strings as letters, and for each the steps up or down and
    the depth behind it.  No string of JSON holds a line break, so lines begin outside."""
    plain = np.frombuffer(ESCAPED.sub(b"xx", data), np.uint8)
    quote = plain == ord('"')
    inside = (np.cumsum(quote) % 2 == 1) | quote
    plain = np.where(inside, np.uint8(ord("x")), plain)
    step = OPEN[plain].astype(np.int64) - CLOSE[plain]
    return plain, step, np.cumsum(step)


def whole_text(lines: pa.Array) -> bytes:
    return "\n".join(lines.to_pylist()).encode()


def bracket_sums(lines: pa.Array) -> tuple[int, ...]:
    """How much deeper the lines end than they begin; the least depth behind a closing
    bracket, against that before; and the first character but white space (0: none)."""
    plain, step, depth = brackets(whole_text(lines))
    seen = plain[~BETWEEN[plain]]
    low = depth[step < 0]
    return int(step.sum()), int(low.min()) if len(low) else 1 << 40, int(seen[0]) if len(seen) else 0


def bracket_join(a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
    return a[0] + b[0], min(a[1], a[0] + b[1]), a[2] or b[2]


def bracket_states(sums: list[tuple[int, ...]]) -> list[tuple[int, bool, bool]]:
    first = next((x for _, _, x in sums if x), 0)
    base = 1 if first == ord("[") else 0
    depth, states = 0, []
    for rise, low, _ in sums:
        states.append((2 * depth + base, depth > base, depth + low <= base))
        depth += rise
    if depth:
        raise ValueError("the brackets of a JSON file don't match")
    return states


def cut_json(lines: pa.Array, state: int) -> tuple[Cut, int]:
    before, base = divmod(state, 2)
    data = whole_text(lines)
    plain, step, depth = brackets(data)
    depth += before
    outside = (depth == base) & (step == 0)
    if (depth < 0).any() or not BETWEEN[plain[outside]].all():
        raise ValueError("a JSON file must hold objects, or one list of objects")
    starts = np.flatnonzero((step > 0) & (depth == base + 1)).tolist()
    ends = np.flatnonzero((step < 0) & (depth == base)).tolist()
    after = 2 * int(depth[-1] if len(depth) else before) + base
    head = None
    if before > base:
        if not ends:
            return Cut(None, [], data.decode()), after
        head = data[: ends[0] + 1].decode()
        ends = ends[1:]
    tail = data[starts[-1] :].decode() if len(starts) > len(ends) else None
    return Cut(head, [data[a : b + 1].decode() for a, b in zip(starts, ends)], tail), after


JSON = Form(bracket_sums, bracket_join, bracket_states, cut_json)


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of fully quoted CSV files, without their headers and empty lines."""
    return spanning_records(spark, path, CSV, header=True).where("value <> ''")


def json_records(spark: SparkSession, path: str | list[str], record: str, options: dict[str, str] | None = None) -> DataFrame:
    """The records of JSON files that hold one list of objects, or objects one after the
    other, over any number of lines.  A record that does not fit fails the job."""
    found = spanning_records(spark, path, JSON, header=False)
    return typed(found, F.from_json("value", record, {"mode": "FAILFAST", **(options or {})}))


def typed(records: DataFrame, parsed: Column) -> DataFrame:
    return records.select(parsed.alias("record")).select("record.*")
