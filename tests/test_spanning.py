import json
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings as examples
from hypothesis import strategies as st

from orderloom.session import settings
from orderloom.sinks.csv import read_csv, read_csv_split, write_csv
from orderloom.sources.pages import scan_json_split
from orderloom.sources.spanning import CSV, JSON, csv_records, split_lines

from .conftest import rows

SCHEMA = "id int, a string, b string"


def tiny(spark, size):
    """Splits of a few bytes."""
    return settings(spark, spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="1")


def odd_texts(seed, n):
    rng = random.Random(seed)
    marks = ['"', "\n", ",", "\r\n", "\\", "x", "é", '""', "\n\n", " ", "日本", "{", "]", '\\"']
    text = lambda: "".join(rng.choice(marks) for _ in range(rng.choice([0, 1, 5, 20, 90])))
    return [(i, text(), None if rng.random() < 0.2 else text()) for i in range(n)]


@pytest.mark.parametrize("size", [40, 300, 100_000])
@pytest.mark.parametrize("exact", [True, False])
def test_csv_in_splits_is_csv_whole(spark, tmp_path, size, exact):
    data = odd_texts(size, 60)
    path = str(tmp_path / "csv")
    write_csv(spark.createDataFrame(data, SCHEMA).coalesce(1), path, exact)
    with tiny(spark, size):
        assert split_lines(spark, path).select("start").distinct().count() > 1 or size == 100_000
        got = rows(read_csv_split(spark, path, SCHEMA, exact), "id")
    assert got == sorted(data, key=repr) == rows(read_csv(spark, path, SCHEMA, exact), "id")


def test_a_record_over_many_splits(spark, tmp_path):
    data = [(1, "a", "b"), (2, "line\n" * 500, 'q"' * 300), (3, None, ""), (4, "\n" * 400, "z")]
    for name in ("one", "two"):
        write_csv(spark.createDataFrame(data, SCHEMA).coalesce(1), str(tmp_path / "in" / name), exact=True)
    paths = [str(tmp_path / "in" / name) for name in ("one", "two")]
    with tiny(spark, 100):
        got = rows(read_csv_split(spark, paths, SCHEMA, exact=True), "id")
    assert got == sorted(data * 2, key=repr)


def test_headers_that_span_lines_are_left_out(spark, tmp_path):
    (tmp_path / "h.csv").write_text('"a\nlong\nheader that goes on\nand on","b"\n"1","x"\n"2","y\ny"\n')
    for size in (5, 1000):
        with tiny(spark, size):
            assert rows(csv_records(spark, str(tmp_path / "h.csv"))) == [('"1","x"',), ('"2","y\ny"',)]
    (tmp_path / "only.csv").write_text('"a","b"\n')
    (tmp_path / "none.csv").write_text("")
    with tiny(spark, 5):
        assert rows(csv_records(spark, str(tmp_path / "only.csv"))) == []
        assert rows(csv_records(spark, str(tmp_path / "none.csv"))) == []


def test_open_quotes_fail(spark, tmp_path):
    (tmp_path / "open.csv").write_text('"a","b"\n"1","x\n')
    with pytest.raises(ValueError, match="no end"):
        csv_records(spark, str(tmp_path / "open.csv"))


@pytest.mark.parametrize("size", [30, 250, 100_000])
@pytest.mark.parametrize("listed", [True, False])
def test_pretty_json_in_splits(spark, tmp_path, size, listed):
    data = odd_texts(size + 1, 40)
    records = [{"id": i, "a": a, "b": b, "more": {"x": [1, {"y": "]}"}]}} for i, a, b in data]
    text = json.dumps(records, indent=3) if listed else "\n".join(json.dumps(r, indent=1, ensure_ascii=False) for r in records)
    (tmp_path / "p.json").write_text(text + "\n")
    with tiny(spark, size):
        got = rows(scan_json_split(spark, str(tmp_path / "p.json"), SCHEMA), "id")
    assert got == sorted(data, key=repr)


def test_json_that_is_no_list_of_objects_fails(spark, tmp_path):
    for i, text in enumerate(("[1,\n2]", '[{"id": 1},\n{"id": 2}', "[{}]\n]", '{"id": 1} x', '["a"]')):
        (tmp_path / f"{i}.json").write_text(text)
        with pytest.raises(Exception):
            scan_json_split(spark, str(tmp_path / f"{i}.json"), SCHEMA).collect()
    (tmp_path / "empty.json").write_text("[\n]\n")
    assert rows(scan_json_split(spark, str(tmp_path / "empty.json"), SCHEMA)) == []


def test_changed_splits_are_noticed(spark, tmp_path):
    write_csv(spark.createDataFrame(odd_texts(3, 60), SCHEMA).coalesce(1), str(tmp_path / "csv"), exact=True)
    with tiny(spark, 50):
        lazy = read_csv_split(spark, str(tmp_path / "csv"), SCHEMA, exact=True)
    with tiny(spark, 33), pytest.raises(Exception, match="splits of a file have changed"):
        lazy.collect()


def sums_and_cuts(form, lines, cuts):
    """Records of lines dealt to splits at the cuts, put together as the reader does."""
    edges = sorted({0, len(lines), *[c % (len(lines) + 1) for c in cuts]})
    parts = [pa.array(lines[a:b], pa.string()) for a, b in zip(edges, edges[1:])]
    found, pending = [], []
    for part, (state, inside, ends) in zip(parts, form.states([form.measure(p) for p in parts])):
        cut, _ = form.cut(part, state)
        assert bool(pending) == inside
        # The end of the list itself is none of a record, and nothing goes on behind it.
        assert ends == (cut.head is not None or bool(cut.records)) or not inside
        if cut.head is not None:
            found.append("\n".join([*pending, cut.head]))
            pending = []
        found += cut.records
        if cut.tail is not None:
            pending.append(cut.tail)
    assert not pending
    return found


@examples(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet='a",\n', max_size=12), min_size=1, max_size=12), st.lists(st.integers(0, 50), max_size=6))
def test_quoted_records_in_any_splits(fields, cuts):
    records = ['"' + f.replace('"', '""') + '"' for f in fields]
    assert sums_and_cuts(CSV, "\n".join(records).split("\n"), cuts) == records


VALUE = st.recursive(
    st.one_of(st.none(), st.integers(), st.text(alphabet='a"\\{}[],\n', max_size=6)),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(st.text(alphabet='k"{', max_size=3), inner, max_size=3)),
    max_leaves=6,
)


@examples(max_examples=300, deadline=None)
@given(st.lists(st.dictionaries(st.text(alphabet="ab}", max_size=2), VALUE, max_size=3), max_size=5), st.lists(st.integers(0, 50), max_size=6), st.booleans())
def test_pretty_records_in_any_splits(records, cuts, listed):
    text = json.dumps(records, indent=1) if listed else "\n".join(json.dumps(r, indent=1) for r in records)
    assert [json.loads(r) for r in sums_and_cuts(JSON, text.split("\n"), cuts)] == records


@examples(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='a"', max_size=5), min_size=2, max_size=10), st.integers(1, 9))
def test_sums_of_parts_join(lines, cut):
    cut = min(cut, len(lines) - 1)
    column = pa.array(lines, pa.string())
    assert CSV.joined(CSV.measure(column[:cut]), CSV.measure(column[cut:])) == CSV.measure(column)
    brackets = pa.array([x.replace('"', "}").replace("a", "{") for x in lines], pa.string())
    assert JSON.joined(JSON.measure(brackets[:cut]), JSON.measure(brackets[cut:]))[:2] == JSON.measure(brackets)[:2]
