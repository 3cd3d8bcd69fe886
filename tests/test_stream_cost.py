"""What landing and reading a dataset shuffle."""

import json

import pytest
from pyspark.sql import functions as F

from orderloom.streaming import dataset as D

from .conftest import rows
from .test_stream_dataset import arrive, item, kinds, land, order, orders


def test_tables_of_lines_that_came_once_are_read_without_a_shuffle(spark, tmp_path):
    records = [order(i, 1, "A", "B") for i in range(20)] + [item(i, i % 20, i) for i in range(40)]
    for i in range(2):
        arrive(tmp_path / "in", f"{i}.json", *records[i::2])
    land(spark, tmp_path, files_per_batch=1)
    for name, df in D.read_dataset(spark, str(tmp_path / "out")).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan, name


def test_only_lines_with_several_versions_are_compared(spark, tmp_path, monkeypatch):
    compared = []
    newest_lines = D.newest_lines

    def seen(batch, newest):
        compared.extend(r["id"] for r in batch.select("id").collect())
        return newest_lines(batch, newest)

    monkeypatch.setattr(D, "newest_lines", seen)
    schema = D.dataset_schema("order")
    lines = [order(1, 1, "A"), order(1, 3, "B", "C"), order(2, 2, "D"), item(7, 1, 1), item(7, 2, 2), {"email": "x"}, {"email": "x"}]
    (tmp_path / "in.json").write_text("".join(json.dumps(r) + "\n" for r in lines))
    target = str(tmp_path / "out")
    D.land_batch(spark, spark.read.schema(schema).json(str(tmp_path / "in.json")), 0, "order", target)
    assert compared == ["gid://s/Order/1"] * 2
    assert orders(spark, target) == [("1", "v3"), ("2", "v2")]
    assert kinds(spark, target) == [("1", 1, "B"), ("1", 2, "C"), ("2", 1, "D")]
    items = D.read_dataset_table(spark, target, "line_item")
    assert rows(items.select(F.substring_index("parent_id", "/", -1), "quantity")) == [("1", 1), ("2", 2)]
    assert D.read_dataset_table(spark, target, "order_rest").count() == 2


@pytest.mark.parametrize("again", [1, 2])
def test_a_line_below_several_owners(spark, tmp_path, again):
    """A new version below one owner leaves the line below the other as it was."""
    arrive(tmp_path / "in", "1.json", order(1, 1, "A"), order(2, 1, "B"), item(7, 1, 10), item(7, 2, 20))
    land(spark, tmp_path)
    arrive(tmp_path / "in", "2.json", item(7, again, 30))
    land(spark, tmp_path)
    items = D.read_dataset_table(spark, str(tmp_path / "out"), "line_item")
    assert rows(items.select(F.substring_index("parent_id", "/", -1), "quantity")) == sorted(
        {("1", 10), ("2", 20), (str(again), 30)} - {(str(again), 10 * again)}
    )


def test_a_repeated_attempt_leaves_nothing_of_the_one_before(spark, tmp_path):
    schema, target = D.dataset_schema("order"), str(tmp_path / "out")
    for records in ([order(1, 1, "A"), {"id": "note", "email": "x"}], [order(1, 1, "A")]):
        (tmp_path / "in.json").write_text("".join(json.dumps(r) + "\n" for r in records))
        D.land_batch(spark, spark.read.schema(schema).json(str(tmp_path / "in.json")), 0, "order", target)
    assert not (tmp_path / "out" / "order_rest" / "batch_id=0").exists()
