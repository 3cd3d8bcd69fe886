import datetime as dt

from orderloom.functions import date_bound, dataset_name
from orderloom.operators.loads import upsert
from orderloom.plans.run import entity_counts, run_selected
from orderloom.schemas import DATASETS
from orderloom.sources import datasets
from orderloom.sources.bulk import scan_bulk
from orderloom.schemas import dataset_schema

import pytest
from pyspark.sql import functions as F

from checks.fixtures import landed

from .conftest import SMALL, rows


def test_bounds(spark):
    anchor = dt.date(2024, 3, 31)
    texts = ["2 months ago", "2024-01-05", "now", "", None, dt.date(2024, 1, 1)]
    assert [date_bound(spark, t, anchor) for t in texts] == ["2024-01-31", "2024-01-05", "2024-03-31", None, None, "2024-01-01"]
    with pytest.raises(Exception, match="not a date"):
        date_bound(spark, "soon")


def test_dataset_names(spark):
    assert dataset_name(" My Query-1 ") == "my_query_1"
    with pytest.raises(ValueError):
        datasets.custom(spark, "  ", "/nowhere")


def paths(spark):
    return lambda name: landed(spark, SMALL, name)


def test_transactions_are_optional(spark):
    with_ = run_selected(spark, paths(spark), ["orders", "order_transactions"])["order"]
    without = run_selected(spark, paths(spark), ["orders"])["order"]
    assert set(with_) - set(without) == {"order_transactions"}
    assert "transactions" in with_["order"].columns and "transactions" not in without["order"].columns
    assert without["order"].count() == 1500 and without["line_item"].count() == 6000


def test_windowed_run_keeps_whole_orders(spark):
    out = run_selected(spark, paths(spark), ["orders"], since="1997-01-01", to="1998-01-01", field="created_at")["order"]
    ids = out["order"].select(F.col("id").alias("parent_id"))
    assert 0 < out["order"].count() < 1500
    assert out["line_item"].join(ids, "parent_id", "left_anti").isEmpty()
    everything = scan_bulk(spark, landed(spark, SMALL, "order"), dataset_schema("order"))
    kept = everything.join(ids, everything["__parentId"] == ids["parent_id"], "left_semi").count()
    assert out["line_item"].count() == kept


def test_sum_of_child_rows_is_sum_of_list_sizes(spark):
    df = scan_bulk(spark, landed(spark, SMALL, "order"), dataset_schema("order"))
    out = run_selected(spark, paths(spark), ["orders", "order_transactions"])["order"]["order_transactions"]
    assert out.count() == df.agg(F.sum(F.array_size("transactions"))).first()[0]


def test_entity_counts_cover_every_contract(spark):
    for name, entities in DATASETS.items():
        df = scan_bulk(spark, landed(spark, SMALL, name), dataset_schema(name))
        counts = {r["output"]: r["rows"] for r in entity_counts(df).collect()}
        assert len(counts) == len(entities) and sum(counts.values()) == df.count()


def test_columns_that_one_side_lacks(spark):
    base = spark.createDataFrame([("a", 1)], "id string, old int")
    increment = spark.createDataFrame([("b", 2)], "id string, new int")
    assert rows(upsert(base, increment, ["id"], [F.col("id")])) == [("a", 1, None), ("b", None, 2)]
