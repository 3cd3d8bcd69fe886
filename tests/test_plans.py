"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from checks.fixtures import landed, table
from orderloom import schemas
from orderloom.operators.filters import date_window, of_entity
from orderloom.operators.loads import latest_per_key
from orderloom.operators.relations import attach_parent, linked_to, nest_connections, orphans, with_children
from orderloom.operators.reshape import array_child, object_child
from orderloom.plans.normalise import normalise_fixed, stage
from orderloom.sources.bulk import scan_bulk

from .conftest import SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark):
    return scan_bulk(spark, landed(spark, SMALL, "order"), schemas.dataset_schema("order"))


@pytest.fixture(scope="module")
def staged(spark, orders):
    return stage(spark, orders, "order")


def test_entity_prefix_reaches_the_json_scan(orders):
    assert "StringStartsWith(id,gid://shop/LineItem/)" in plan(of_entity(orders, "LineItem", app="shop").select("id", "sku"))


def test_json_scan_reads_wanted_columns_only(orders):
    text = plan(orders.select("id", "sku"))
    assert "ReadSchema: struct<id:string,sku:string>" in text


def test_window_reaches_the_scan(spark):
    text = plan(date_window(table(spark, SMALL, "events"), "ts", "2024-01-10", "2024-01-12").select("event_id"))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_staged_outputs_read_their_folder_and_fields(staged):
    outputs = normalise_fixed(staged, "order")
    text = plan(outputs["line_item"].select("id"))
    assert "PartitionFilters: [isnotnull(__entity" in text and "LineItem" in text
    text = plan(outputs["order_customer"].select("parent_id", "email"))
    assert "customer:struct<email:string>" in text and "PartitionFilters: [isnotnull(__entity" in text


def test_child_tables_do_not_shuffle(orders):
    for child in (array_child(orders, "transactions"), object_child(orders, "customer")):
        assert "Exchange" not in plan(child)


def test_limits_per_key_run_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    assert "WindowGroupLimit" in plan(latest_per_key(df, ["k"], [F.col("id").desc()]))
    parents = spark.range(3).select("id")
    text = plan(with_children(parents, df.withColumnRenamed("id", "c"), 2, ["c"], ["c"], link="k"))
    before_shuffle = text.split("Exchange hashpartitioning(k")[1]
    assert "WindowGroupLimit [k" in before_shuffle and ", Partial" in before_shuffle


@pytest.fixture
def small_skew_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_parent_is_split_among_tasks(spark, small_skew_limits):
    parent = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).cast("string")
    children = spark.range(0, 300_000, 1, 16).select(
        parent.alias("parent_id"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    )
    parents = spark.range(4000).select(F.col("id").cast("string").alias("id"), F.col("id").alias("size"))
    assert "skew=true" in final_plan(attach_parent(children, parents, ["size"]))
    assert "skew=true" in final_plan(orphans(children, parents))
    links = children.withColumnsRenamed({"parent_id": "__parentId", "payload": "id"})
    roots = parents.select("id", F.lit(None).cast("string").alias("__parentId"))
    assert "skew=true" in final_plan(linked_to(roots.union(links.select("id", "__parentId")), roots, 1))


def test_many_parts_of_a_parent_are_split_among_tasks(spark, small_skew_limits):
    link = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).cast("string")
    parts = spark.range(0, 300_000, 1, 16).select(link.alias("link"), F.sha2(F.col("id").cast("string"), 256).alias("edges"))
    parents = spark.range(6000).select(F.col("id").cast("string").alias("id"))
    assert "skew=true" in final_plan(nest_connections(parents, parts, "id", "link"))


def test_copies_of_a_parent_are_dropped_before_the_join(spark, small_skew_limits):
    children = spark.range(1000).select(F.col("id").cast("string").alias("parent_id"))
    copies = spark.range(0, 300_000, 1, 16).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("id"))
    text = plan(orphans(children, copies))
    right = text.split("SortMergeJoin")[1]
    assert right.count("HashAggregate(keys=[__key") == 2 and right.count("Exchange hashpartitioning(__key") == 2
    assert orphans(children, copies).count() == sum(1 for i in range(1000) if i and i % 3 == 0)


def test_no_explicit_broadcast_of_data():
    from pathlib import Path

    for path in Path(__file__).resolve().parents[1].joinpath("orderloom").rglob("*.py"):
        if "llm" in path.parts:  # trained models of fixed size are sent to tasks there
            continue
        source = path.read_text()
        assert "broadcast(" not in source and "localCheckpoint" not in source and "crossJoin" not in source, path
