"""No row is lost, repeated or changed on input that the exports never hold."""

import json

import pytest
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.operators.entities import list_entity_types
from orderloom.operators.filters import event_filter, status_in
from orderloom.operators.inference import text_kinds
from orderloom.plans.normalise import normalise, normalise_fixed, stage
from orderloom.sinks.outputs import load_all
from orderloom.sources import datasets
from orderloom.sources.bulk import list_entity_keys, scan_bulk, scan_lines

from .conftest import rows

LINES = [
    {"id": "gid://shop/Product/1", "title": "a", "tags": ["x", "y"]},
    {"id": "gid://shop/ProductVariant/2", "__parentId": "gid://shop/Product/1", "price": "1"},
    {"id": "gid://shop/MediaImage/3", "__parentId": "gid://shop/Product/1", "title": "image"},
    {"id": "plain", "title": "b"},
    {"title": "c"},
]


@pytest.mark.parametrize("staged", [False, True])
def test_every_line_reaches_an_output(spark, jsonl, staged):
    frame = scan_bulk(spark, jsonl(*LINES), schemas.dataset_schema("product"))
    frame = stage(spark, frame, "product") if staged else frame
    outputs = normalise_fixed(frame, "product")
    tables = [n for n in outputs if not n.startswith("product_") or n in ("product_variant", "product_image", "product_rest")]
    assert sum(outputs[n].count() for n in tables) == len(LINES)
    assert rows(outputs["media_image"].select("id", "title", "parent_id")) == [("gid://shop/MediaImage/3", "image", "gid://shop/Product/1")]
    assert rows(outputs["product_rest"].select("id", "title")) == [("plain", "b"), (None, "c")]
    assert outputs["product_tags"].count() == 2


def test_custom_exports_keep_lines_without_id(spark, jsonl):
    path = jsonl(*LINES)
    name, frame, keys = datasets.custom(spark, "Mine", path)
    outputs = normalise(frame, name, keys)
    assert outputs["mine_rest"].count() == 2 and outputs["media_image"].count() == 1


def test_any_number_of_types_and_keys(spark):
    ids = spark.range(1100).select(F.concat(F.lit("gid://shop/T"), F.col("id"), F.lit("/1")).alias("id"))
    assert len(list_entity_types(ids)) == 1100
    lines = ids.select(F.to_json(F.struct("id", F.lit(1).alias("x"))).alias("value"))
    assert len(list_entity_keys(lines)) == 1100


def test_fine_fractions_stay_text(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.123456789Z", "2024-01-02T03:04:05.123456Z")], "a string, b string")
    assert text_kinds(df) == {"b": "timestamp"}


def page(key, nodes):
    return json.dumps({key: {"edges": [{"node": n} for n in nodes]}})


def test_a_continued_owner_is_one_row(spark, jsonl):
    def part(number, offset, status="DRAFT"):
        variants = {"offset": offset, "edges": [{"node": {"id": f"v{number}-{offset}"}}]}
        return {"id": f"p{number}", "status": status, "variants": variants}

    parts = [part(1, 0), part(1, 250), part(1, 500), part(2, 0, "ARCHIVED"), part(2, 250, "ARCHIVED"), part(3, 0)]
    pages = spark.read.schema(schemas.page("products", schemas.PAGED_PRODUCT)).json(jsonl(page("products", parts)))
    assert rows(datasets.products_paged(pages).select("id")) == [("p1",), ("p2",), ("p3",)]
    assert rows(datasets.product_drafts(pages).select("id")) == [("p1",), ("p3",)]
    assert rows(datasets.products_archived(pages).select("id")) == [("p2",)]
    assert rows(datasets.products_paged(pages, max_items=2).select("id")) == [("p1",), ("p2",)]


def test_max_items_counts_orders(spark, jsonl):
    docs = [{"id": f"o{i}", "createdAt": "2024-01-01T00:00:00Z", "lineItems": {"offset": k, "edges": []}} for i in (1, 2, 3) for k in (0, 250)]
    pages = spark.read.schema(schemas.page("orders", schemas.PAGED_ORDER)).json(jsonl(page("orders", docs)))
    assert rows(datasets.orders_paged(pages, max_items=2).select("id", "lineItems.offset")) == [("o1", 0), ("o1", 250), ("o2", 0), ("o2", 250)]


def test_statuses_and_verbs_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("ACTIVE", "click"), ("draft", "view")], "status string, action string").write.parquet(path)
    stored = spark.read.parquet(path)
    for df in (status_in(stored, ["active"]), event_filter(stored, ["Click"])):
        assert "In(" in df._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1].split("]")[0] + ")"
        assert df.count() == 1


def test_events_by_resource(spark):
    log = spark.createDataFrame([("gid://shop/Event/1", "gid://shop/Order/1", None), ("gid://shop/Event/2", "gid://shop/Product/1", None)], "id string, subject string, createdAt timestamp")
    assert rows(datasets.events(log, resources=["order"]).select("id")) == [("gid://shop/Event/1",)]
    with pytest.raises(ValueError, match="subject"):
        datasets.events(log.drop("subject"), resources=["order"])


def test_curated_tables_load_twice_as_once(spark, tmp_path):
    lines = spark.createDataFrame([("o1", 1, "a"), ("o1", 2, "b")], "order_id string, row_number int, title string")
    levels = spark.createDataFrame([("i1", "l1", 3)], "inventory_item_id string, level_id string, available int")
    outputs = {"order_line_items": lines, "inventory_levels": levels}
    versions = [str(tmp_path / v) for v in ("v1", "v2", "v3")]
    for before, version in zip([None, *versions], versions):
        load_all(spark, outputs, before, version)
    assert spark.read.parquet(f"{versions[2]}/order_line_items").count() == 2
    assert spark.read.parquet(f"{versions[2]}/inventory_levels").count() == 1


def test_scan_lines_keep_everything(spark, jsonl):
    assert scan_lines(spark, jsonl("x", "", "y")).count() == 3
