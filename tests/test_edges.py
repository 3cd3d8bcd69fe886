"""Hand-written inputs for the odd shapes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from orderloom.operators.curated import order_line_items
from orderloom.operators.filters import STAGED_TYPE
from orderloom.operators.inference import text_kinds
from orderloom.operators.reshape import array_child, non_empty, object_child, tidy
from orderloom.plans.normalise import normalise, normalise_fixed, stage
from orderloom.schemas import PAGED_ORDER, dataset_schema, page
from orderloom.sources.bulk import (
    entity_keys,
    list_entity_keys,
    scan_bulk,
    scan_by_entity,
    scan_inferred,
    scan_lines,
)
from orderloom.sources.pages import flatten_pages, scan_json_array, scan_pages

from .conftest import rows


def test_null_and_empty_lists_give_no_child_rows(spark, jsonl):
    path = jsonl(
        {"id": "gid://shop/A/1", "xs": None}, {"id": "gid://shop/A/2", "xs": []}, {"id": "gid://shop/A/3", "xs": [{"u": 1}]}
    )
    df = scan_bulk(spark, path, "id string, xs array<struct<u:int>>")
    assert rows(array_child(df, "xs")) == [("gid://shop/A/3", 1, 1)]
    assert rows(non_empty(df, "xs").select("id")) == [("gid://shop/A/3",)]


def test_null_struct_keeps_its_text_and_row(spark, jsonl):
    path = jsonl({"id": "1", "money": {"shopMoney": None}}, {"id": "2", "money": None})
    df = scan_bulk(spark, path, "id string, money struct<shopMoney:struct<amount:string>>")
    assert rows(tidy(df)) == [("1", '{"shopMoney":null}'), ("2", None)]
    assert rows(object_child(df, "money")) == [("1", None)]


def test_late_key_is_kept(spark, jsonl):
    path = jsonl(*[{"id": str(i)} for i in range(50_000)], {"id": "last", "late": 7})
    df = scan_bulk(spark, path)
    assert df.where("late = 7").count() == 1


def test_mixed_type_is_text(spark, jsonl):
    df = scan_bulk(spark, jsonl({"v": 1}, {"v": "s"}))
    assert rows(df) == [("1",), ("s",)]


def test_date_like_text(spark, jsonl):
    first = {"d": "2024-01-02", "t": "2024-01-02T03:04:05Z", "h": "10:11:12", "m": "12.50", "bad": "2024-02-30"}
    df = scan_bulk(spark, jsonl(first, {"d": None, "t": None, "h": None, "m": None, "bad": None}))
    assert dict(df.dtypes) == {"bad": "string", "d": "date", "h": "string", "m": "string", "t": "timestamp"}
    shown = df.where("d is not null").select("d", F.col("t").cast("timestamp_ntz"), "h", "m").first()
    assert tuple(shown) == (dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5), "10:11:12", "12.50")


def test_only_nulls_are_not_promoted(spark):
    assert text_kinds(spark.createDataFrame([(None,)], "x string")) == {}


def test_lines_without_global_id(spark, jsonl):
    path = jsonl({"id": "gid://shop/A/1", "a": 1}, {"a": 2}, {"id": "plain", "b": 3})
    assert rows(entity_keys(scan_lines(spark, path))) == [("A", "a"), ("A", "id")]
    df = scan_bulk(spark, path, "id string, a int, b int")
    outputs = normalise(df, "things", list_entity_keys(scan_lines(spark, path)))
    assert list(outputs) == ["things"]
    assert outputs["things"].count() == 3


def test_single_entity_keeps_dataset_name_and_renames_link(spark, jsonl):
    path = jsonl({"id": "gid://shop/LineItem/1", "__parentId": "gid://shop/Order/9"})
    outputs = normalise(scan_bulk(spark, path), "my_export")
    assert list(outputs) == ["my_export"]
    assert rows(outputs["my_export"].select("parent_id")) == [("gid://shop/Order/9",)]


def test_entities_get_their_own_columns(spark, jsonl):
    path = jsonl(
        {"id": "gid://shop/Order/1", "totalCount": 2}, {"id": "gid://shop/LineItem/1", "qty": 1, "__parentId": "gid://shop/Order/1"}
    )
    outputs = normalise(scan_bulk(spark, path), "x", list_entity_keys(scan_lines(spark, path)))
    assert {n: sorted(df.columns) for n, df in outputs.items()} == {
        "order": ["id", "total_count"],
        "line_item": ["id", "parent_id", "qty"],
    }


def test_empty_export(spark, jsonl):
    df = scan_bulk(spark, jsonl(), dataset_schema("order"))
    outputs = normalise_fixed(stage(spark, df, "order"), "order")
    assert len(outputs) == 11 and all(out.isEmpty() for out in outputs.values())


def test_one_field_with_two_shapes(spark, jsonl):
    path = jsonl({"id": "gid://shop/A/1", "v": {"x": 1}}, {"id": "gid://shop/B/1", "v": "text"})
    parts = scan_by_entity(
        spark, path, {"A": {"id": "string", "v": "struct<x:int>"}, "B": {"id": "string", "v": "string"}}
    )
    assert rows(parts["A"].select("v.x")) == [(1,)]
    assert rows(parts["B"].select("v")) == [("text",)]


def test_malformed_line_fails(spark, jsonl):
    path = jsonl('{"id": "gid://shop/A/1"', {"id": "gid://shop/A/2"})
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_bulk(spark, path, "id string").collect()


def test_nested_values_below_a_child_stay_text(spark, jsonl):
    path = jsonl({"id": "1", "txs": [{"amountSet": {"shopMoney": {"amount": "1.00"}}, "kind": "SALE"}]})
    child = array_child(scan_bulk(spark, path), "txs")
    assert rows(child) == [("1", 1, '{"shopMoney":{"amount":"1.00"}}', "SALE")]


def test_maps_become_text(spark):
    df = spark.sql("select '1' id, map('a', 1) m")
    outputs = normalise(df, "x")
    assert list(outputs) == ["x"]
    assert rows(outputs["x"]) == [("1", '{"a":1}')]


def test_pages_without_edges(spark, jsonl):
    node = {"id": "gid://shop/Order/1", "lineItems": {"edges": [{"node": {"id": "a", "quantity": 2}}]}}
    path = jsonl({"orders": {"pageInfo": {"hasNextPage": True}, "edges": [{"node": node}]}}, {"orders": {"edges": []}}, {"orders": None})
    docs = flatten_pages(scan_pages(spark, path, page("orders", PAGED_ORDER)), "orders")
    assert docs.count() == 1
    items = order_line_items(docs).select("orderId", "row_number", "lineItemId", "quantity", "variantId")
    assert rows(items) == [("gid://shop/Order/1", 1, "a", 2, None)]


def test_pretty_array(spark, tmp_path):
    path = tmp_path / "array.json"
    path.write_text(json.dumps([{"id": "1", "n": 1}, {"id": "2", "n": 2}], indent=2))
    assert rows(scan_json_array(spark, str(path), "id string, n int", pretty=True)) == [("1", 1), ("2", 2)]


def test_inferred_types_and_keys(spark, jsonl):
    path = jsonl(
        {"id": "gid://s/A/1", "n": 1, "x": 1.5, "only_null": None, "xs": [{"a": 1}], "odd key": {"VOID": "v"}, "m": 1, "e": {}},
        {"id": "gid://s/A/2", "n": 12345678901234567890, "xs": [{"b": 2.25}], "m": {"z": 1}},
        {"id": "gid://s/B/1", "t": "text", "VOID": 3},
        {"no_id": True},
    )
    df, keys = scan_inferred(spark, path)
    assert keys == {"A": ["e", "id", "m", "n", "odd key", "only_null", "x", "xs"], "B": ["VOID", "id", "t"]}
    assert dict(df.drop(STAGED_TYPE).dtypes) == {
        "VOID": "bigint", "e": "string", "id": "string", "m": "string", "n": "decimal(20,0)", "no_id": "boolean",
        "odd key": "struct<VOID:string>", "only_null": "string", "t": "string", "x": "double",
        "xs": "array<struct<a:bigint,b:double>>",
    }
    assert rows(df.where("id like '%/A/%'").select("m", "e", "xs")) == [("1", "{}", [(1, None)]), ('{"z":1}', None, [(None, 2.25)])]
    outputs = normalise(df, "x", keys)
    assert outputs["a"].columns == keys["A"][:4] + ["odd key", "only_null", "x", "xs"]
    assert rows(outputs["x_odd key"]) == [("gid://s/A/1", "v")]


def test_inference_without_lines(spark, jsonl):
    assert scan_bulk(spark, jsonl()).columns == []


def test_inference_wants_objects(spark, jsonl):
    with pytest.raises(ValueError, match="one JSON object per line"):
        scan_bulk(spark, jsonl("[1, 2]"))
