import datetime as dt

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F, types as T

from orderloom.functions import clean_name, entity_type, gid_key, manifest_type, resolve_date, snake, snake_text, split_list
from orderloom.operators.keys import primary_key
from orderloom.operators.filters import date_window, search, status_in
from orderloom.operators.reshape import first_n, tidy
from orderloom.plans.run import selected
from orderloom.schemas import ddl
from orderloom.session import has_shared_dir, scratch_path, shared_dir

from .conftest import rows


@pytest.mark.parametrize(
    "name, expected",
    [("createdAt", "created_at"), ("__parentId", "__parent_id"), ("countryCodeV2", "country_code_v2"),
     ("SKUCode", "sku_code"), ("id", "id"), ("InventoryLevel", "inventory_level")],
)
def test_snake(name, expected):
    assert snake(name) == expected


@given(st.from_regex(r"[A-Za-z][A-Za-z0-9_]{0,20}", fullmatch=True))
def test_snake_is_stable(name):
    once = snake(name)
    assert once == once.lower() and snake(once) == once


def test_snake_on_values(spark):
    names = ["createdAt", "__parentId", "countryCodeV2", "SKUCode", "aBCDef1Gh"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert rows(df.select("n", snake_text(F.col("n")))) == sorted((n, snake(n)) for n in names)


def test_gids(spark):
    ids = ["gid://shop/Order/5", "gid://other/LineItem/a/b", "gid://shop/Order", "x/gid://shop/Order/5", "", None]
    df = spark.createDataFrame([(i,) for i in ids], "i string")
    got = [tuple(r) for r in df.select(entity_type(F.col("i")), gid_key(F.col("i"))).collect()]
    assert got == [("Order", "5"), ("LineItem", "a/b"), (None, None), (None, None), (None, None), (None, None)]


def test_dates(spark):
    cases = {
        "now": dt.date(2024, 3, 31), "Today": dt.date(2024, 3, 31), " yesterday ": dt.date(2024, 3, 30),
        "1 week ago": dt.date(2024, 3, 24), "2 months ago": dt.date(2024, 1, 31), "1 month ago": dt.date(2024, 2, 29),
        "1 year ago": dt.date(2023, 3, 31), "10 days ago": dt.date(2024, 3, 21), "2024-02-01": dt.date(2024, 2, 1),
        "2024-02-01T10:00:00Z": dt.date(2024, 2, 1), "2024-02-30": None, "soon": None, "": None, "99999999999 days ago": None,
    }
    df = spark.createDataFrame([(t,) for t in cases] + [(None,)], "t string")
    got = df.select("t", resolve_date(F.col("t"), F.lit("2024-03-31").cast("date"), strict=False)).collect()
    assert {r[0]: r[1] for r in got} == {**cases, None: None}


def test_strict_dates_fail(spark):
    anchor = F.lit("2024-03-31").cast("date")
    good = spark.createDataFrame([("now",), ("",), (None,)], "t string")
    assert good.select(resolve_date(F.col("t"), anchor)).count() == 3
    assert len(good.select(resolve_date(F.col("t"), anchor).alias("d")).where("d is null").collect()) == 2
    with pytest.raises(Exception, match="not a date: soon"):
        spark.createDataFrame([("soon",)], "t string").select(resolve_date(F.col("t"), anchor)).collect()


def test_dates_are_strict_and_zones_count(spark):
    anchor = F.lit("2024-03-31").cast("date")
    texts = ["2024-01-02 rubbish", "2024-01-02x", "2024-01-02T23:30:00-05:00", "2024-01-02 10:00", "2024-02-30", "2024-01-02T01:00:00Z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r[0]: str(r[1]) if r[1] else None for r in df.select("t", resolve_date(F.col("t"), anchor, strict=False)).collect()}
    assert got == dict(zip(texts, [None, None, "2024-01-03", "2024-01-02", None, "2024-01-02"]))
    with pytest.raises(Exception, match="not a date"):
        df.limit(1).select(resolve_date(F.col("t"), anchor)).collect()


def test_clean_name(spark):
    df = spark.createDataFrame([("My Query-1",), ("  A-b C\t",)], "n string")
    assert rows(df.select(clean_name(F.col("n")))) == [("a_b_c",), ("my_query_1",)]


def test_split_list(spark):
    df = spark.createDataFrame([("a, b,,c ",), (None,)], "t string")
    assert [r[0] for r in df.select(split_list(F.col("t"))).collect()] == [["a", "b", "c"], None]


def test_manifest_types():
    expected = {
        "INTEGER": [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DecimalType(38, 0)],
        "NUMERIC": [T.DecimalType(10, 2)],
        "FLOAT": [T.DoubleType(), T.FloatType()],
        "BOOLEAN": [T.BooleanType()],
        "TIMESTAMP": [T.TimestampType(), T.TimestampNTZType()],
        "DATE": [T.DateType()],
        "STRING": [T.StringType(), T.BinaryType(), T.ArrayType(T.StringType()), T.MapType(T.StringType(), T.LongType())],
    }
    for name, kinds in expected.items():
        assert {manifest_type(k) for k in kinds} == {name}


def test_primary_keys(spark):
    def key(name, *columns):
        return primary_key(name, spark.createDataFrame([], ", ".join(f"{c} string" for c in columns)))

    assert key("inventory_level", "id") == ["parent_id", "id"]
    assert key("order", "id") == ["id"]
    assert key("order_transactions", "parent_id", "row_number", "id") == ["parent_id", "row_number"]
    assert key("order_customer", "parent_id", "id") == ["parent_id"]
    assert key("product_variant", "id", "title") == ["id"]
    assert key("document", "id") == ["id"]
    assert key("things", "a") == []
    linked = tidy(spark.createDataFrame([], "id string, __parentId string, title string"))
    assert primary_key("line_item", linked) == ["parent_id", "id"]
    assert primary_key("line_item", linked.select("title", "parent_id", "id")) == ["parent_id", "id"]


def test_window_sides(spark):
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-05')) d")
    count = lambda **w: date_window(df, "d", **w).count()
    assert [count(), count(since="2024-01-02"), count(to="2024-01-02"), count(since="2024-01-02", to="2024-01-04")] == [5, 4, 1, 2]
    assert count(since="2024-01-02", to="2024-01-04", closed=True) == 3


def test_no_status_no_rows(spark):
    df = spark.createDataFrame([("ACTIVE",)], "status string")
    assert status_in(df, []).isEmpty() and status_in(df, ["active"]).count() == 1


def test_search_and_first_n(spark):
    df = spark.sql("select id, array(1, 2, 3) xs from range(10)")
    assert rows(search(df, [("id", ">", 3), ("id", "<=", 5)]).select("id")) == [(4,), (5,)]
    assert search(df, []).count() == 10
    assert first_n(df, "xs", 2).first()["xs"] == [1, 2]


def test_selection_order():
    assert selected(["locations", "products_drafts", "orders", "products"], events=True) == ["product", "order", "location", "event"]
    with pytest.warns(UserWarning, match="unknown"):
        assert selected(["customers_legacy", "inventory_items", "unknown"]) == ["inventory_items", "customers_legacy"]
    assert selected([]) == []


def test_contracts_with_two_shapes():
    with pytest.raises(ValueError):
        ddl({"a": "int"}, {"a": "string"})


def test_intermediate_data_goes_to_the_shared_folder(spark):
    folder = shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir") and has_shared_dir(spark)
    assert scratch_path(spark, "x").startswith(f"{folder}/orderloom/") and scratch_path(spark, "x") != scratch_path(spark, "x")
