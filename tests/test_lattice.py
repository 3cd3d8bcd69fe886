import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F, types as T

from orderloom.operators.filters import STAGED_TYPE
from orderloom.operators.inference import promote_types
from orderloom.operators.lattice import brought_together, conform, join_all, join_schemas, join_types
from orderloom.plans.normalise import normalise, normalise_fixed, stage
from orderloom.sinks.outputs import load_all
from orderloom.sources import datasets
from orderloom.sources.bulk import infer_schema, parsed_lines, scan_bulk, scan_inferred, scan_lines

from .conftest import rows

PLAIN = [
    T.NullType(), T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
    T.DecimalType(10, 2), T.DecimalType(20, 0), T.DecimalType(38, 0), T.DecimalType(38, 30), T.DateType(), T.TimestampType(),
    T.TimestampNTZType(), T.BinaryType(), T.StringType(), T.VariantType(),
]


def nested(inner):
    fields = st.dictionaries(st.sampled_from("abcd"), inner, max_size=3)
    structs = fields.map(lambda d: T.StructType([T.StructField(k, v) for k, v in d.items()]))
    return st.one_of(structs, inner.map(T.ArrayType), inner.map(lambda v: T.MapType(T.StringType(), v)))


TYPES = st.recursive(st.sampled_from(PLAIN), nested, max_leaves=8)


def same(kind):
    """A type without the order of its fields."""
    if isinstance(kind, T.StructType):
        return {f.name: same(f.dataType) for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        return [same(kind.elementType)]
    return ("map", same(kind.valueType)) if isinstance(kind, T.MapType) else kind


@settings(max_examples=1500, deadline=None)
@given(TYPES, TYPES, TYPES)
def test_joins_come_in_any_order_and_grouping(a, b, c):
    left, right = join_types(join_types(a, b), c), join_types(a, join_types(b, c))
    assert same(left) == same(right)
    assert same(join_types(a, b)) == same(join_types(b, a))
    both = join_types(a, b)
    assert same(join_types(both, a)) == same(both) == same(join_types(both, both))


def test_joins(spark):
    kind = lambda text: T.StructType.fromDDL(f"x {text}")[0].dataType
    for a, b, want in (
        ("date", "timestamp", "timestamp"), ("date", "string", "string"), ("int", "bigint", "bigint"), ("bigint", "double", "double"),
        ("bigint", "decimal(10,2)", "decimal(21,2)"), ("decimal(38,0)", "decimal(38,30)", "double"), ("boolean", "int", "string"),
        ("struct<a:int>", "string", "string"), ("array<int>", "struct<a:int>", "string"), ("void", "date", "date"),
        ("struct<a:int,b:date>", "struct<b:string,c:int>", "struct<a:int,b:string,c:int>"), ("array<int>", "array<double>", "array<double>"),
    ):
        assert join_types(kind(a), kind(b)).simpleString() == want


VALUES = st.one_of(
    st.none(), st.booleans(), st.integers(-5, 5), st.just(2**40), st.just(1.5), st.sampled_from(["text", "2024-01-31", "2024-01-31T10:00:00Z"]),
    st.lists(st.sampled_from([1, 2.5, "x", None]), max_size=2), st.dictionaries(st.sampled_from("pq"), st.sampled_from([1, "y", None, 0.5]), max_size=2),
)


def test_schema_of_parts_is_schema_of_the_whole(spark):
    @settings(max_examples=12, deadline=None)
    @given(st.lists(st.dictionaries(st.sampled_from("abc"), VALUES), min_size=2, max_size=6), st.integers(1, 5))
    def check(records, cut):
        def schema(part):
            lines = spark.createDataFrame([(json.dumps(r),) for r in part], "value string")
            return infer_schema(parsed_lines(lines))[0]

        whole, parts = schema(records), [schema(records[:cut]), schema(records[cut:])]
        # Of a part, no value is read as text; only void and text may then differ.
        joined = {f.name: f.dataType for f in join_all(parts).fields}
        for field in whole.fields:
            assert joined[field.name] == field.dataType or joined[field.name] == T.StringType() or isinstance(field.dataType, (T.StructType, T.ArrayType))

    check()


def test_values_of_joined_types(spark):
    one = spark.sql(
        "select 1 id, date'2024-01-31' d, 7 n, timestamp'2024-01-31 10:00:00.5' t, named_struct('p', 1, 'q', 'x') s, array(1, 2) xs, map('k', 1) m, true b"
    )
    two = spark.sql("select 2 id, 'soon' d, 2.5D n, 'later' t, named_struct('q', 'y', 'r', 3) s, array(1.5D) xs, map('k', 2.5D) m, 'maybe' b, 9 extra")
    a, b = brought_together(one, two)
    assert a.dtypes == b.dtypes
    got = rows(a.unionByName(b), "id")
    assert got == [
        (1, "2024-01-31", 7.0, "2024-01-31T10:00:00.5Z", (1, "x", None), [1.0, 2.0], {"k": 1.0}, "true", None),
        (2, "soon", 2.5, "later", (None, "y", 3), [1.5], {"k": 2.5}, "maybe", 9),
    ]
    null = conform(spark.sql("select cast(null as struct<p:int>) s"), T.StructType.fromDDL("s struct<p:bigint,q:string>"))
    assert rows(null) == [(None,)]


def test_columns_without_values_take_the_other_type(spark):
    one = spark.sql("select 1 id, cast(null as string) a, cast(null as string) b, 'x' c")
    two = spark.sql("select 2 id, date'2024-01-31' a, cast(null as string) b, cast(null as string) c")
    joined = brought_together(one, two)[0]
    assert dict(joined.dtypes) == {"id": "int", "a": "date", "b": "string", "c": "string"}
    assert dict(brought_together(two, one)[1].dtypes) == dict(joined.dtypes)


def load(spark, jsonl, tmp_path, *loads):
    current = None
    for i, records in enumerate(loads):
        name, frame, keys = datasets.custom(spark, "d", jsonl(*records, name=f"{i}.jsonl"))
        outputs = normalise(stage(spark, frame, name), name, keys, promote=True)
        load_all(spark, outputs, current, str(tmp_path / f"v{i}"))
        current = str(tmp_path / f"v{i}")
    return spark.read.parquet(f"{current}/d")


def test_a_date_then_text_loads(spark, jsonl, tmp_path):
    first = [{"id": "gid://s/A/1", "d": "2024-01-31"}, {"id": "gid://s/A/2", "d": "2024-02-01"}]
    second = [{"id": "gid://s/A/2", "d": "soon"}, {"id": "gid://s/A/3", "d": "2024-03-01"}]
    table = load(spark, jsonl, tmp_path, first, second)
    assert rows(table.select("id", "d")) == [("gid://s/A/1", "2024-01-31"), ("gid://s/A/2", "soon"), ("gid://s/A/3", "2024-03-01")]
    back = load(spark, jsonl, tmp_path / "back", second, first)
    assert rows(back.select("id", "d")) == [("gid://s/A/1", "2024-01-31"), ("gid://s/A/2", "2024-02-01"), ("gid://s/A/3", "2024-03-01")]


def test_dates_and_instants_are_instants(spark):
    df = spark.createDataFrame([("2024-01-31", "2024-01-31"), ("2024-02-01T10:00:00Z", None)], "a string, b string")
    assert rows(promote_types(df)) == [(dt.datetime(2024, 1, 31), dt.date(2024, 1, 31)), (dt.datetime(2024, 2, 1, 10), None)] or dict(
        promote_types(df).dtypes
    ) == {"a": "timestamp", "b": "date"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_custom_export_is_parsed_once(spark, jsonl):
    path = jsonl({"id": "gid://s/A/1", "x": 1}, {"id": "gid://s/B/1", "y": "2024-01-31"}, {"x": 2})
    df, keys = scan_inferred(spark, path)
    text = plan(df)
    assert "Scan text" not in text and "FileScan text" not in text and "Expand" not in text and "from_json" not in text
    records = parsed_lines(scan_lines(spark, path))
    once = plan(records)
    assert once.count("FileScan text") == 1 and "get_json_object" not in once
    aggregate = plan(records.groupBy(STAGED_TYPE).agg(F.schema_of_variant_agg("record")))
    assert "Expand" not in aggregate
    assert keys == {"A": ["id", "x"], "B": ["id", "y"]}
    assert rows(df.drop(STAGED_TYPE)) == [("gid://s/A/1", 1, None), ("gid://s/B/1", None, "2024-01-31"), (None, 2, None)]


def test_one_type_contracts_split_foreign_lines(spark, jsonl):
    schema = "id string, email string"
    customer, image, note = {"id": "gid://s/Customer/1", "email": "e"}, {"id": "gid://s/MediaImage/1"}, {"id": "plain"}
    outputs = normalise_fixed(stage(spark, scan_bulk(spark, jsonl(customer, image, note), schema), "customer"), "customer")
    assert {name: rows(df.select("id")) for name, df in outputs.items()} == {
        "customer": [("gid://s/Customer/1",)], "media_image": [("gid://s/MediaImage/1",)], "customer_rest": [("plain",)],
    }
    alone = normalise_fixed(stage(spark, scan_bulk(spark, jsonl(customer, name="b.jsonl"), schema), "customer"), "customer")
    assert list(alone) == ["customer"]
    plain = normalise(scan_bulk(spark, jsonl(note, name="c.jsonl"), schema), "notes")
    assert {name: rows(df) for name, df in plain.items()} == {"notes": [("plain", None)]}
    with_rest = normalise_fixed(scan_bulk(spark, jsonl(customer, note, name="d.jsonl"), schema), "location")
    assert set(with_rest) == {"location", "customer", "location_rest"}
    one_type = normalise_fixed(scan_bulk(spark, jsonl(customer, note, name="e.jsonl"), schema), "customer")
    assert {name: df.count() for name, df in one_type.items()} == {"customer": 2}


@pytest.mark.parametrize("odd", ["a`b", "a b", "a.b", "VOID", "struct<x:int>"])
def test_odd_field_names(spark, jsonl, odd):
    df, keys = scan_inferred(spark, jsonl({"id": "gid://s/A/1", odd: {odd: 1}}, {"id": "gid://s/A/2"}))
    assert odd in df.columns and keys["A"] == sorted([odd, "id"])
    quoted = odd.replace("`", "``")
    assert rows(df.select(F.col(f"`{quoted}`").getField(odd))) == [(1,), (None,)]


def test_join_of_nothing(spark):
    assert join_all([]) == T.StructType([])
    assert join_schemas(T.StructType([]), T.StructType.fromDDL("a int")) == T.StructType.fromDDL("a int")
