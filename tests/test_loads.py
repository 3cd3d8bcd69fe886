import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderloom.operators import loads
from orderloom.operators.loads import full_load, latest_per_key, upsert, upsert_partitions
from orderloom.session import shared_dir
from orderloom.sinks.buckets import load_all_buckets, read_buckets
from orderloom.sinks.outputs import load_all
from orderloom.streaming.landing import compact, land_stream, read_landed

from .conftest import rows

BASE = [("a", 1, "old", "x"), ("b", 1, "old", "y"), ("c", 1, "old", "y")]
INCREMENT = [("b", 2, "new", "y"), ("b", 3, "newest", "y"), ("d", 2, "new", "z")]
MERGED = [("a", 1, "old", "x"), ("b", 3, "newest", "y"), ("c", 1, "old", "y"), ("d", 2, "new", "z")]
SCHEMA = "id string, version int, state string, part string"


def newest():
    return [F.col("version").desc()]


def test_upsert_twice_is_upsert_once(spark):
    base, increment = spark.createDataFrame(BASE, SCHEMA), spark.createDataFrame(INCREMENT, SCHEMA)
    once = upsert(base, increment, ["id"], newest())
    assert rows(once) == MERGED
    assert rows(upsert(once, increment, ["id"], newest())) == MERGED


def test_null_keys_do_not_multiply(spark):
    base = spark.createDataFrame(BASE, SCHEMA)
    increment = spark.createDataFrame([(None, 1, "n", "x"), (None, 2, "newest", "x")], SCHEMA)
    once = upsert(base, increment, ["id"], newest())
    twice = upsert(once, increment, ["id"], newest())
    assert rows(twice) == rows(once) and once.where("id is null").count() == 1


def test_upsert_keeps_columns_in_order(spark):
    base = spark.createDataFrame(BASE, SCHEMA)
    increment = spark.createDataFrame(INCREMENT, SCHEMA).select("part", "state", "version", "id")
    assert rows(upsert(base, increment, ["id"], newest())) == MERGED


def test_only_small_keys_are_broadcast(spark, tmp_path):
    """Keys in compressed lists look small to the optimizer; what counts is their measured size."""

    def stored(name, start, owners):
        item = F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.concat(F.lit("gid://shop/InventoryLevel/"), "id", F.lit("-"), i))
        docs = spark.range(start, start + owners, 1, 2).select(item.alias("ids"))
        docs.write.option("compression", "zstd").parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name)).select(F.explode("ids").alias("id"))

    base = stored("base", 0, 4000)
    for name, owners, join in (("large", 3000, "SortMergeJoin"), ("small", 10, "BroadcastHashJoin")):
        merged = upsert(base, stored(name, 2000, owners), ["id"], [F.col("id")])
        assert merged.count() == 100 * max(4000, 2000 + owners)
        assert join in merged._jdf.queryExecution().executedPlan().toString()


def test_partition_upsert_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(BASE, SCHEMA).write.partitionBy("part").parquet(path)
    before = sorted(p.name for p in (tmp_path / "t" / "part=x").glob("*.parquet"))
    for _ in range(2):
        upsert_partitions(spark, path, spark.createDataFrame(INCREMENT, SCHEMA), ["id"], newest(), "part")
        assert rows(spark.read.parquet(path).select("id", "version", "state", "part")) == MERGED
    assert sorted(p.name for p in (tmp_path / "t" / "part=x").glob("*.parquet")) == before


def test_partition_names_keep_their_type(spark, tmp_path):
    path = str(tmp_path / "t")
    for part in ("2024-01-01", "7"):
        base = spark.createDataFrame([("a", 1, "old", part)], SCHEMA)
        base.write.mode("overwrite").partitionBy("part").parquet(path)
        increment = spark.createDataFrame([("a", 2, "new", part), ("b", 2, "new", None)], SCHEMA)
        for _ in range(2):
            upsert_partitions(spark, path, increment, ["id"], newest(), "part")
        assert rows(spark.read.parquet(path).select("id", "version", F.col("part").cast("string"))) == [("a", 2, part), ("b", 2, None)]


def test_full_load_replaces(spark, tmp_path):
    for data in (BASE, INCREMENT):
        full_load(spark.createDataFrame(data, SCHEMA), str(tmp_path / "t"))
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == sorted(INCREMENT)


def test_latest_per_key_on_a_hot_key(spark):
    hot = spark.range(30_000).select(F.lit("hot").alias("id"), F.col("id").cast("int").alias("version"))
    cold = spark.range(60_000).select(F.concat(F.lit("k"), F.col("id") % 1000).alias("id"), F.col("id").cast("int").alias("version"))
    latest = latest_per_key(hot.union(cold), ["id"], newest())
    assert latest.count() == 1001
    assert latest.where("id = 'hot'").first()["version"] == 29_999
    assert latest.agg(F.sum("version")).first()[0] == 29_999 + sum(range(59_000, 60_000))


def arrive(folder, name, records):
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def test_stream_state_equals_batch_state(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "landed")
    source.mkdir()
    columns = ["id", "version", "state", "part"]

    def land():
        land_stream(spark, str(source), SCHEMA, target, str(tmp_path / "progress"), ["id"], newest()).awaitTermination()

    arrive(source, "1.json", [dict(zip(columns, r)) for r in BASE])
    land()
    arrive(source, "2.json", [dict(zip(columns, r)) for r in INCREMENT])
    land()
    land()  # nothing new
    assert rows(read_landed(spark, target, ["id"], newest()).select(*columns)) == MERGED

    # A batch that is written again replaces itself.
    again = spark.createDataFrame(INCREMENT, SCHEMA)
    latest_per_key(again, ["id"], newest()).write.mode("overwrite").parquet(f"{target}/batch_id=1")
    assert rows(read_landed(spark, target, ["id"], newest()).select(*columns)) == MERGED

    compact(spark, target, str(tmp_path / "compacted"), ["id"], newest())
    state = read_landed(spark, str(tmp_path / "compacted"), ["id"], newest())
    assert rows(state.select(*columns)) == MERGED

    # The stream goes on into the compacted table, with the same checkpoint.
    target = str(tmp_path / "compacted")
    arrive(source, "3.json", [dict(zip(columns, r)) for r in [("a", 9, "late", "x"), ("e", 1, "new", "z")]])
    land()
    got = {r["id"]: r["state"] for r in read_landed(spark, target, ["id"], newest()).collect()}
    assert got == {"a": "late", "b": "newest", "c": "old", "d": "new", "e": "new"}


def test_a_malformed_line_fails_the_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name, line in (("broken", '{"id": "a", "ver'), ("wrong", '{"id": "a", "version": "x"}')):
        (source / f"{name}.json").write_text(line + "\n")
        stream = land_stream(
            spark, str(source), SCHEMA, str(tmp_path / name), str(tmp_path / f"progress-{name}"), ["id"], newest()
        )
        with pytest.raises(Exception):
            stream.awaitTermination()
        (source / f"{name}.json").unlink()


VERSIONS = [("a", 1, "old", "x"), ("a", 2, "new", "x"), ("b", 1, "only", "y"), (None, 1, "older", "z"), (None, 2, "newer", "z"), ("c", 1, "only", "y")]


@pytest.mark.parametrize("limit", [10 << 20, 0])
def test_only_rows_whose_key_repeats_are_compared(spark, tmp_path, monkeypatch, limit):
    """Unless the repeated keys are too many to be broadcast."""
    spark.createDataFrame(VERSIONS, SCHEMA).write.parquet(str(tmp_path / "rows"))
    held = spark.read.schema(SCHEMA).parquet(str(tmp_path / "rows"))
    compared, whole = [], loads.latest_per_key

    def seen(df, key, order):
        compared.extend(r["id"] for r in df.select("id").collect())
        return whole(df, key, order)

    monkeypatch.setattr(loads, "latest_per_key", seen)
    monkeypatch.setattr(loads, "BROADCAST_BYTES", limit)
    kept = []
    got = loads.latest_of_stored(held, ["id"], newest(), kept)
    assert rows(got) == rows(whole(held, ["id"], newest())) and len(kept) == 1
    assert sorted(compared, key=str) == ([None, None, "a", "a"] + ([] if limit else ["b", "c"]))


def test_rows_whose_keys_occur_once_are_not_shuffled(spark, tmp_path):
    spark.range(1000).selectExpr("string(id) id", "1 version").write.parquet(str(tmp_path / "rows"))
    held = spark.read.parquet(str(tmp_path / "rows"))
    got = loads.latest_of_stored(held, ["id"], newest(), [])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and got.count() == 1000
    increment = got.where("id > 500")
    plan = loads.upsert(held, increment, ["id"], newest(), unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert loads.upsert(held, increment, ["id"], newest(), unique=True).count() == 1000


def test_loads_leave_no_copies(spark, tmp_path):
    versions = spark.createDataFrame(VERSIONS, SCHEMA)
    left = {p.name for p in Path(shared_dir(spark), "orderloom").glob("*/*")}
    load_all_buckets(spark, {"thing": versions}, str(tmp_path / "b"))
    load_all(spark, {"thing": versions.where("id = 'b'")}, None, str(tmp_path / "1"))
    load_all(spark, {"thing": versions}, str(tmp_path / "1"), str(tmp_path / "2"), newest="version")
    assert {p.name for p in Path(shared_dir(spark), "orderloom").glob("*/*")} == left
    want = [("a", 2, "new", "x"), ("b", 1, "only", "y"), ("c", 1, "only", "y"), (None, 2, "newer", "z")]
    assert rows(spark.read.parquet(str(tmp_path / "2" / "thing"))) == sorted(want, key=repr)
    # Without an update time the greatest text counts.
    assert rows(read_buckets(spark, str(tmp_path / "b" / "thing"))) == sorted(want[:3] + [(None, 2, "newer", "z")], key=repr)
