import json

import pytest
from pyspark.sql import functions as F

from orderloom.plans.normalise import normalise_fixed, stage
from orderloom.schemas import dataset_schema
from orderloom.sources.bulk import typed_scan
from orderloom.streaming import dataset as D

from .conftest import rows


def order(number, version, *kinds, email=None):
    day = f"2024-01-0{version}T00:00:00Z"
    transactions = [{"id": f"t{number}-{i}", "kind": kind} for i, kind in enumerate(kinds)]
    return {"id": f"gid://s/Order/{number}", "email": email or f"v{version}", "updatedAt": day, "transactions": transactions}


def item(number, owner, quantity):
    return {"id": f"gid://s/LineItem/{number}", "__parentId": f"gid://s/Order/{owner}", "quantity": quantity}


def arrive(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def land(spark, tmp_path, **options):
    D.land_dataset(spark, str(tmp_path / "in"), "order", str(tmp_path / "out"), str(tmp_path / "progress"), **options).awaitTermination()


def orders(spark, target):
    return rows(D.read_dataset_table(spark, target, "order").select(F.substring_index("id", "/", -1), "email"))


def kinds(spark, target):
    return rows(D.read_dataset_table(spark, target, "order_transactions").select(F.substring_index("parent_id", "/", -1), "row_number", "kind"))


def test_new_versions_replace_all_their_rows(spark, tmp_path):
    target = str(tmp_path / "out")
    arrive(tmp_path / "in", "1.json", order(1, 1, "A", "B", "C"), order(2, 1, "D"), item(10, 1, 5))
    land(spark, tmp_path)
    assert kinds(spark, target) == [("1", 1, "A"), ("1", 2, "B"), ("1", 3, "C"), ("2", 1, "D")]
    # A newer version with fewer transactions, two versions in one batch, and a new order.
    arrive(tmp_path / "in", "2.json", order(1, 3, "X"), order(3, 2, "E"), order(3, 4, "F", "G"), item(10, 1, 6), item(11, 3, 1))
    land(spark, tmp_path)
    state = [("1", 1, "X"), ("2", 1, "D"), ("3", 1, "F"), ("3", 2, "G")]
    assert kinds(spark, target) == state and orders(spark, target) == [("1", "v3"), ("2", "v1"), ("3", "v4")]
    # A version that arrives late, and one again, change nothing.
    arrive(tmp_path / "in", "3.json", order(1, 2, "L", "M"), order(3, 4, "F", "G"))
    land(spark, tmp_path)
    assert kinds(spark, target) == state and orders(spark, target) == [("1", "v3"), ("2", "v1"), ("3", "v4")]
    items = D.read_dataset_table(spark, target, "line_item").select(F.substring_index("id", "/", -1), "quantity")
    assert rows(items) == [("10", 6), ("11", 1)]

    D.compact_dataset(spark, target, str(tmp_path / "folded"))
    assert kinds(spark, str(tmp_path / "folded")) == state
    assert spark.read.parquet(str(tmp_path / "folded" / "order_transactions")).count() == len(state)
    # It goes on there, with the same progress.
    arrive(tmp_path / "in", "4.json", order(2, 2, "Z"), order(1, 1, "old"))
    D.land_dataset(spark, str(tmp_path / "in"), "order", str(tmp_path / "folded"), str(tmp_path / "progress")).awaitTermination()
    assert kinds(spark, str(tmp_path / "folded")) == [("1", 1, "X"), ("2", 1, "Z"), ("3", 1, "F"), ("3", 2, "G")]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    target = str(tmp_path / "out")
    first = spark.read.schema(dataset_schema("order")).json(spark.sparkContext.parallelize([json.dumps(order(1, 1, "A", "B"))]))
    second = spark.read.schema(dataset_schema("order")).json(spark.sparkContext.parallelize([json.dumps(order(1, 2, "C")), json.dumps(item(1, 1, 2))]))
    D.land_batch(spark, first, 0, "order", target)
    for _ in range(3):
        tables = D.land_batch(spark, second, 1, "order", target)
        assert kinds(spark, target) == [("1", 1, "C")] and orders(spark, target) == [("1", "v2")]
    assert {"order", "line_item", "order_transactions"} <= set(tables)
    D.land_batch(spark, first, 0, "order", target)
    assert kinds(spark, target) == [("1", 1, "C")]


def test_batches_give_what_one_pass_gives(spark, tmp_path):
    records = [order(i, 1 + i % 3, *"ABC"[: i % 4]) for i in range(12)] + [item(i, i % 12, i) for i in range(30)]
    for i in range(4):
        arrive(tmp_path / "in", f"{i}.json", *records[i::4])
    land(spark, tmp_path, files_per_batch=1)
    target = str(tmp_path / "out")
    assert spark.read.parquet(f"{target}/order").select("batch_id").distinct().count() == 4
    whole = normalise_fixed(stage(spark, typed_scan(spark, str(tmp_path / "in"), dataset_schema("order")), "order"), "order")
    for name, df in whole.items():
        assert rows(D.read_dataset_table(spark, target, name).select(*df.columns)) == rows(df)


def test_lines_without_global_ids_and_broken_lines(spark, tmp_path):
    arrive(tmp_path / "in", "1.json", order(1, 1, "A"), {"id": "note", "email": "x"}, {"email": "none"}, {"email": "none"})
    land(spark, tmp_path)
    rest = D.read_dataset_table(spark, str(tmp_path / "out"), "order_rest")
    assert rows(rest.select("id", "email")) == sorted([("note", "x"), (None, "none"), (None, "none")], key=repr)
    (tmp_path / "in" / "2.json").write_text('{"id": "gid://s/Order/2", "ema\n')
    with pytest.raises(Exception):
        land(spark, tmp_path)
    assert orders(spark, str(tmp_path / "out")) == [("1", "v1")]
