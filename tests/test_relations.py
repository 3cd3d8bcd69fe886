"""Relations, ordinals and connections, with a parent that holds a third of all rows."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orderloom.operators import relations
from orderloom.operators.entities import write_split
from orderloom.operators.filters import of_entity
from orderloom.operators.keys import pk_violations
from orderloom.operators.ordinals import occurrence
from orderloom.operators.relations import (
    attach_parent,
    connection_documents,
    linked_to,
    nest_connections,
    orphans,
    with_children,
)
from orderloom.operators.reshape import array_child

from .conftest import rows

N = 9000


@pytest.fixture(scope="module")
def children(spark):
    """A third of the rows under parent p0, the rest spread over p1 … p299, some under a missing parent."""
    parent = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 300)
    return spark.range(N).select(
        F.concat(F.lit("c"), "id").alias("id"),
        F.concat(F.lit("p"), parent.cast("string")).alias("parent_id"),
        (F.col("id") * 7919 % N).alias("line"),
    ).cache()


@pytest.fixture(scope="module")
def parents(spark):
    return spark.range(290).select(F.concat(F.lit("p"), "id").alias("id"), (F.col("id") * 10).alias("size"))


@pytest.fixture(scope="module")
def by_parent(children):
    groups = defaultdict(list)
    for r in children.collect():
        groups[r["parent_id"]].append((r["line"], r["id"]))
    return {k: sorted(v) for k, v in groups.items()}


def test_blocked_ordinals_equal_plain_ones(children, by_parent):
    want = sorted((i, n) for items in by_parent.values() for n, (_, i) in enumerate(items, 1))
    plain = occurrence(children, ["parent_id"], ["line"])
    blocked = occurrence(children, ["parent_id"], ["line"], F.expr("line div 500"))
    assert rows(plain.select("id", "row_number")) == want
    assert rows(blocked.select("id", "row_number")) == want


def test_blocked_ordinals_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, line int")
    numbered = occurrence(df, ["k"], ["line"], F.col("line"))
    assert rows(numbered.select("k", "line", "row_number")) == [("a", 1, 1), (None, 1, 1), (None, 2, 2)]


def test_hot_parent_is_spread_over_documents(children, by_parent):
    docs = connection_documents(
        children, "parent_id", ["line"], F.struct("id", "line"), F.expr("line div 500"), size=250
    ).cache()
    assert docs.agg(F.max(F.size("edges"))).first()[0] == 250
    assert docs.where("parent_id = 'p0'").count() == -(-len(by_parent["p0"]) // 250)
    nodes = docs.select(F.col("parent_id").alias("id"), "offset", F.col("edges.node").alias("items"))
    back = array_child(nodes, "items", first=F.col("offset"))
    assert back.count() == N
    assert rows(back.select("parent_id", "row_number", "id")) == sorted(
        ((p, n, i) for p, items in by_parent.items() for n, (_, i) in enumerate(items, 1)), key=repr
    )
    assert pk_violations(back, ["parent_id", "row_number"]).isEmpty()


def test_first_children_of_every_parent(children, parents, by_parent):
    nested = with_children(parents, children, 10, ["line"], ["id"], name="first")
    got = {r["id"]: [c["id"] for c in r["first"]] if r["first"] else None for r in nested.collect()}
    assert len(got) == 290
    assert all(got[p] == ([i for _, i in by_parent[p][:10]] if p in by_parent else None) for p in got)


def test_join_and_orphans_partition_the_children(children, parents, by_parent):
    joined = attach_parent(children, parents, ["size"], orphans_too=False)
    lost = orphans(children, parents)
    missing = sum(len(v) for p, v in by_parent.items() if int(p[1:]) >= 290)
    assert lost.count() == missing and joined.count() + missing == N
    assert joined.where("parent_size <> cast(substring(parent_id, 2) as int) * 10").isEmpty()


def test_children_without_parent_stay(children, parents):
    joined = attach_parent(children, parents, ["size"])
    assert joined.count() == N and joined.where("parent_size is null").count() == orphans(children, parents).count()


def test_first_children_beyond_any_group_limit(spark, children, parents, by_parent):
    nested = with_children(parents, children, 2500, ["line"], ["id"], name="first")
    hot = nested.where("id = 'p0'").first()["first"]
    assert [c["id"] for c in hot] == [i for _, i in by_parent["p0"][:2500]]


def test_children_without_link_are_no_orphans(spark, parents):
    df = spark.createDataFrame([("x", None)], "id string, parent_id string")
    assert orphans(df, parents).isEmpty()


def test_rows_linked_to_roots(spark):
    mixed = spark.createDataFrame(
        [("P/1", None), ("P/2", None), ("V/1", "P/1"), ("V/2", "P/2"), ("M/1", "V/1"), ("M/2", "V/2"), ("M/3", "P/1"),
         ("X/1", "Q/9")],
        "id string, __parentId string",
    )
    roots = mixed.where("id = 'P/1'")
    assert rows(linked_to(mixed, roots, 2).select("id")) == [("M/1",), ("M/3",), ("P/1",), ("V/1",)]
    assert rows(linked_to(mixed, roots, 1).select("id")) == [("M/3",), ("P/1",), ("V/1",)]


def test_split_is_a_partition_of_the_input(spark, tmp_path):
    kinds = ["Order", "LineItem", "Refund"]
    ids = [f"gid://shop/{kinds[0] if i % 3 else kinds[1 + i % 2]}/{i}" for i in range(999)]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    write_split(df, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert rows(back.select("id")) == sorted((i,) for i in ids)
    counts = {r["entity_type"]: r["count"] for r in back.groupBy("entity_type").count().collect()}
    assert counts == Counter(i.split("/")[3] for i in ids)
    assert of_entity(df, "Refund").count() == counts["Refund"]


def test_parents_without_parts_keep_a_row(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    parts = spark.createDataFrame([(1, 0, 5), (1, 1, 6)], "link int, part int, v int")
    assert rows(nest_connections(parents, parts, "k", "link")) == [(1, "a", 0, 5), (1, "a", 1, 6), (2, "b", None, None)]


def test_copies_of_a_root_do_not_multiply(spark):
    mixed = spark.createDataFrame([("P/1", None), ("P/1", None), ("V/1", "P/1")], "id string, __parentId string")
    assert rows(linked_to(mixed, mixed.where("id = 'P/1'"), 2).select("id")) == [("P/1",), ("P/1",), ("V/1",)]


def test_heavy_owners_are_cut_by_their_size(spark, monkeypatch):
    hot = spark.range(60_000).select(F.lit("hot").alias("parent_id"), F.col("id").alias("line"))
    warm = spark.range(15_000).select(F.lit("warm").alias("parent_id"), F.col("id").alias("line"))
    cold = spark.range(30_000).select(F.concat(F.lit("c"), F.col("id") % 3000).alias("parent_id"), F.col("id").alias("line"))
    children = hot.unionAll(warm).unionAll(cold).repartition(16)
    assert relations.heavy_owners(children, "parent_id", 5000) == {"hot": 12, "warm": 3}
    monkeypatch.setattr(relations, "SLICE_ROWS", 5000)
    parents = spark.createDataFrame([("hot",), ("warm",), ("c7",), ("none",)], "id string")
    for n in (1, 7, 4000):
        got = {r["id"]: r["first"] for r in with_children(parents, children, n, ["line"], ["line"], name="first").collect()}
        assert [x["line"] for x in got["hot"]] == list(range(n)) and [x["line"] for x in got["warm"]] == list(range(n))
        assert [x["line"] for x in got["c7"]] == [7 + 3000 * i for i in range(min(n, 10))] and got["none"] is None
    # No task of the first step gets more of the hot owner than a slice of it.
    sizes = children.where("parent_id = 'hot'").groupBy(F.spark_partition_id() % 12).count().collect()
    assert max(r["count"] for r in sizes) < 2 * 5000 + 60_000 / 16


def test_no_heavy_owners_of_no_rows(spark):
    none = spark.createDataFrame([], "parent_id string, line long")
    assert relations.heavy_owners(none, "parent_id") == {}
    nulls = spark.range(50).select(F.lit(None).cast("string").alias("parent_id"), F.col("id").alias("line"))
    assert relations.heavy_owners(nulls, "parent_id", 10) == {}
