"""What the exports of the checks cost: size of their files, and of what is shuffled to build them."""

import gzip
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from checks.fixtures import EXPORTS, landed
from orderloom.operators import relations
from orderloom.operators.relations import connection_documents, nest_connections
from orderloom.session import settings

SMALL = "/root/testdata/sf0.001"
PAGES = ["order_pages", "product_pages", "inventory_pages", "metafield_pages", "customer_pages"]


def test_exports_are_compressed_into_files_of_bounded_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "_landed", {})
    monkeypatch.setattr(fixtures, "LINES_PER_FILE", 700)
    files = sorted(Path(landed(spark, SMALL, "order")).glob("part-*"))
    texts = [gzip.decompress(f.read_bytes()) for f in files]
    lines = [text.count(b"\n") for text in texts]
    assert max(lines) <= 700 and sum(lines) == EXPORTS["order"](spark, SMALL).count()
    assert sum(f.stat().st_size for f in files) * 5 < sum(map(len, texts))


def test_exports_are_compressed_at_the_fastest_level(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "_landed", {})
    files = list(Path(landed(spark, SMALL, "order")).glob("part-*"))
    texts = [gzip.decompress(f.read_bytes()) for f in files]
    fast, usual = (sum(len(zlib.compress(t, level)) for t in texts) for level in (1, 6))
    size = sum(f.stat().st_size for f in files)
    assert abs(size - fast) < abs(size - usual)


def test_lists_are_sorted_by_compiled_code(spark, owners):
    """Not by a lambda that is interpreted for every comparison."""
    docs = connection_documents(owners, "link", ["line"], None, F.expr("line div 500"))
    for df in (docs, *[EXPORTS[name](spark, SMALL) for name in PAGES[:3]]):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "sort_array(" in plan and "array_sort(" not in plan


@pytest.mark.parametrize("name", PAGES)
def test_pages_are_written_out_after_the_last_shuffle(spark, name):
    """Before it rows are columns of the tables: no global ids, no other text of documents."""
    plan = EXPORTS[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    below = plan.partition("Exchange")[2]
    assert "Scan parquet" in below and "gid://" not in below


def test_children_of_documents_are_shuffled_once(spark):
    df = EXPORTS["order_pages"](spark, SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(l_orderkey" in line and "Reused" not in line]
    ids = {line.split("plan_id=")[1] for line in moved}
    assert len(ids) == 1, plan


@pytest.fixture
def owners(spark):
    """A heavy owner, a light one of several documents, small ones, and children without one."""
    n = F.col("id")
    owner = F.when(n < 3000, "hot").when(n < 3700, "warm").when(n < 3900, F.lit(None)).otherwise(F.concat(F.lit("s"), n % 50))
    return spark.range(0, 5000, 1, 8).select(owner.alias("link"), F.pmod(n * 7919, F.lit(5000)).alias("line"), n.alias("payload"))


@pytest.mark.parametrize("narrow", [True, False])
@pytest.mark.parametrize("listed", [1000, 10**6])
def test_documents_are_the_same_however_owners_are_dealt(owners, monkeypatch, listed, narrow):
    monkeypatch.setattr(relations, "LISTED_ROWS", listed)
    node = None if narrow else F.struct("line", "payload")
    docs = connection_documents(owners, "link", ["line"], node, F.expr("line div 500"), size=250).collect()
    want: dict = {}
    for r in owners.orderBy("line").collect():
        want.setdefault(r["link"], []).append((r["line"], r["payload"]))
    got: dict = {}
    for r in sorted(docs, key=lambda r: r["part"]):
        entries = got.setdefault(r["link"], [])
        assert r["offset"] == r["part"] * 250 == len(entries) and 0 < len(r["edges"]) <= 250
        entries += [tuple(e["node"]) for e in r["edges"]]
    assert got == want


def test_parents_without_a_key_keep_their_row(spark):
    parents = spark.createDataFrame([(1, "a"), (None, "b")], "k int, name string")
    parts = spark.createDataFrame([(1, 0), (None, 0)], "link int, part int")
    got = nest_connections(parents, parts, "k", "link").collect()
    assert sorted(map(tuple, got), key=repr) == [(1, "a", 0), (None, "b", None)]


@pytest.mark.parametrize("name, table, link", [("order_pages", "orders", "l_orderkey"), ("product_pages", "part", "l_partkey"), ("inventory_pages", "part", "l_partkey")])
def test_rows_of_a_page_are_dealt_once(spark, name, table, link):
    """Pairs, lists and pages are made of lines where their page is; parents are dealt to them."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        plan = EXPORTS[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert sum(f"hashpartitioning({link}_page" in line for line in dealt) == 1, plan
    assert sum("hashpartitioning(page#" in line for line in dealt) == 1, plan
    customers = [line for line in dealt if "_custkey#" in line]
    assert len(dealt) == 2 + len(customers), plan


@pytest.mark.parametrize("listed", [1500, 10**6])
def test_documents_by_page_are_those_of_the_parts(spark, owners, monkeypatch, listed):
    monkeypatch.setattr(relations, "LISTED_ROWS", listed)
    codes = F.create_map(*[F.lit(x) for pair in (("hot", 1000), ("warm", 1001)) for x in pair])
    number = F.coalesce(codes[F.col("link")], F.expr("try_cast(substring(link, 2) as int)")).cast("int")
    rows_ = owners.select(number.alias("link"), "line", "payload")
    parents = spark.createDataFrame([(k, f"n{k}") for k in [*range(45), 1000, 1001, 1050]] + [(None, "none")], "k int, name string")
    block = F.expr("line div 500")
    frames = relations.nest_by_page(parents, rows_, "k", "link", ["line"], block, 50)
    assert len(frames) == 1 + (listed == 1500)
    got = [r for f in frames for r in f.select("k", "name", "part", "offset", "edges", "page").collect()]
    assert all(r["page"] == (None if r["k"] is None else r["k"] // 50) for r in got)
    docs = connection_documents(rows_, "link", ["line"], None, block)
    want = nest_connections(parents, docs, "k", "link").select("k", "name", "part", "offset", "edges").collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(map(tuple, want), key=repr)
