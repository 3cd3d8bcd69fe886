"""What copies a run keeps."""

from pathlib import Path

import pytest

from checks.fixtures import landed
from orderloom.operators.filters import STAGED_TYPE
from orderloom.plans.normalise import stage
from orderloom.plans.run import run_selected
from orderloom.session import settings, shared_dir
from orderloom.sources import datasets
from orderloom.sources.bulk import scan_bulk
from orderloom.schemas import dataset_schema

from .conftest import rows

SMALL = "/root/testdata/sf0.001"


def copies(spark):
    return {p for p in Path(shared_dir(spark), "orderloom").glob("*/stage-*")}


def test_whole_copies_go_when_the_wanted_rows_are_staged(spark):
    before = copies(spark)
    kept: list[str] = []
    results = run_selected(
        spark, lambda name: landed(spark, SMALL, name), ["orders", "products"], since="1996-01-01", field="created_at", staged=kept
    )
    assert results["order"]["order"].count() and results["product"]["product"].count()
    left = copies(spark) - before
    assert sorted(p.name.rpartition("-")[0] for p in left) == ["stage-order", "stage-product"]
    assert {p.name for p in left} <= {Path(p).name for p in kept}


def test_staging_compresses_well_and_sorts_nothing(spark):
    frame = scan_bulk(spark, landed(spark, SMALL, "order"), dataset_schema("order"))
    kept: list[str] = []
    back = stage(spark, frame, "order", kept)
    assert back.count() == frame.count() and STAGED_TYPE in back.columns
    files = list(Path(kept[0]).rglob("*.parquet"))
    assert files and all(".zstd." in f.name for f in files)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= len({f.parent for f in files})


def test_roots_of_a_staged_export_are_not_shuffled(spark):
    """Only linked rows and bare ids move to find what a window keeps."""
    frame = scan_bulk(spark, landed(spark, SMALL, "order"), dataset_schema("order"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        kept = datasets.orders(stage(spark, frame, "order"), since="1996-01-01", field="created_at")
        moved = [line for line in kept._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
        assert moved and not any("__owner" in line for line in moved)
        assert any("hashpartitioning(__parentId" in line for line in moved)
    columns = ["id", "__parentId", "name", "quantity"]
    want = datasets.orders(frame, since="1996-01-01", field="created_at")
    assert rows(kept.select(columns)) == rows(want.select(columns)) != rows(frame.select(columns))


@pytest.mark.parametrize("linked", [None, "gid://s/Order/1"])
def test_a_row_with_the_id_of_a_root_is_kept(spark, jsonl, linked):
    def order(key, day, **more):
        return {"id": f"gid://s/Order/{key}", "createdAt": f"2024-01-{day}T00:00:00Z"} | more

    item = {"id": "gid://s/LineItem/5", "__parentId": "gid://s/Order/1"}
    lines = [order(1, "20"), order(1, "02", __parentId=linked), order(2, "03"), item, {"id": "gid://s/Other/1"}, {"name": "x"}]
    frame = scan_bulk(spark, jsonl(*lines), dataset_schema("order"))
    for mixed in (frame, stage(spark, frame, "order")):
        got = datasets.orders(mixed, since="2024-01-10", field="created_at").select("id", "__parentId")
        assert rows(got) == sorted([(x["id"], x.get("__parentId")) for x in (lines[0], lines[1], item)], key=repr)
