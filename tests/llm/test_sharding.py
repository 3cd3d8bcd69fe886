import zlib

import numpy as np
import pytest

from orderloom.llm import sharding as H

from .corpus import empty, frame, odd_corpus


def check(got, rows, shards, slack):
    size = lambda t: len((t or "").encode()) + 1
    assert len(got) == len(rows)
    want = sorted((r[0] is None, r[0] or 0, size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == want
    total = sum(size(r[1]) for r in rows)
    for s in range(shards):
        own = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / shards) <= slack
    assert {r["shard"] for r in got} <= set(range(shards))


@pytest.mark.parametrize("shards,range_bytes", [(8, 64 << 20), (8, 900), (1, 500), (3, 64 << 20)])
def test_shards_are_near_equal_and_gapless(spark, monkeypatch, shards, range_bytes):
    monkeypatch.setattr(H, "RANGE_BYTES", range_bytes)
    rows = odd_corpus(seed=15, n=400)
    got = H.shard_plan(frame(spark, rows), shards=shards).collect()
    largest = max(len((r[1] or "").encode()) for r in rows) + 1
    check(got, rows, shards, 2 * largest)
    again = H.shard_plan(frame(spark, rows, 5), shards=shards).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_a_group_larger_than_a_shard_is_cut(spark):
    rows = [(i, "the same text for all", "en", "s", 0, 0.0) for i in range(300)]
    rows += [(1000 + i, f"text {i}", "en", "s", 0, 0.0) for i in range(100)]
    got = H.shard_plan(frame(spark, rows)).collect()
    check(got, rows, 8, 60)


def test_small_groups_stay_together(spark):
    rows = [(i, f"text number {i % 500} " * 3, "en", "s", 0, 0.0) for i in range(2000)]
    got = H.shard_plan(frame(spark, rows), group_tolerance=0.05).collect()
    shards = {}
    for r in got:
        shards.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())


def test_documents_keep_their_columns(spark):
    rows = odd_corpus(seed=16, n=50)
    docs = frame(spark, rows).withColumnRenamed("score", "slot")
    placed = H.sharded_documents(docs)
    assert placed.columns == [c for c in docs.columns if c != "slot"] + ["shard", "slot"]
    assert placed.count() == len(rows)


def test_more_shards_than_rows_and_none(spark):
    assert H.shard_plan(empty(spark)).collect() == []
    rows = [(1, "a", "en", "s", 0, 0.0), (2, None, "en", "s", 0, 0.0)]
    got = H.shard_plan(frame(spark, rows)).collect()
    assert len({(r["shard"], r["slot"]) for r in got}) == 2
    same = [(1, "a", "en", "s", 0, 0.0)] * 5
    got = H.shard_plan(frame(spark, same)).collect()
    check(got, same, 8, 2)


@pytest.mark.parametrize("doc_id", [1, None])
def test_repeated_rows_are_cut(spark, monkeypatch, doc_id):
    rows = [(doc_id, "twelve bytes", "en", "s", 0, 0.0)] * 800 + [(10 + i, f"text {i}", "en", "s", 0, 0.0) for i in range(401)]
    got = H.shard_plan(frame(spark, rows)).collect()
    check(got, rows, 8, 13)
    again = H.shard_plan(frame(spark, rows, 7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    monkeypatch.setattr(H, "RANGE_BYTES", 200)
    check(H.shard_plan(frame(spark, rows)).collect(), rows, 8, 13)


def test_points_of_all_parts():
    low = H.LOWEST
    points = [(low, low, low), (3, low, low), (3, 5, low), (3, 5, 7), (3, 5, 9), (3, 8, low), (4, low, low)]
    rows = [(0, 0, 0), (3, 4, 9), (3, 5, 6), (3, 5, 7), (3, 5, 8), (3, 5, 9), (3, 6, 0), (3, 8, 0), (3, 9, 1), (4, low, low), (5, 0, 0)]
    want = [sum(p <= r for p in points) for r in rows]
    assert H.ranges_of(points, [np.array(c) for c in zip(*rows)]).tolist() == want
    assert H.point_at((3, H.HIGHEST - 1), H.HIGHEST) == (4, low, low)
