import re

import pytest

from orderloom.llm import decontamination as D

from .corpus import empty, frame, odd_corpus

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, span):
    spans = {}
    for item_id, text in items:
        w = words(text)
        n = min(len(w), span)
        if n:
            for i in range(len(w) - n + 1):
                spans.setdefault(tuple(w[i : i + n]), set()).add(item_id)
    out = []
    for r in rows:
        w = words(r[1])
        hit, ids = set(), set()
        for key, owners in spans.items():
            for i in range(len(w) - len(key) + 1):
                if tuple(w[i : i + len(key)]) == key:
                    hit.update(range(i, i + len(key)))
                    ids |= owners
        out.append((r[0], len(w), len(hit), sorted(str(i) for i in ids if i is not None), bool(hit)))
    return sorted(out, key=repr)


def items_from(rows):
    long = [r[1] for r in rows if r[1] and len(words(r[1])) > 30]
    cut = [" ".join(words(t)[5:22]).upper() for t in long[:6]]
    short = ["alpha", "beta gamma éclair x1", "ß " * 4, "日本 x1 beta", "never seen words at all"]
    return list(enumerate(cut + short + [cut[0], "", None, "!!"])) + [(0, cut[0]), (None, cut[1])]


@pytest.mark.parametrize("span,k", [(10, 5), (10, 10), (4, 1)])
def test_matches_brute_force(spark, span, k):
    rows = odd_corpus(seed=8)
    items = items_from(rows)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = D.contamination(frame(spark, rows), benchmark, ["doc_id"], span=span, k=k)
    assert got.columns == ["doc_id", "n_words", "n_hit", "items", "contaminated"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, items, span)


def test_shuffled_joins_give_the_same(spark):
    rows = odd_corpus(seed=9, n=30)
    items = items_from(rows)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = D.contamination(frame(spark, rows), benchmark, ["doc_id"]).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, items, 10)


def test_clean_documents_keeps_columns_and_clean_rows(spark):
    rows = odd_corpus(seed=8)
    items = items_from(rows)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    kept = D.clean_documents(frame(spark, rows), benchmark)
    assert kept.columns == frame(spark, rows).columns
    flags = {(r[0], r[1]): r[4] for r in brute(rows, items, 10)}
    want = sorted(repr(r) for r in rows if not flags[r[0], len(words(r[1]))])
    assert sorted(repr(tuple(r)) for r in kept.collect()) == want


def test_empty_tables(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    rows = odd_corpus(seed=8, n=5)
    got = D.contamination(frame(spark, rows), benchmark, ["doc_id"]).collect()
    assert len(got) == len(rows) and not any(r["contaminated"] or r["n_hit"] or r["items"] for r in got)
    assert D.clean_documents(frame(spark, rows), benchmark).count() == len(rows)
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert D.contamination(empty(spark), some, ["doc_id"]).collect() == []


def test_documents_are_tokenised_once(spark, monkeypatch):
    """One pass writes the fingerprints of all lengths; besides, only hit texts are read."""
    rows, items = odd_corpus(seed=8), items_from(odd_corpus(seed=8))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    plans, staged = {}, D.staged
    monkeypatch.setattr(D, "staged", lambda df, name: plans.update({name: df._jdf.queryExecution().optimizedPlan().toString()}) or staged(df, name))
    result = D.contamination(frame(spark, rows), benchmark, ["doc_id"])
    plans["result"] = result._jdf.queryExecution().optimizedPlan().toString()
    assert {name for name, plan in plans.items() if "regexp_extract_all" in plan} == {"spans", "prints", "hit-texts"}
    assert plans["prints"].count("regexp_extract_all") == 1 and "LeftSemi" in plans["hit-texts"]


def test_native(spark):
    rows, items = odd_corpus(seed=8, n=5), [(1, "alpha beta")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    plan = D.contamination(frame(spark, rows), benchmark, ["doc_id"])._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
