"""Every stage of the pipeline, on what its predecessor kept."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from orderloom.llm import mixing, simhash, toxicity
from orderloom.llm.scratch import staged

from ..conftest import SMALL
from .corpus import ascii_words, frame, odd_corpus
from .test_decontamination import brute as contaminated
from .test_mixing import brute_targets
from .test_simhash import brute_fingerprint, brute_groups


@pytest.fixture(scope="module")
def steps(spark):
    """The rows before and after each stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = [docs]
    for name, stage in P.STAGES:
        seen.append(staged(stage(spark, seen[-1], SMALL), name.replace(" ", "-")))
    return seen


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns(steps):
    for df in steps[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert steps[-1].columns == [*steps[0].columns, "shard", "slot"]


def test_toxic_documents_go(spark, steps):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scores = toxicity.scored(steps[0], labels, held_out=(3, 1)).collect()
    assert ids(steps[1]) == sorted(r["doc_id"] for r in scores if not r["rejected"])


def test_one_document_of_each_group_stays(steps):
    before = [(r["doc_id"], r["text"]) for r in steps[1].collect()]
    prints = {i: brute_fingerprint(t) for i, t in before}
    root = brute_groups(list(prints.values()), simhash.RADIUS)
    smallest = {}
    for i, _ in before:
        group = root[prints[i]]
        smallest[group] = min(smallest.get(group, i), i)
    assert ids(steps[2]) == sorted(smallest.values()) and len(smallest) < len(before)


def test_contaminated_documents_go(spark, steps):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"]) for r in steps[2].collect()]
    clean = sorted(r[0] for r in contaminated(rows, items, 10) if not r[4])
    assert ids(steps[3]) == clean and len(clean) < len(rows)


def test_sources_are_mixed(steps):
    words = {r["doc_id"]: (r["source"], len(ascii_words(r["text"]))) for r in steps[3].collect()}
    sizes, taken, largest = {}, {}, {}
    for source, n in words.values():
        sizes[source] = sizes.get(source, 0) + n
        largest[source] = max(largest.get(source, 0), n)
    for i in ids(steps[4]):
        source, n = words[i]
        taken[source] = taken.get(source, 0) + n
    target = brute_targets(sizes, mixing.WEIGHTS)
    assert all(abs(taken.get(s, 0) - target[s]) <= largest[s] for s in sizes)


def test_shards_hold_every_row_once(steps):
    rows = steps[5].select("doc_id", "text", "shard", "slot").collect()
    assert sorted(r["doc_id"] for r in rows) == ids(steps[4])
    sizes = [0] * 8
    for r in rows:
        sizes[r["shard"]] += len(r["text"].encode()) + 1
    largest = max(len(r["text"].encode()) for r in rows) + 1
    assert max(sizes) - min(sizes) <= 2 * largest
    for s in range(8):
        own = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert own == list(range(len(own)))


def test_run_gives_the_stages_rows(spark, steps):
    rows = P.run(spark, SMALL).select("doc_id", "shard", "slot")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, steps[-1].select("doc_id", "shard", "slot").collect()))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = staged(stage(spark, docs, SMALL), "empty")
        assert docs.count() == 0


def test_odd_rows(spark):
    """Null texts, ids, languages and sources, repeated rows, very long texts, and columns
    whose names the stages use themselves."""
    rows = odd_corpus(seed=61, n=40)
    rows += rows[-3:] + [(None, None, None, None, 7, 0.5), (777, "long words " * 20_000, "en", "s0", 7, 0.5)]
    docs = frame(spark, rows).withColumn("raw", F.lit(1)).withColumn("doc", F.lit("x")).withColumn("simhash", F.lit("y"))
    for name, stage in P.STAGES[:-1]:
        kept = staged(stage(spark, docs, SMALL), "odd")
        assert kept.columns == docs.columns
        before = {repr(tuple(r)) for r in docs.collect()}
        assert {repr(tuple(r)) for r in kept.collect()} <= before
        docs = kept
    assert docs.count() > 0
    shards = P.STAGES[-1][1](spark, docs, SMALL)
    assert shards.count() == docs.count()
    slots = {}
    for r in shards.select("shard", "slot").collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
