import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from orderloom.llm import simhash as S
from orderloom.llm.components import components

from .corpus import ascii_words, empty, frame, odd_corpus


def brute_fingerprint(text, shingle=3):
    lower = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
    words = lower.split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, radius):
    """The smallest value each value is linked to through others."""
    parent = {v: v for v in values}

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    values = sorted(set(values))
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {v: top(v) for v in values}


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_fingerprints_match_brute_force():
    texts = [r[1] for r in odd_corpus(seed=5)]
    got = S.fingerprints(pa.array(texts, pa.string()), 3).tolist()
    assert got == [brute_fingerprint(t) for t in texts]


def test_words_of_the_corpus_helper():
    assert ascii_words(" a b\tc\x0bd") == ["a b".encode(), b"c", b"d"]


def near_values(seed, n, spread):
    rng = random.Random(seed)
    values = [0]
    for _ in range(n):
        base = rng.choice(values) if rng.random() < spread else rng.getrandbits(64)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
            base ^= 1 << rng.randrange(64)
        values.append(base)
    return values


@pytest.mark.parametrize("radius", [1, 2, 3])
@pytest.mark.parametrize("spread,limit", [(0.6, 4_000_000), (0.95, 20_000)])
def test_links_join_just_what_is_near(spark, monkeypatch, radius, spread, limit):
    monkeypatch.setattr(S, "BUCKET_VARIANTS", limit)
    values = near_values(radius, 150, spread)
    frame_ = spark.createDataFrame([(signed(v),) for v in values], "v long")
    links = S.ball_links(frame_, "v", radius)
    roots = {r["node"]: r["root"] for r in components(links, "a", "b").collect()}
    want = brute_groups(values, radius)
    groups = {}
    for v in set(values):
        groups.setdefault(roots.get(signed(v), signed(v)), set()).add(v)
    expected = {}
    for v, top in want.items():
        expected.setdefault(top, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_a_dense_group_leaves_a_forest(spark):
    ball = [1 << a | 1 << b for a in range(40) for b in range(a)] + [0]
    links = S.ball_links(spark.createDataFrame([(v,) for v in ball], "v long"), "v")
    assert links.count() < 3 * len(ball)
    assert {r["root"] for r in components(links, "a", "b").collect()} == {0}


def test_documents_match_brute_force(spark):
    rows = odd_corpus(seed=6)
    prints = [brute_fingerprint(r[1]) for r in rows]
    root = brute_groups(prints, 3)
    ids = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            ids[root[p]] = min(ids.get(root[p], r[0]), r[0])
    want = sorted(((r[0], signed(p), ids.get(root[p])) for r, p in zip(rows, prints)), key=repr)
    got = S.near_duplicate_groups(frame(spark, rows)).select("doc_id", "simhash", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == want

    kept = S.first_of_groups(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    kept_prints = [brute_fingerprint(r["text"]) for r in kept.collect()]
    assert len(kept_prints) == len({root[p] for p in prints}) == len({root[p] for p in kept_prints})


def test_empty_table(spark):
    assert S.near_duplicate_groups(empty(spark)).collect() == []
    assert S.first_of_groups(empty(spark)).collect() == []


def test_components_of_long_chains_and_hot_nodes(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(1000, 1300)]
    odd = [(7, 7), (None, 3), (9, 8), (8, 9), (9, 8)]
    links = spark.createDataFrame(chain + star + odd, "a long, b long")
    roots = {r["node"]: r["root"] for r in components(links, "a", "b").collect()}
    assert {roots[i] for i in range(100, 161)} == {100}
    assert {roots[i] for i in range(1000, 1300)} == {500} and roots[500] == 500
    assert roots[9] == 8 and 7 not in roots and 3 not in roots
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []
    assert np.array_equal(S.forest(4, np.array([0, 2]), np.array([1, 1])), [0, 0, 0, 3])
