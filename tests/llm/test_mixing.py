import numpy as np
import pytest

from orderloom.llm import mixing as M

from .corpus import ascii_words, empty, frame, odd_corpus


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Reshares what capped sources leave, until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, capped, left = {}, set(), share * sum(sizes.values())
    while len(capped) < len(names):
        total = sum(weight[s] for s in names if s not in capped)
        level = {s: left * weight[s] / total for s in names if s not in capped}
        over = [s for s in level if level[s] >= most * sizes[s]]
        if not over:
            target |= level
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            capped.add(s)
    return target


def check(rows, got):
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(ascii_words(r[1]))
    target = brute_targets(sizes)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["taken"] <= 2 * r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None) == sorted(
        (r[0], len(ascii_words(r[1]))) for r in rows if r[0] is not None
    )


def test_targets_and_words(spark):
    rows = odd_corpus(seed=11, n=200)
    got = M.mixed_counts(frame(spark, rows)).collect()
    check(rows, got)
    again = M.mixed_counts(frame(spark, rows, 7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_a_tree_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_DOCS", 4)
    monkeypatch.setattr(M, "FAN_IN", 3)
    rows = odd_corpus(seed=12, n=300)
    check(rows, M.mixed_counts(frame(spark, rows)).collect())


def test_expected_copies_are_the_targets():
    rng = np.random.default_rng(0)
    size, p = np.array([5.0, 1.0, 9.0, 3.0, 3.0]), np.array([0.3, 0.9, 0.5, 0.25, 0.7])
    total, runs = np.zeros(5), 20000
    for _ in range(runs):
        q, held = M.pivot(size, p, rng)
        assert (size * q).sum() == pytest.approx((size * p).sum())
        assert all(v in (0, 1) for i, v in enumerate(q) if i != held)
        total += q
    assert np.abs(total / runs - p).max() < 0.015


def test_documents_repeat_as_counted(spark):
    rows = odd_corpus(seed=13, n=80)
    counts = M.mixed_counts(frame(spark, rows)).collect()
    docs = M.mixed_documents(frame(spark, rows))
    assert docs.columns == frame(spark, rows).columns
    words = sum(len(ascii_words(r["text"])) for r in docs.collect())
    assert docs.count() == sum(r["copies"] for r in counts) and words == sum(r["taken"] for r in counts)


def test_empty_and_wordless(spark):
    assert M.mixed_counts(empty(spark)).collect() == []
    assert M.mixed_documents(empty(spark)).collect() == []
    rows = [(1, None, "en", "a", 0, 0.0), (2, " ", "en", None, 0, 0.0), (3, "x", "en", "b", 0, 0.0)]
    got = {r["doc_id"]: (r["target"], r["taken"]) for r in M.mixed_counts(frame(spark, rows)).collect()}
    assert got[1] == (0.0, 0) and got[2] == (0.0, 0) and got[3][0] == 1.5 and got[3][1] in (1, 2)
