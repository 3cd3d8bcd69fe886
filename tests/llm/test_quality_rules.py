import math
import random

import numpy as np
import pyarrow as pa
import pytest

from orderloom.llm import quality_rules as Q

from .corpus import ascii_words, empty, frame, odd_corpus


def brute(text):
    words = ascii_words(text)
    chars = sum(len(w.decode()) for w in words)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if ascii_words(line):
            dup += line in seen
            seen.add(line)
    spans = {}
    for i in range(len(words) - 7):
        spans.setdefault(tuple(words[i : i + 8]), []).append(i)
    flags = {i + j for at in spans.values() if len(at) > 1 for i in at for j in range(8)}
    return dict(n_words=len(words), word_chars=chars, n_symbols=symbols, n_dup_lines=dup, n_repeat_words=len(flags))


def test_features_match_brute_force():
    texts = [r[1] for r in odd_corpus(seed=31)]
    texts += ["a\nb\na\n\n\na \na", "x y\n" * 30, "one two three four five six seven eight " * 3, "\n\n"]
    assert Q.measure(pa.array(texts, pa.string())).to_pylist() == [brute(t) for t in texts]


def test_binomial_tail_is_exact():
    for n, rate in ((30, 0.1), (200, 0.004), (50, 0.5)):
        for k in range(0, n, 3):
            want = sum(math.comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1))
            assert Q.at_most(k, n, rate) == pytest.approx(want, rel=1e-9)
    assert Q.at_most(5, 5, 0.1) == 1.0


def plain(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 7))) for _ in range(n))


def test_cutoffs_reject_what_is_bad_and_few_good(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(3000):
        bad = i % 4 == 0
        text = plain(rng, 40)
        rows.append((i, text.replace(" ", "### ") if bad else text, "en" if i % 3 else "de", "s", 0, 0.0))
        labels.append((i, 0 if bad else 1, 0))
    rows.append((9000, plain(rng, 40).replace(" ", "### "), "xx", "s", 0, 0.0))
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in Q.risk_controlled(frame(spark, rows), known, max_false_rejection=0.2).collect()}
    assert sum(not got[i]["kept"] for i in range(3000) if i % 4) <= 0.2 * 2250
    assert not any(got[i]["kept"] for i in range(0, 3000, 4)) and "symbols" in got[0]["rejected_by"]
    assert got[9000]["kept"]  # no labels in its stratum: the base rules alone


def test_few_labels_give_no_cutoffs(spark):
    rows = odd_corpus(seed=32)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(3, 0, 0), (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        got = Q.risk_controlled(frame(spark, rows), known).collect()
        assert len(got) == len(rows)
        assert all(r["kept"] != r["base_failed"] for r in got)
    by_text = [(r["n_words"], r["base_failed"]) for r in got]
    assert all(failed for n, failed in by_text if n < 20)
    assert Q.risk_controlled(empty(spark), labels).collect() == []


def labelled_corpus(n, rng):
    """A fifth bad, by symbols; of the good texts one in 200 has symbols too."""
    rows, labels = [], []
    for i in range(n):
        bad, odd = i % 5 == 0, i % 200 == 1
        text = plain(rng, 30)
        rows.append((i, text.replace(" ", "## ") if bad or odd else text, "de" if i % 3 == 2 else "en", "s", 0, 0.0))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_the_registered_risk_and_copies(spark):
    rows, labels = labelled_corpus(3000, random.Random(2))
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in Q.risk_controlled(frame(spark, rows), known).collect()}
    for lang in ("en", "de"):
        good = [r for r in rows if r[2] == lang and r[0] % 5]
        assert 0 < sum(not got[r[0]]["kept"] for r in good) <= 0.02 * len(good)
    assert not any(got[i]["kept"] for i in range(0, 3000, 5))
    # Rows that repeat are no more evidence: few texts get no cutoff, however often they are there.
    few = rows[:150]
    for copies in (1, 40):
        again = Q.risk_controlled(frame(spark, few * copies), known).collect()
        assert len(again) == 150 * copies and all(r["kept"] == (not r["base_failed"]) for r in again)
    many = Q.risk_controlled(frame(spark, rows * 3), known).collect()
    assert all(r["kept"] == got[r["doc_id"]]["kept"] for r in many)


def test_copies_under_other_ids_are_one_trial(spark):
    rows, labels = labelled_corpus(150, random.Random(3))
    copies = [(i + 1000 * k, *row[1:]) for k in range(40) for i, row in enumerate(rows)]
    known = [(i + 1000 * k, label, 0) for k in range(40) for i, label, _ in labels]
    got = Q.risk_controlled(frame(spark, copies), spark.createDataFrame(known, "doc_id long, quality int, toxic int")).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in got)


def brute_valid(sequence, level, n, rate, error):
    chosen = None
    for current in sequence:
        rejected = sum(m for row, m in zip(level, n) if any(v > c for v, c in zip(row, current)))
        if sum(math.comb(int(sum(n)), i) * rate**i * (1 - rate) ** (int(sum(n)) - i) for i in range(rejected + 1)) > error:
            return chosen
        chosen = current
    return chosen


def test_sequences_tighten_and_stop():
    rng = np.random.default_rng(4)
    sizes = [len(grid) for _, grid in Q.RULES.values()]
    for _ in range(30):
        level = np.column_stack([rng.integers(0, s + 1, 40) * (rng.random(40) < 0.2) for s in sizes])
        good, n = rng.random(40) < 0.6, rng.integers(1, 9, 40)
        sequence = Q.proposed(level, good, n)
        for before, after in zip([np.array(sizes), *sequence], sequence):
            assert (before - after).sum() == 1 and (after >= 0).all()
        for rate in (0.05, 0.3):
            want = brute_valid(sequence, level[good], n[good], rate, 0.05)
            got = Q.valid_set(sequence, level[good], n[good], rate, 0.05)
            assert (got is None and want is None) or (got == want).all()
