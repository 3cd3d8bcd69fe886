import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import periodic_runs as R
from orderloom.llm import queries
from orderloom.llm import words as W

from .corpus import ascii_words, empty, frame, odd_corpus


def brute_runs(words, min_length=6, min_periods=4):
    """Every maximal stretch of each period, whose smallest period that is."""
    n, found = len(words), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_periods * q):
                stretch = words[i : j + q]
                if not any(all(a == b for a, b in zip(stretch, stretch[p:])) for p in range(1, q)):
                    found.append((i, j + q - i, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_text(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def brute_best(runs):
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None


def found(texts):
    out = R.find_runs(pa.array(texts, pa.string()), 6, 4).to_pylist()
    triple = lambda r: (r["start"], r["length"], r["period"]) if r else None
    return [(o["n_words"], [triple(r) for r in o["runs"]], triple(o["strongest"]), o["collapsed"].encode()) for o in out]


def wanted(text):
    words = ascii_words(text)
    runs = brute_runs(words)
    return len(words), runs, brute_best(runs), brute_text(words, runs)


def periodic_texts(seed, n):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            unit = [rng.choice("ab") if rng.random() < 0.7 else f"w{rng.randint(0, 9)}" for _ in range(rng.randint(1, 9))]
            parts += (unit * 9)[: rng.randint(1, 9 * len(unit))]
        texts.append("".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in parts))
    return texts


def test_runs_match_brute_force():
    texts = periodic_texts(1, 300) + [r[1] for r in odd_corpus(seed=3)]
    assert found(texts) == [wanted(t) for t in texts]
    assert sum(len(f[1]) for f in found(texts)) > 200


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), min_size=1, max_size=4))
def test_two_letter_words(lists):
    texts = [" ".join(x) for x in lists]
    assert found(texts) == [wanted(t) for t in texts]


def test_words_of_fibonacci_and_thue_morse():
    a, b = ["a"], ["a", "b"]
    for _ in range(10):
        a, b = b, b + a
    signs = ["ab"[bin(i).count("1") % 2] for i in range(512)]
    cubes = " ".join(b + b + b + b + b)
    for text in (" ".join(b), " ".join(signs), cubes, " ".join(["x"] * 700), " ".join(signs * 5)):
        assert found([text]) == [wanted(text)]


def test_neighbours_do_not_join_and_chunks_do_not_matter(monkeypatch):
    texts = ["a a a", "a a a", None, "", "a b a b a b a", "b a b a b", "a a a a a a"]
    assert found(texts) == [wanted(t) for t in texts]
    more = periodic_texts(2, 60)
    whole = found(more)
    monkeypatch.setattr(W, "CHUNK_BYTES", 40)
    assert found(more) == whole


def test_a_very_long_text():
    rng = random.Random(5)
    head = [f"w{rng.randint(0, 10**9)}" for _ in range(30_000)]
    unit = [f"u{i}" for i in range(20_000)]
    (n, runs, best, text), = found([" ".join(head + unit * 5 + ["end"] * 50_000)])
    assert n == 180_000 and runs == [(30_000, 100_000, 20_000), (130_000, 50_000, 1)] and best == runs[1]
    assert text == " ".join(head + unit + ["end"]).encode()


def test_shorter_runs_are_refused():
    with pytest.raises(ValueError):
        R.periodic_stretches(np.zeros(5, np.int64), np.array([0, 5]), 6, 3)


def test_rows_of_a_table(spark):
    rows = odd_corpus(seed=8)
    got = R.periodic_runs(frame(spark, rows), ["doc_id"]).collect()
    key = lambda r: (repr(r[0]), r[1:])
    mine = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"].encode()) for r in got), key=key)
    assert mine == sorted(((r[0], *(wanted(r[1])[i] for i in (0, 1, 3))) for r in rows), key=key)
    assert R.periodic_runs(empty(spark), ["doc_id"]).collect() == []


def rewritten(doc_id, text):
    words = ascii_words(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_the_query(spark, tmp_path):
    rows = odd_corpus(seed=9, n=300)
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    want = []
    for doc_id, text, *_ in rows:
        words = rewritten(doc_id, text)
        runs = brute_runs(words)
        best = brute_best(runs)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((doc_id, len(runs), *figures, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(brute_text(words, runs)).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(r["n_runs"] > 0 for r in got) > 5
