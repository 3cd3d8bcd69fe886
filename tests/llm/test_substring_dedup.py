import collections

from orderloom.llm import exchange
from orderloom.llm.substring_dedup import remove_repeats

from .corpus import ascii_words, empty, frame, odd_corpus


def brute(rows, width):
    texts = [ascii_words(r[1]) for r in rows]
    counts = collections.Counter(tuple(t[i : i + width]) for t in texts for i in range(len(t) - width + 1))
    out = []
    for row, t in zip(rows, texts):
        gone = set()
        for i in range(len(t) - width + 1):
            if counts[tuple(t[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = b" ".join(w for i, w in enumerate(t) if i not in gone).decode()
        out.append((row[0], len(t), len(gone), kept))
    return sorted(out, key=repr)


def found(df, width):
    return sorted((tuple(r) for r in remove_repeats(df, ["doc_id"], width=width).collect()), key=repr)


def test_matches_brute_force(spark):
    rows = odd_corpus(seed=2, n=80)
    for width in (1, 6, 35):
        assert found(frame(spark, rows), width) == brute(rows, width)


def test_small_buffers_and_many_buckets_give_the_same(spark, monkeypatch):
    rows = odd_corpus(seed=3, n=40)
    monkeypatch.setattr(exchange, "BUFFER", 500)
    monkeypatch.setattr("orderloom.llm.substring_dedup.BUCKET_BYTES", 2000)
    assert found(frame(spark, rows, 7), 35) == brute(rows, 35)


def test_empty_table_and_types(spark):
    out = remove_repeats(empty(spark), ["doc_id"])
    assert out.collect() == [] and out.columns == ["doc_id", "n_words", "n_removed", "kept_text"]


def test_repeat_within_one_text_and_at_the_edges(spark):
    passage = " ".join(f"w{i}" for i in range(35))
    rows = [(1, f"{passage} x {passage}", None, None, 0, 0.0), (2, passage + " y", None, None, 0, 0.0), (3, passage[:-1] + "q", None, None, 0, 0.0)]
    got = {r["doc_id"]: (r["n_removed"], r["kept_text"][:3]) for r in remove_repeats(frame(spark, rows), ["doc_id"]).collect()}
    assert got[1] == (70, "x") and got[2] == (35, "y") and got[3][0] == 0
