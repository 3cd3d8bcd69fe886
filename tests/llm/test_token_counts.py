import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderloom.llm import token_counts as T
from orderloom.llm.scratch import scratch_path

from .corpus import empty, frame, odd_corpus

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def fast():
    with open(PATH, "rb") as file:
        return T.encoder(PATH, file.read())


def counts(library, texts):
    return [len(library.encode(t, add_special_tokens=False)) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_counts_are_the_librarys(text):
    library, fast = _both()
    values = [text, text + "<|endoftext|>" + text, " <|endoftext|>\n" + text]
    assert fast(values) == counts(library, values)


_pair = []


def _both():
    if not _pair:
        with open(PATH, "rb") as file:
            _pair.extend([Tokenizer.from_file(PATH), T.encoder(PATH, file.read())])
    return _pair


def test_spaces_and_marks(library, fast):
    odd = ["", " ", "\n\n a", "\u0085x y", "a​b　c", "é" * 50, "1²½Ⅷ", "don't I'LL 've", "᠎", "😀👩‍👩‍👧"]
    assert fast(odd) == counts(library, odd)


def test_long_runs_of_white_space(spark, library, fast):
    n = 1_200_000
    odd = [" " * n + "a", "a" + "\n" * n, "a" + "\t" * n + "b <|endoftext|>", "\u3000" * n + "b"]
    assert fast(odd) == counts(library, odd)
    rows = [(1, odd[0], "en", "s", 0, 0.0), (2, "a b", "en", "s", 0, 0.0)]
    got = T.count_tokens(frame(spark, rows), PATH, scratch_path(spark, "cache"), ["doc_id"]).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == dict(zip((1, 2), counts(library, [odd[0], "a b"])))


def test_every_document_and_a_warm_cache(spark, library):
    rows = odd_corpus(seed=21)
    cache = scratch_path(spark, "cache")
    got = T.count_tokens(frame(spark, rows), PATH, cache, ["doc_id"])
    want = sorted(((r[0], len((r[1] or "").encode()), n) for r, n in zip(rows, counts(library, [r[1] or "" for r in rows]))), key=repr)
    pick = lambda df: sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_tokens").collect()), key=repr)
    assert pick(got) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == len({r[1] or "" for r in rows})

    more = rows + [(900, "a text that was not there", "en", "s", 0, 0.0)]
    T.count_tokens(frame(spark, more), PATH, cache, ["doc_id"]).collect()
    assert spark.read.parquet(cache).count() == stored.count() + 1
    # Entries are taken from the cache, not counted again.
    digest = f"digest binary, n_tokens long, tokenizer string"
    with open(PATH, "rb") as file:
        version = T.tokenizer_digest(PATH, file.read())
    lie = scratch_path(spark, "cache")
    known = spark.read.schema(digest).parquet(cache).filter("n_tokens > 3").selectExpr("digest", "-n_tokens AS n_tokens")
    T.TokenCache(spark, lie).append(known, version)
    found = T.count_tokens(frame(spark, rows), PATH, lie, ["doc_id"]).collect()
    assert any(r["n_tokens"] < 0 for r in found)


def test_versions_do_not_mix(spark):
    rows = odd_corpus(seed=21, n=5)
    cache = scratch_path(spark, "cache")
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"):
        path = public_tokenizers.path(name)
        got = T.count_tokens(frame(spark, rows), path, cache, ["doc_id", "text"]).collect()
        assert len(got) == len(rows)
        with open(path, "rb") as file:
            encode = T.encoder(path, file.read())
        assert all(r["n_tokens"] == encode([r["text"] or ""])[0] for r in got)


def test_empty_table(spark):
    assert T.count_tokens(empty(spark), PATH, scratch_path(spark, "cache"), ["doc_id"]).collect() == []
