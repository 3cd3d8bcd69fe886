import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderloom.llm import encoding, queries
from orderloom.llm import token_files as T
from orderloom.llm.scratch import scratch_path

from .corpus import empty, frame, odd_corpus

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1))))
def test_streams_round_trip(values):
    values = np.array(values, dtype=np.uint32)
    control, data = T.pack(values)
    assert len(control) == -(-len(values) // 4)
    assert len(data) == sum(max(1, -(-int(v).bit_length() // 8)) for v in values)
    assert T.unpack(control, data, len(values)).tolist() == values.tolist()


def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_ids_and_bytes_are_the_librarys():
    with open(PATH, "rb") as file:
        data = file.read()
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    texts = ["", " a", "x<|endoftext|>y", "é▁日本 \n\t", "\u0000", "<|endoftext|>"]
    pieces = encoding.id_bytes(PATH, data)
    for special, ids in ((True, library()), (False, lambda t: [*plain.encode(t, add_special_tokens=False).ids, 2])):
        encode = encoding.id_encoder(PATH, data, special)
        assert [[*x.tolist(), 2] for x in encode(texts)] == [ids(t) for t in texts]
    assert [b"".join(pieces[i] for i in x) for x in encode(texts)] == [t.encode() for t in texts]


def order(row):
    return (row[0] is not None, row[0] or 0)


@pytest.mark.parametrize("segment,part", [(1 << 18, 1 << 23), (64, 1500)])
def test_files_hold_every_document_in_order(spark, monkeypatch, segment, part):
    monkeypatch.setattr(T, "SEGMENT_IDS", segment)
    monkeypatch.setattr(T, "PART_IDS", part)
    monkeypatch.setattr(T, "BLOCK", 2)
    rows, ids = odd_corpus(seed=41), library()
    path = scratch_path(spark, "files")
    T.write_tokens(frame(spark, rows), PATH, 2, path, ["doc_id"])
    got = sorted(T.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [r[0] for r in sorted(rows, key=order)]
    assert [r["start"] for r in got] == np.cumsum([0, *[len(r["ids"]) for r in got]])[:-1].tolist()
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=repr) == sorted(((r[0], ids(r[1])) for r in rows), key=repr)
    for r in got:
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    stored = spark.read.parquet(f"{path}/segments")
    assert (stored.select("part").distinct().count() > 3) == (part == 1500)
    # Common ids take one byte, and none more than its rank needs.
    ranks = {r["id"]: r["rank"] for r in spark.read.parquet(f"{path}/ranks").collect()}
    n = {r["id"]: r["n"] for r in spark.read.parquet(f"{path}/ranks").collect()}
    assert sorted(ranks, key=lambda i: (-n[i], i)) == sorted(ranks, key=ranks.get)
    size = sum(len(r["data"]) for r in stored.select("data").collect())
    assert size == sum(c * (1 if ranks[i] < 256 else 2) for i, c in n.items())


def test_copies_of_one_row_are_cut(spark, monkeypatch):
    monkeypatch.setattr(T, "PART_IDS", 200)
    rows = [(7, "the same words in all rows", "en", "s", 0, 0.0)] * 300 + [(8, None, "en", "s", 0, 0.0)]
    path = scratch_path(spark, "files")
    T.write_tokens(frame(spark, rows), PATH, 2, path, ["doc_id"])
    got = sorted(T.read_tokens(spark, path, with_ids=False).collect(), key=lambda r: r["start"])
    assert [r["start"] for r in got] == [7 * i for i in range(301)] and got[-1]["doc_id"] == 8
    assert spark.read.parquet(f"{path}/segments").groupBy("part").sum().count() > 3


def test_wide_ids(spark):
    assert T.id_type(PATH, 2) == "<u2" and T.id_type(PATH, 70_000) == "<u4"
    rows, path = odd_corpus(seed=44, n=10), scratch_path(spark, "files")
    T.write_tokens(frame(spark, rows), PATH, 70_000, path, ["doc_id"])
    ids = library()
    got = T.read_tokens(spark, path).collect()
    assert sorted((r["ids"] for r in got)) == sorted([*ids(r[1])[:-1], 70_000] for r in rows)


def test_other_files_and_keys(spark):
    rows = odd_corpus(seed=42, n=20)
    path = scratch_path(spark, "files")
    T.write_tokens(frame(spark, rows), MODEL, 2, path, ["lang", "doc_id"])
    got = sorted(T.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert len(got) == len(rows) and [r["lang"] or "" for r in got] == sorted(r[2] or "" for r in rows)


def test_query_and_empty_table(spark, tmp_path):
    frame(spark, odd_corpus(seed=43)).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_token_files(spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() == len(odd_corpus(seed=43))
    path = scratch_path(spark, "files")
    T.write_tokens(empty(spark), PATH, 2, path, ["doc_id"])
    assert T.read_tokens(spark, path).collect() == []
