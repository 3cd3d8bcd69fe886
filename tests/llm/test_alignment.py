import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderloom.llm import alignment as A
from orderloom.llm import encoding
from orderloom.llm import queries
from orderloom.llm.scratch import staged

from .corpus import empty, frame, odd_corpus

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute_groups(a, b):
    """Tokens (id, start, end) of both sides, cut where both end; and overlapping pairs."""
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, low = [], 0
    for high in cuts:
        inside = [",".join(str(i) for i, s, e in side if low <= s and e <= high) for side in (a, b)]
        groups.append("|".join(inside))
        low = high
    pairs = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
    return groups, pairs


def placed(ids, sizes):
    ends = np.cumsum([0, *sizes]).tolist()
    return list(zip(ids, ends[:-1], ends[1:]))


class Library:
    """Both libraries, by the contract's words."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.level = {c: b for b, c in enumerate(self.bytes_in_order())}
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])

    @staticmethod
    def bytes_in_order():
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False)
        a_bytes = [bytes(self.level[c] for c in t) for t in a.tokens]
        b = self.b.encode(text)
        names = [self.b.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names)]
        want = b" " + text.encode()
        if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            return [], []
        return placed(a.ids, map(len, a_bytes)), placed(b, map(len, b_bytes))


@pytest.fixture(scope="module")
def library():
    return Library()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=30), st.data())
def test_pointers_end_at_common_ends(sizes, data):
    total = sum(sizes)
    others = sorted({*data.draw(st.lists(st.integers(1, total), max_size=20)), total})
    a_end, b_end = np.cumsum(sizes), np.array(others)
    common = sorted(set(a_end.tolist()) & set(others))
    got = A.terminals(a_end, b_end)
    ends = np.concatenate([a_end, b_end])
    assert (got >= len(sizes)).all()
    assert ends[got].tolist() == [min(c for c in common if c >= e) for e in ends.tolist()]
    a, b = placed(range(len(sizes)), sizes), placed(range(len(others)), np.diff([0, *others]).tolist())
    pairs = A.links(a_end, b_end)
    assert len(pairs[0]) == len(sizes) + len(others) - len(common)
    assert list(zip(pairs[0].tolist(), pairs[1].tolist())) == sorted(brute_groups(a, b)[1])


def test_long_chains_converge():
    n = 100_000
    a_end, b_end = np.r_[np.arange(1, 2 * n, 2), 2 * n], np.arange(2, 2 * n + 1, 2)
    assert set(A.terminals(a_end, b_end).tolist()) == {len(a_end) + n - 1}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r▁aAb'1<>é日　\xa0"), st.characters(codec="utf-8")), max_size=30), max_size=4))
def test_ids_have_the_texts_bytes_or_are_none(values):
    if not _known:
        for path in PATHS:
            with open(path, "rb") as file:
                data = file.read()
            _known.append((encoding.id_encoder(path, data, special=False, check=True), encoding.id_bytes(path, data)))
        _known.append(Library())
    for (encode, of), spaced, library in zip(_known, (True, False), ((lambda t: _known[2].a.encode(t, add_special_tokens=False).ids), _known[2].b.encode)):
        for text, got in zip(values, encode([" " + t if spaced else t for t in values])):
            ids = library(" " + text if spaced else text)
            same = b"".join(of[i] for i in ids) == (" " + text if text or spaced else "").encode()
            assert got.tolist() == ids if same else got is None


_known = []


def texts(seed):
    odd = [r[1] for r in odd_corpus(seed=seed)]
    return odd + [
        " ", "a▁b", "<|endoftext|> <s> </s> <unk> <0x41>", "\u0000", "日本語のテキスト 😀", "   lead", "trail   ", "\ta\n\nb",
        "é ﬁ Ａ", "unbelievable tokenization", "　wide", "l'été naïve Straße",
    ]


def want(library, corpus):
    cut = [library.tokens(t or "") for t in corpus]
    found = [brute_groups(a, b) for a, b in cut]
    n = Counter(pair for _, pairs in found for pair in pairs)
    most = Counter()
    for (_, second), count in n.items():
        most[second] = max(most[second], count)
    out = []
    for (a, b), (groups, pairs) in zip(cut, found):
        best = sum(n[p] == most[p[1]] for p in pairs)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((len(a), len(b), len(groups), len(pairs), best, sum(n[p] for p in pairs), digest))
    return out


def test_the_query(spark, tmp_path, library):
    corpus = [t for t in texts(51) if len(t or "") < 2000]
    rows = [(i % 70, t, "en", "s", 0, 0.0) for i, t in enumerate(corpus)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_alignment(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], *w) for r, w in zip(rows, want(library, corpus))), key=repr)
    assert sum(r["n_a"] == 0 for r in got) >= 5 and max(r["n_groups"] for r in got) > 50


@pytest.mark.parametrize("most", [0, 3, 40])
def test_rare_pairs_are_joined(spark, library, monkeypatch, most):
    monkeypatch.setattr(A, "HELD_PAIRS", 5)
    monkeypatch.setattr(A, "RUN_TOKENS", 30)
    monkeypatch.setattr(A, "RUN_BYTES", 100)
    corpus = [t for t in texts(52) if len(t or "") < 400]
    rows = [(i, t, "en", "s", 0, 0.0) for i, t in enumerate(corpus)]
    aligned = staged(A.align(frame(spark, rows), *PATHS, ["doc_id"]), "aligned")
    got = {r["doc_id"]: r for r in A.with_pair_counts(aligned, *PATHS, "doc_id", most).collect()}
    for i, w in enumerate(want(library, corpus)):
        assert (got[i]["n_a"], got[i]["n_best"], got[i]["count_sum"]) == (w[0], w[4], w[5])
    counts = A.pair_counts(aligned, *PATHS)
    least = A.frequent_from(counts, most)
    assert counts.filter(counts.n >= least).count() <= most


def test_a_long_text_and_no_rows(spark, tmp_path):
    text = " ".join(f"word{i % 977} ünder" for i in range(60_000))
    aligned = A.align(frame(spark, [(1, text, "en", "s", 0, 0.0), (1, text, "en", "s", 0, 0.0)]), *PATHS, ["doc_id"]).collect()
    assert len(aligned) == 2 and aligned[0] == aligned[1]
    assert aligned[0]["n_links"] == aligned[0]["n_a"] + aligned[0]["n_b"] - aligned[0]["n_groups"]
    empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op13_alignment(spark, str(tmp_path)).collect() == []
