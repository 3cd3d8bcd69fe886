"""The numpy text helpers against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import words as W

texts = st.lists(st.one_of(st.none(), st.text(max_size=40), st.text("ab \n", max_size=40)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(texts, st.integers(1, 40))
def test_words_are_runs_within_a_text(values, limit):
    found = []
    for _, buffer, bounds in W.chunks(pa.array(values, pa.string()), limit):
        words = W.runs(W.NOT_SPACE[buffer], bounds)
        data = buffer.tobytes()
        for d in range(len(bounds) - 1):
            own = range(words.first[d], words.first[d + 1])
            found.append([data[words.start[i] : words.end[i]] for i in own])
    assert found == [(v or "").encode().split() for v in values]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab c", max_size=30), min_size=1, max_size=6), st.integers(1, 4))
def test_equal_windows_have_equal_hashes(values, width):
    (_, buffer, bounds), = W.chunks(pa.array(values, pa.string()))
    words = W.runs(W.NOT_SPACE[buffer], bounds)
    starts = W.window_starts(words, width)
    hashes = W.window_hashes(W.word_hashes(buffer, words), starts, width)
    spans = [tuple(w) for v in values for t in [v.split()] for w in (t[i : i + width] for i in range(len(t) - width + 1))]
    assert len(spans) == len(starts)
    by_span = {}
    for span, h in zip(spans, hashes.tolist()):
        assert by_span.setdefault(span, h) == h
    assert len(set(by_span.values())) == len(by_span)


def test_sliced_arrays_and_empty_ones():
    column = pa.array(["x", "one two", None, "three"])[1:]
    buffer, bounds = W.text_bytes(column)
    assert buffer.tobytes() == b"one twothree" and bounds.tolist() == [0, 7, 7, 12]
    assert list(W.chunks(pa.array([], pa.string()))) == []
    assert len(list(W.chunks(pa.array(["a" * 10, "b"]), 3))) == 2


def test_byte_classes_are_those_of_the_patterns():
    ascii_text = bytes(range(128)).decode()
    assert {chr(i) for i in np.flatnonzero(W.NOT_SPACE[:128])} == set(re.findall(r"[^\x20\x09-\x0D]", ascii_text))
    assert {chr(i) for i in np.flatnonzero(W.ALNUM[:128])} == set(re.findall("[0-9A-Za-z]", ascii_text))
    assert W.covered(6, np.array([1, 2]), 2).tolist() == [False, True, True, True, False, False]
