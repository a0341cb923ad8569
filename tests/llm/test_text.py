"""Byte helpers against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import _text

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="aBcé \n\t. ", max_size=30)), max_size=8)


@settings(deadline=None)
@given(texts)
def test_words(rows):
    data, offsets = _text.flat(pa.array(rows, pa.string()))
    starts, ends, of = _text.word_bounds(data, offsets)
    got = [(int(r), bytes(data[a:b]).decode()) for a, b, r in zip(starts, ends, of)]
    assert got == [(i, w) for i, t in enumerate(rows) for w in WORD.findall(t or "")]


@settings(deadline=None)
@given(texts)
def test_hashes_depend_on_the_word_alone(rows):
    data, offsets = _text.flat(pa.array(rows, pa.string()))
    starts, ends, _ = _text.word_bounds(data, offsets)
    hashes = _text.word_hashes(data, starts, ends)
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), bytes(data[a:b]).decode()) for a, b in zip(starts, ends)]
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(f"w{i % 50}" for i in range(3000))
    data, offsets = _text.flat(pa.array([text]))
    whole = _text.word_hashes(data, *_text.word_bounds(data, offsets)[:2])
    monkeypatch.setattr(_text, "CHUNK_BYTES", 64)
    assert (_text.word_hashes(data, *_text.word_bounds(data, offsets)[:2]) == whole).all()


def test_chunks_and_ragged():
    offsets = np.array([0, 5, 5, 30, 31, 40])
    assert list(_text.chunks(offsets, 10)) == [(0, 2), (2, 3), (3, 5)]
    assert _text.ragged(np.array([4, 9, 1]), np.array([2, 0, 3])).tolist() == [4, 5, 1, 2, 3]
