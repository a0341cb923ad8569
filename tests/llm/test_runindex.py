"""The run-length index against counted substrings."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from basketry.llm import runindex


def covered(rows: list[bytes], counts: list[int], least: int) -> list[tuple[int, int, int]]:
    """Maximal stretches covered by strings that start more than once, by counting all of them."""
    seen = Counter()
    for row, n in zip(rows, counts):
        for i in range(len(row) - least + 1):
            seen[row[i : i + least]] += n
    out = []
    for j, row in enumerate(rows):
        spans: list[list[int]] = []
        for i in range(len(row) - least + 1):
            if seen[row[i : i + least]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + least
                else:
                    spans.append([i, i + least])
        out += [(j, a, b) for a, b in spans]
    return out


@pytest.mark.parametrize("alphabet", [1, 2, 4, 250])
def test_spans_of_random_rows(alphabet):
    draw = random.Random(alphabet)
    for _ in range(80):
        rows = [bytes(draw.randrange(alphabet) for _ in range(draw.randrange(60))) for _ in range(draw.randrange(1, 10))]
        rows += [rows[0][5:] + b"\xff" + rows[-1][:30]] * draw.randrange(2)
        counts = [draw.choice([1, 1, 1, 3]) for _ in rows]
        least = draw.choice([1, 2, 5, 16])
        found = runindex.repeated_spans(rows, np.array(counts), least)
        assert list(zip(*(x.tolist() for x in found))) == covered(rows, counts, least)


def test_order_and_runs():
    rows = [b"banana", b"", b"ananas", b"banana"]
    symbols, begins, left = runindex.layout(rows)
    order = runindex.suffix_order(symbols, left)
    text = b"\0".join(rows) + b"\0"
    expected = sorted(range(len(text)), key=lambda i: (text[i : i + left[i]], i))
    assert order.tolist() == expected
    index = runindex.build(symbols, left)
    assert index.length.sum() == len(text)
    assert np.repeat(index.symbol, index.length).tolist() == symbols[order - 1].tolist()
    assert index.first.tolist() == order[np.append(0, np.cumsum(index.length)[:-1])].tolist()
    assert index.last.tolist() == order[np.cumsum(index.length) - 1].tolist()


def test_copies_add_few_runs():
    draw = random.Random(5)
    row = bytes(draw.randrange(97, 123) for _ in range(3000))
    runs = [len(runindex.build(*np.array(runindex.layout([row] * n), dtype=object)[[0, 2]]).length) for n in (1, 20)]
    assert runs[1] < runs[0] + 25  # a terminator each, and nothing for the text


def test_large_block_sorts_without_packing(monkeypatch):
    rows = [b"abcabcabcabd" * 3, b"xabcabcabcab", b"q"]
    expected = covered(rows, [1, 1, 1], 7)
    monkeypatch.setattr(runindex, "_PACKED", 2)
    found = runindex.repeated_spans(rows, np.array([1, 1, 1]), 7)
    assert list(zip(*(x.tolist() for x in found))) == expected


def test_nothing():
    assert [len(x) for x in runindex.repeated_spans([], np.zeros(0, int), 5)] == [0, 0, 0]
    assert [len(x) for x in runindex.repeated_spans([b"", b"ab"], np.array([2, 1]), 5)] == [0, 0, 0]
