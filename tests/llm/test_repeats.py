"""Removal of repeated byte strings against counted substrings of whole texts."""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest

from basketry.llm import repeats
from basketry.llm.queries import op12_run_length_repeats
from tests.conftest import TESTDATA
from tests.llm.test_runindex import covered

BANDS = (12, 5, 2, 1)
SMALL = repeats.Sizes(24, 6, 5, BANDS)


def expected(texts: list[str | None], least: int) -> list[tuple[int, int, int, bytes]]:
    rows = [(t or "").encode() for t in texts]
    spans: dict[int, list[tuple[int, int]]] = {}
    for j, a, b in covered(rows, [1] * len(rows), least):
        spans.setdefault(j, []).append((a, b))
    out = []
    for j, row in enumerate(rows):
        mine = spans.get(j, [])
        edges = [0, *(x for s in mine for x in s), len(row)]
        kept = b"".join(row[a:b] for a, b in zip(edges[::2], edges[1::2]))
        out.append((len(row), sum(b - a for a, b in mine), len(mine), kept))
    return out


def removed(spark, texts, sizes, **kw):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = repeats.remove_repeats(docs, sizes=sizes, **kw).orderBy("doc_id").collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows]


def corpus(seed: int) -> list[str | None]:
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé ") for _ in range(draw.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    hot = prose(5)
    texts: list[str | None] = [prose(draw.randrange(40)) for _ in range(25)]
    texts += [f"{prose(draw.randrange(9))} {hot} {prose(draw.randrange(9))}" for _ in range(20)]
    texts += [texts[30][:70] + prose(2), texts[31], texts[31], None, "", "", "a" * 200, "ab" * 90, texts[0] + texts[0]]
    return texts


@pytest.mark.parametrize("hot", [2, 5, 10_000])
def test_against_counted_substrings(spark, hot):
    texts = corpus(hot)
    assert removed(spark, texts, repeats.Sizes(24, 6, hot, BANDS)) == expected(texts, 24)


def test_pieces_of_long_texts_and_full_stretches(spark, monkeypatch):
    draw = random.Random(3)
    long = "".join(draw.choice("abcdefgh") for _ in range(6000))
    texts = [long, long[1000:4100] + "x" + long[:50], "z" * 5000, "other"]
    whole = expected(texts, 24)
    monkeypatch.setattr(repeats, "SLICE", 700)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 500)
    finder = repeats.entry_finder(SMALL)
    assert sum(b.num_rows for b in finder(iter([_batch(texts)]))) > 4
    assert removed(spark, texts, SMALL) == whole


def _batch(texts):
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array([1] * len(texts), pa.int32()), pa.array([t.encode() for t in texts])],
        names=["key", "check", "text"],
    )


def test_every_string_is_in_one_stretch():
    texts = [t or "" for t in corpus(9)]
    rows = [r for b in repeats.entry_finder(SMALL)(iter([_batch(texts)])) for r in b.to_pylist()]
    strings: dict[int, list[int]] = {}
    anchors: dict[bytes, set[int]] = {}
    for r in rows:
        body, start, n = texts[r["key"]].encode(), r["at"] >> 12 & 0x7FFFFFFF, r["at"] & 0x7FF
        for i in range(start, start + n - SMALL.length + 1):
            strings.setdefault(r["key"], []).append(i)
            anchors.setdefault(body[i : i + SMALL.length], set()).add(r["anchor"])
    for key, text in enumerate(texts):
        assert sorted(strings.get(key, [])) == list(range(len(text.encode()) - SMALL.length + 1))
    assert all(len(a) == 1 for a in anchors.values())


def test_bands_of_one_share_whole_strings():
    """Parts that are dealt together at the last level are equal, so no group of a hot anchor can grow."""
    texts = [t or "" for t in corpus(4)]
    entries = [r for b in repeats.entry_finder(SMALL)(iter([_batch(texts)])) for r in b.to_pylist()]
    for width in BANDS:
        wanted = [[{**e, "n": 1} for e in entries if e["key"] == k] for k in range(len(texts))]
        batch = _batch(texts)
        batch = batch.append_column("wanted", pa.array(wanted))
        parts = [r for b in repeats.band_splitter(SMALL, width)(iter([batch])) for r in b.to_pylist()]
        strings = {k: sorted(i for r in parts if r["key"] == k for i in starts(r)) for k in range(len(texts))}
        assert strings == {k: list(range(max(0, len(t.encode()) - 23))) for k, t in enumerate(texts)}
        dealt: dict[bytes, set[int]] = {}
        for r in parts:
            for i in starts(r):
                dealt.setdefault(texts[r["key"]].encode()[i : i + 24], set()).add(r["anchor"])
        assert all(len(a) == 1 for a in dealt.values())
        entries = parts
    assert len({r["anchor"] for r in parts}) == len(dealt)


def starts(row):
    first = row["at"] >> 12 & 0x7FFFFFFF
    return range(first, first + (row["at"] & 0x7FF) - 23)


def test_columns_rows_and_empty_tables(spark):
    text = "the same line of text, long enough"
    docs = spark.createDataFrame(
        [(1, text, 5, "k"), (1, text, 5, "k"), (None, "short", 6, None)], "doc_id long, text string, n_bytes int, key string"
    )
    rows = sorted(repeats.remove_repeats(docs, sizes=SMALL).collect(), key=lambda r: r.n_bytes)
    assert [tuple(r)[:4] for r in rows] == [(1, text, 5, "k"), (1, text, 5, "k"), (None, "short", 6, None)]
    assert rows[0].asDict()["n_bytes_"] == len(text) and [r.n_removed for r in rows] == [len(text), len(text), 0]
    assert repeats.remove_repeats(docs.limit(0), sizes=SMALL).collect() == []
    assert repeats.remove_repeats(docs.where("doc_id IS NULL"), with_bytes=False, sizes=SMALL).first().kept_sha256 == (
        hashlib.sha256(b"short").hexdigest()
    )


def test_query_of_whole_table(spark):
    sf_dir = TESTDATA
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    whole = expected([d.text for d in docs], repeats.LENGTH)
    found = {r.doc_id: tuple(r)[1:] for r in op12_run_length_repeats(spark, sf_dir).collect()}
    assert found == {d.doc_id: (n, m, s, hashlib.sha256(kept).hexdigest()) for d, (n, m, s, kept) in zip(docs, whole)}
    assert any(m for _, m, _, _ in whole)
