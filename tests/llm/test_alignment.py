"""Alignment of two tokenizers against whole-text encodings and plain loops over their tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from functools import cache

import numpy as np
import pytest

from basketry.llm import alignment, csr
from basketry.llm.queries import op11_gustavson_alignment, vocabulary
from tests.conftest import TESTDATA

A, B = vocabulary(), vocabulary("piece_bpe_32k.model")


@cache
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def whole(text):
    """Ids, and ends of both encodings of the whole text, or nothing."""
    a, b = tokenizers()
    byte_of = alignment._byte_of()
    ids_a = a.encode(f" {text}", add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
    if not text or not b"".join(bytes_a) == b"".join(bytes_b) == f" {text}".encode():
        return None
    ends = [np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b)]
    return ids_a, ids_b, *ends


def brute(texts):
    docs, counts = [], Counter()
    for text in texts:
        found = whole(text or "")
        if not found:
            docs.append(None)
            continue
        ids_a, ids_b, end_a, end_b = found
        cuts = sorted(set(end_a) & set(end_b))
        groups = []
        for lo, hi in zip([0, *cuts], cuts):
            x, y = ([i for i, e in zip(ids, ends) if lo < e <= hi] for ids, ends in ((ids_a, end_a), (ids_b, end_b)))
            groups.append(f"{','.join(map(str, x))}|{','.join(map(str, y))}")
        links = [(i, j) for i, e in zip(ids_a, end_a) for j, f in zip(ids_b, end_b) if e == f] if len(ids_a) < 300 else [
            (ids_a[end_a.index(c)], ids_b[end_b.index(c)]) for c in cuts
        ]
        counts.update(links)
        docs.append((len(ids_a), len(ids_b), groups, links))
    most: dict[int, int] = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = d
        best = sum(counts[x] == most[x[1]] for x in links)
        out.append((n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


ODD = [
    "plain words, don't we? it's 12345 1,000.50", "a  b", " lead", "  lead", "trail  ", "tab\tand \t mix", "x\ny", "x\n\ny", "x \n y", "\nstart",
    "end\n", "   ", " ", "\n", "", None, "日本語のテキスト 混ざる", "émigré über hard", "a b  c", "▁literal", "<|endoftext|> <s> </s> <0x0A> <unk>",
    "x" * 3000, "emoji 👩‍👩‍👧 ​ zero", "\x1c \x00 control\x1f x", "camelCase\n'quoted'\n's", "same same", "same same", "    indented\n        code(x)\n",
]


def digests(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = alignment.alignment_digests(docs, A, B).orderBy("doc_id").collect()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return [tuple(r[c] for c in names) for r in rows]


def test_odd_texts(spark):
    draw = random.Random(1)
    parts = [p for p in ODD if p] + [" ", "\n", "\t", "  "]
    texts = ODD + ["".join(draw.choice(parts)[:40] for _ in range(draw.randrange(1, 9))) for _ in range(150)]
    assert digests(spark, texts) == brute(texts)


def test_pieces_and_forgetting(spark, monkeypatch):
    draw = random.Random(2)
    texts = [" ".join(draw.choice(["word", "other", "thing\nline", "two  gaps", "ünïcode"]) for _ in range(200)) for _ in range(6)]
    for name, value in (("PIECE", 50), ("REMEMBERED", 5), ("MATRIX_CHARS", 20), ("GROUP", 300), ("RUN", 15)):
        monkeypatch.setattr(alignment, name, value)
    run = alignment.document_aligner(A, B)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["doc_id", "text"])
    rows = [r for b in run(iter([batch])) for r in b.to_pylist()]
    for row, expected in zip(rows, brute(texts), strict=True):
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"]) == expected[:4]
        assert row["groups_sha256"] == expected[6] and sum(row["times"]) == row["n_links"]
        assert row["pairs"] == sorted(set(row["pairs"]))


@pytest.mark.parametrize("kind", ["overlap", "together", "group"])
def test_links(spark, kind):
    texts = [t for t in ODD if t and len(t) < 100]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {tuple(r) for r in alignment.links(docs, A, B, kind).collect()}
    expected = set()
    for doc, text in enumerate(texts):
        if not (sides := whole(text)):
            continue
        ids_a, ids_b, end_a, end_b = sides
        cuts = sorted(set(end_a) & set(end_b))
        for i, (x, e) in enumerate(zip(ids_a, end_a)):
            for j, (y, f) in enumerate(zip(ids_b, end_b)):
                shared = min(e, f) - max([0, *end_a][i], [0, *end_b][j])
                one_group = np.searchsorted(cuts, e) == np.searchsorted(cuts, f)
                if {"overlap": shared > 0, "together": e == f, "group": one_group}[kind]:
                    expected.add((doc, i, j, x, y, 1 if kind == "group" else shared))
    assert found == expected


def test_bound_on_pairs_holds():
    aligner = alignment.Aligner(A, B)
    bound = aligner.most_pairs()
    assert 32_000 < bound < 1_000_000
    for _, _, pairs, _ in aligner.documents(ODD):
        for pair in pairs.tolist():
            a, b = aligner.bytes_a[pair // aligner.width], aligner.bytes_b[pair % aligner.width]
            assert a.endswith(b) or b.endswith(a)


def test_products():
    rng = np.random.default_rng(4)
    for _ in range(30):
        n, k, m = rng.integers(0, 7, 3)
        x, y = rng.integers(0, 3, (n, k)), rng.integers(0, 3, (k, m))
        parts = [csr.from_entries(*np.nonzero(d), d[np.nonzero(d)], *d.shape) for d in (x, y)]
        product = csr.multiply(*parts)
        dense = np.zeros((n, m), np.int64)
        dense[product.rows(), product.columns] = product.values
        assert (dense == x @ y).all() and (np.diff(product.starts) >= 0).all()
        turned = csr.transpose(parts[0])
        assert turned.height == k and sorted(zip(turned.columns, turned.rows())) == sorted(zip(*np.nonzero(x)))


def test_columns_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "same", 1), (None, "same", 2), (3, None, 3)], "doc_id long, text string, pairs int")
    rows = sorted(alignment.alignment_digests(docs, A, B).collect(), key=lambda r: r.n_a)
    assert [(r.doc_id, r.n_a) for r in rows] == [(3, 0), (None, 1), (None, 1)] and rows[1] == rows[2]
    assert alignment.alignment_digests(docs.limit(0), A, B).collect() == []
    with pytest.raises(ValueError):
        alignment.links(docs, A, B, "other")


def test_query_of_whole_table(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    expected = brute([d.text for d in docs])
    rows = op11_gustavson_alignment(spark, TESTDATA).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [(d.doc_id, *e) for d, e in zip(docs, expected)]
