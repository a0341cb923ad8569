"""Digests and the edited texts, against a plain loop."""

import hashlib
import random

import numpy as np

from basketry.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, fingerprint string"


def test_counts_and_pieces(monkeypatch):
    raw = np.frombuffer(("fox jumps over é " * 60).encode(), np.uint8)
    whole = fp._buckets(raw)
    n = len(raw)
    assert whole.sum() == (n - 2) + 2 * (n - 3)
    monkeypatch.setattr(fp, "CHUNK_BYTES", 17)
    assert (fp._buckets(raw) == whole).all()


def test_likeness():
    pick = random.Random(3)
    word = lambda: "".join(pick.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(400)]
    edited = [word() if pick.random() < 0.1 else w for w in base]
    a, b, c = (fp.codes(" ".join(w)) for w in (base, edited, [pick.choice("xyz") * 5 for _ in range(400)]))
    assert fp.likeness(a, a) == 1 and fp.likeness(a, b) == fp.likeness(b, a) > 0.6 > 0.3 > fp.likeness(a, c) >= 0
    assert (fp.undigest(fp.digest(a)) == a).all()
    assert fp.likeness(fp.codes(""), fp.codes("")) == 1 and len(fp.digest(fp.codes("é"))) == 132


def test_edited_texts(spark):
    pick = random.Random(5)
    rows = [(i * 2, "".join(pick.choice("ab é😀") for _ in range(pick.randrange(60)))) for i in range(80)]
    rows += [(500, None), (501, ""), (None, "last of all")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(6)
    got = {r["doc_id"]: r for r in fp.edited_likeness(df).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        r, a, e, n = got[i], fp.codes(text), fp.codes(edited), fp.codes(after)
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fp.digest(a), fp.digest(e))
        assert (r["near_edited"], r["near_next"]) == (fp.likeness(a, e), fp.likeness(a, n))


def test_one_row_none_and_repeated(spark):
    df = spark.createDataFrame([(1, "one text", "x")], SCHEMA)
    assert fp.edited_likeness(df).first()["near_next"] == 1
    assert fp.edited_likeness(df.limit(0)).count() == 0
    assert fp.edited_likeness(df.union(df).union(df)).count() == 3
    both = fp.fingerprint(df.select("doc_id", "text")).withColumn("again", fp.compare("fingerprint", "fingerprint"))
    assert both.first()["again"] == 1
