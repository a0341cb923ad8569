"""Repeated windows of lines against a plain search."""

import random
import time

from basketry.llm import linedup

SCHEMA = "doc_id long, text string, removed string"


def brute(rows):
    """Rows ordered by id; equal rows are one document."""
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: r[0])
    first, cut = {}, {}
    for i, t in docs:
        lines = t.split("\n")
        for at in range(len(lines) - 2):
            first.setdefault(tuple(lines[at : at + 3]), (i, at))
    for i, t in docs:
        lines = t.split("\n")
        for at in range(len(lines) - 2):
            doc, start = first[tuple(lines[at : at + 3])]
            if (doc, start) != (i, at):
                cut.setdefault(i, set()).update(range(max(at, start + 3) if doc == i else at, at + 3))
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut.get(i, ())) for i, t in docs}


def test_windows(spark):
    pick = random.Random(4)
    rows = [(i, "\n".join(pick.choice("abc") for _ in range(pick.randrange(12)))) for i in range(40)]
    rows += [(50, "x\nx\nx\nx\nx\nx\nx"), (51, None), (52, ""), (53, "p\nq"), (54, "\n\n\n\n"), (7, rows[7][1])]
    df = spark.createDataFrame([(*r, "keep") for r in rows], SCHEMA).repartition(4)
    want = brute(rows)
    got = linedup.remove_repeated_lines(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["text"] == want.get(r["doc_id"]) and r["removed"] == "keep"
        lines = dict(rows)[r["doc_id"]]
        assert r["n_lines"] == (0 if lines is None else len(lines.split("\n")))


def test_the_first_occurrence_stays_whole(spark):
    rows = [(1, "intro\na\nb\nc\nd", "x"), (2, "a\nb\nc\nd\nend", "x"), (3, "b\nc\nd", "x")]
    df = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in linedup.remove_repeated_lines(df).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("end", 4), 3: ("", 3)}
    assert linedup.remove_repeated_lines(df.limit(0)).count() == 0


def test_very_many_lines(spark):
    """Work grows with the lines: 200,000 of them, all of them seen before."""
    text = "\n".join(["a", "b", "c"] * 66_667)
    df = spark.createDataFrame([(1, "a\nb\nc"), (2, text)], "doc_id long, text string")
    start = time.perf_counter()
    got = {r["doc_id"]: r for r in linedup.remove_repeated_lines(df).collect()}
    assert time.perf_counter() - start < 10
    assert got[2]["n_lines"] == got[2]["n_removed"] == 200_001 and got[2]["text"] == "" and got[1]["text"] == "a\nb\nc"
