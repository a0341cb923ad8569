"""Further columns of any name pass through the operators unchanged."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketry.llm import decontaminate, linedup, mixing, neardup, repeats, weaklabels

#: names that the operators use inside, or have used, and names with special characters
NAMES = [
    "_key", "_copies", "_rows", "_more", "_score", "_hash", "_id", "_copy", "_range", "key", "id", "row", "removed", "lines", "copies",
    "n_rows", "copy", "row_hash", "more", "score", "label", "n", "size", "words", "hash", "spans", "check", "a.b", "c`d", "window", "at",
]


def decontaminated(docs):
    bench = docs.sparkSession.createDataFrame([(1, "leaked passage of some seven odd words")], "item_id long, text string")
    return decontaminate.decontaminate(docs, bench)


OPERATORS = {
    "mix": mixing.mix,
    "remove_repeated_lines": linedup.remove_repeated_lines,
    "deduplicate": neardup.deduplicate,
    "decontaminate": decontaminated,
    "keep_good": weaklabels.keep_good,
    "remove_repeats": repeats.remove_repeats,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_names_inside_do_not_meet_those_of_the_table(spark, name):
    texts = [f"the plain words of a text number {i} and so on in this way\nmore\nlines" for i in range(20)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    extra = {c: F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")) for c in NAMES}
    wide = docs.select("*", *[value.alias(c) for c, value in extra.items()])
    result = OPERATORS[name](wide)
    rows = result.collect()
    assert rows and result.columns[: len(wide.columns)] == wide.columns
    for row in rows:
        given = dict(zip(result.columns, row))
        assert all(given[c] == f"{c}:{given['doc_id']}" for c in NAMES)
    plain = OPERATORS[name](docs)
    assert sorted(r[:2] for r in plain.collect()) == sorted(r[:2] for r in rows)
