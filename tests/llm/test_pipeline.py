"""The pipeline's stages one by one, and the registered queries with SQL."""

import duckdb

import __spark_entry__ as driver
import corpus_pipeline
from basketry.llm.queries import ORACLES, QUERIES
from tests.conftest import TESTDATA
from tests.llm.test_mixing import targets
from tests.llm.test_neardup import brute
from tests.llm.test_tokens import expected


def test_queries_are_registered():
    assert {*QUERIES, "pipeline"} <= set(driver.queries())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").cache()
    columns, results = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, TESTDATA).cache()
        results.append([tuple(r) for r in docs.collect()])
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    good, distinct, clean, mixed, tokens = results
    groups = brute([r[:2] for r in good], 80)
    assert sorted(r[0] for r in distinct) == sorted({c for _, _, c in groups})
    leaks = {r[0] for r in distinct} - {r[0] for r in clean}
    bench = [b["text"] for b in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect()]
    assert leaks == {r[0] for r in distinct if any(b.lower() in r[1].lower() for b in bench)}
    words = lambda rows: {s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in {r[3] for r in rows}}
    want = targets(words(clean))
    for source, n in words(mixed).items():
        assert abs(n - want[source]) <= max(len(r[1].split()) for r in clean if r[3] == source)
    mixed.sort(key=lambda r: r[0])
    assert sorted(tokens, key=lambda r: r[1]) == list(expected([r[:2] for r in mixed]))


def test_near_copies_between_80_and_85_are_linked(spark):
    """One word in the middle replaced: 5 of the shingles differ on either side."""
    words = [f"word{i}" for i in range(54)]
    changed = [*words[:27], "other", *words[28:]]
    same, every = len(words) - 4 - 5, len(words) - 4 + 5
    assert 0.80 <= same / every < 0.85
    texts = [" ".join(words), " ".join(changed), "quite another text of some words that stand alone in here"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, TESTDATA).collect()) == [0, 2]


def test_run(spark):
    assert corpus_pipeline.run(spark, TESTDATA).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_sql(spark):
    connection = duckdb.connect()
    for table in ("documents", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    for name, sql in ORACLES.items():
        result = QUERIES[name](spark, TESTDATA)
        columns = sorted(result.columns)
        want = connection.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert sorted(map(repr, want)) == sorted(repr(tuple(r[c] for c in columns)) for r in result.collect()), name
