"""The label model on known labellers, the classifier on labels it never saw."""

import tracemalloc

import numpy as np

from basketry.llm import weaklabels as wl
from tests.conftest import TESTDATA

LABELLED = TESTDATA.replace("0.001", "0.01")


def test_em_finds_the_accuracies():
    random = np.random.default_rng(3)
    truth = random.random(20_000) < 0.8
    rates = np.linspace(0.6, 0.95, wl.LABELLERS)
    given = np.where(random.random((len(truth), wl.LABELLERS)) < rates, truth[:, None], ~truth[:, None]).astype(int)
    given[random.random(given.shape) < 0.2] = wl.NONE
    codes, counts = np.unique(given @ wl._PLACES, return_counts=True)
    model = wl.estimate(codes, counts.astype(float))
    assert np.abs(model.accuracies() - rates).max() < 0.04 and abs(model.good - 0.8) < 0.03
    assert ((model.posterior(given @ wl._PLACES) > 0.5) == truth).mean() > 0.97


def test_labels_never_seen(spark):
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet").select("doc_id", "quality")
    scored = wl.classify(spark.read.parquet(f"{LABELLED}/documents.parquet"))
    rows = scored.join(labels, "doc_id").collect()
    good = [r for r in rows if r["quality"] == 1]
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) / len(rows) > 0.97
    assert sum(r["kept"] for r in good) / len(good) > 0.98


def test_edges(spark):
    schema = "doc_id long, text string, score string, hash string"
    clean = "the cat sat on the mat and it was warm in the sun for a while"
    rows = [(i, f"{clean} {i}", "s", "h") for i in range(20)] + [(30, None, "s", "h"), (31, "", "s", "h"), (31, "", "s", "h")]
    df = spark.createDataFrame(rows, schema)
    got = {r["doc_id"]: r["kept"] for r in wl.classify(df).collect()}
    assert all(got[i] for i in range(20)) and not got[30] and not got[31]
    kept = wl.keep_good(df)
    assert kept.columns == df.columns and kept.count() == 20
    assert wl.classify(df.limit(0)).count() == 0
    long = spark.createDataFrame([(1, f"{clean} " * 40_000, "s", "h"), (2, clean, "s", "h")], schema)
    assert wl.classify(long).where("kept").count() == 2


def test_accuracies_against_labels_and_without_near_copies(spark):
    """Estimated accuracies agree with held-out labels; leaving out labellers that repeat others' shares changes next to nothing."""
    docs = spark.read.parquet(f"{LABELLED}/documents.parquet")
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet").select("doc_id", "quality")
    rows = docs.join(labels, "doc_id").select("text", "quality").collect()
    model, _ = wl.fit(docs)
    given = wl.votes(wl.words_of(*wl.flat(wl.pa.array([r["text"] for r in rows], wl.pa.large_string()))))
    good = np.array([r["quality"] == 1 for r in rows])
    for j, estimated in enumerate(model.label_model.accuracies()):
        voted = given[:, j] != wl.NONE
        assert abs(((given[:, j] == wl.GOOD) == good)[voted].mean() - estimated) < 0.04
    # one threshold of each share, without the union of three of them
    alone = given.copy()
    alone[:, [1, 3, 5, 8]] = wl.NONE
    codes, counts = np.unique(alone @ wl._PLACES, return_counts=True)
    ablated = wl.estimate(codes, counts.astype(float)).posterior(alone @ wl._PLACES) >= 0.5
    whole = model.label_model.posterior(given @ wl._PLACES) >= 0.5
    assert (ablated == whole).mean() > 0.98
    assert (whole == good).mean() >= (ablated == good).mean() - 0.005


def _features_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(5)
    return random.random((n, wl.TRIPLETS + wl.SHAPES), np.float32), random.random(n)


def test_fitting_takes_little_more_than_its_features():
    x, labels = _features_of(600)
    tracemalloc.start()
    wl.fit_scorer(x, labels, rounds=2)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < x.nbytes


def test_fit_task_reads_batches_of_any_cut():
    x, labels = _features_of(300)
    columns = [wl.pa.array([row.tobytes() for row in x], wl.pa.binary()), wl.pa.array(labels)]
    batch = wl.pa.RecordBatch.from_arrays(columns, ["x", "posterior"])
    parts = [batch.slice(0, 7), batch.slice(7, 0), batch.slice(7, 200), batch.slice(207)]
    (got,) = wl._fit_task(iter(parts))
    want = wl.fit_scorer(x, labels)
    assert got["weights"][0].as_py() == want.weights.tobytes() and got["bias"][0].as_py() == want.bias
    assert not list(wl._fit_task(iter([batch.slice(0, 0)])))
