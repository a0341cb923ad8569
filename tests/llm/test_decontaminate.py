"""Benchmark items planted in documents."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from basketry.llm import decontaminate as dc

SCHEMA = "doc_id long, text string, item_id string"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_longest_common():
    pick = random.Random(2)
    for _ in range(200):
        a, b = ([pick.randrange(6) for _ in range(pick.randrange(30))] for _ in "ab")
        assert dc.longest_common(np.array(a, np.int64), np.array(b, np.int64)) == lcs(a, b)


def corpus():
    pick = random.Random(9)
    words = ["".join(pick.choice("aeioulmnrst") for _ in range(pick.randrange(2, 9))) for _ in range(4000)]
    text = lambda n: [pick.choice(words[:30]) if pick.random() < 0.4 else pick.choice(words) for _ in range(n)]
    items = [text(n) for n in (15, 20, 36, 70, 150)]
    docs, held = {}, set()
    for i in range(300):
        docs[i] = text(pick.randrange(3, 400))
    for k, item in enumerate(items):
        for style in range(4):
            i = 1000 + 10 * k + style
            planted = list(item)
            if style == 1:  # in capitals, between other marks
                planted = [w.upper() + "!" for w in planted]
            elif style == 2:  # every eighth word replaced
                planted = [pick.choice(words) if n % 8 == 3 else w for n, w in enumerate(planted)]
            elif style == 3:  # words put in between
                planted = [w for n, x in enumerate(planted) for w in ([x, pick.choice(words)] if n % 6 == 2 else [x])]
            docs[i] = text(pick.randrange(5, 200)) + planted + text(pick.randrange(0, 90))
            held.add((i, k))
    return docs, items, held


def test_planted_items(spark):
    docs, items, held = corpus()
    rows = [(i, " ".join(w), "x") for i, w in docs.items()] + [(None, None, "x"), (3000, "", "x"), (3001, "…", "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(90, None), (91, ""), (None, "x y")], "item_id long, text string")
    found = dc.contaminated(df, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == held
    kept = dc.decontaminate(df, bench)
    assert kept.columns == df.columns and kept.count() == len(rows) - len({i for i, _ in held})
    assert dc.contaminated(df.limit(0), bench).count() == dc.contaminated(df, bench.limit(0)).count() == 0


def test_answers():
    assert dc._answer("what is it? forty two") == " forty two"
    assert dc._answer("q answer: yes") == " yes"
    assert dc._answer("no question") is None


def test_the_basis_spans_the_items(spark):
    """The randomised decomposition keeps every item's direction while the rank allows it."""
    items = corpus()[1]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    idf = np.ones(dc.BUCKETS, np.float32)
    passages = dc.item_passages(bench, spark.sparkContext.broadcast(idf))
    index, basis = dc.latent_basis(passages)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-4)
    for row in passages.collect():
        vector = np.zeros(len(index))
        vector[np.searchsorted(index, row["buckets"])] = row["weights"]
        assert np.linalg.norm(basis.T @ vector) > 0.99


def held_by(df, items, spark):
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in dc.contaminated(df, bench).collect()}


def test_thousands_of_items(spark):
    """A benchmark of many more passages than a space has directions: every copy is found."""
    pick = random.Random(12)
    words = [f"w{i}" for i in range(20_000)]
    text = lambda n: [pick.choice(words) for _ in range(n)]
    items = [text(38) for _ in range(3000)]
    docs = [(i, " ".join(text(pick.randrange(40)) + items[i] + text(20) + items[2999 - i] + text(9)), "x") for i in range(1500)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    assert held_by(df, items, spark) == {(i, k) for i in range(1500) for k in (i, 2999 - i)}


def test_an_item_that_many_documents_hold(spark):
    """Its own words are frequent then, next to rare words or in every document."""
    pick = random.Random(13)
    common, item = [f"c{i}" for i in range(16)], [f"i{i}" for i in range(16)]
    rare = iter(range(10**6))
    text = lambda n: [f"r{next(rare)}" for _ in range(n)]
    for share in (3, 1):
        docs = {i: text(pick.randrange(20, 60)) + (item if i % share == 0 else common) + text(50) for i in range(600)}
        df = spark.createDataFrame([(i, " ".join(w), "x") for i, w in docs.items()], SCHEMA).repartition(4)
        # the item's neighbours are words of the benchmark as well
        items = [item, *(docs[i][-30:] for i in range(0, 600, 3))]
        assert held_by(df, items, spark) == {(i, 0) for i in docs if i % share == 0} | {(3 * k, k + 1) for k in range(200)}
    alone = spark.createDataFrame([(1, " ".join(text(40) + item[:14] + text(40)), "x")], SCHEMA)
    assert held_by(alone, [item, common], spark) == {(1, 0)}
    assert dc.decontaminate(alone, spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")).count() == 0


def test_short_items(spark):
    """Items of a few words inside long texts of rarer words; their words far apart are no copy."""
    pick = random.Random(14)
    words = [f"w{i}" for i in range(60)]
    items = [[words.pop() for _ in range(n)] for n in (1, 2, 3, 3, 4, 5, 6, 7, 8, 9, 12)]
    rare = iter(range(10**6))
    text = lambda n: [f"r{next(rare)}" for _ in range(n)]
    docs = {100 * k + j: text(pick.randrange(90)) + item + text(pick.randrange(20, 200)) for k, item in enumerate(items) for j in range(20)}
    docs |= {5000 + k: [w for x in item for w in [x, *text(40)]] for k, item in enumerate(items) if len(item) > 1}
    docs |= {6000 + k: text(30) + items[2][:2] + text(30) for k in range(5)}
    df = spark.createDataFrame([(i, " ".join(w), "x") for i, w in docs.items()], SCHEMA).repartition(4)
    assert held_by(df, items, spark) == {(100 * k + j, k) for k in range(len(items)) for j in range(20)}


def test_items_without_an_id(spark):
    bench = spark.createDataFrame([(None, "one lost item of six words"), (None, "another one that has no id"), (4, "x")], "item_id long, text string")
    texts = ["so one lost item of six words and", "One lost item of six words. Another one that has no id.", "clean"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA)
    assert sorted((r["doc_id"], r["item_id"]) for r in dc.contaminated(df, bench).collect()) == [(0, None), (1, None), (1, None)]
    assert [r["doc_id"] for r in dc.decontaminate(df, bench).collect()] == [2]


def test_rounds(spark, monkeypatch):
    """A benchmark larger than what may pass the driver at a time is searched portion by portion."""
    docs, items, held = corpus()
    sizes, search = [], dc._search
    monkeypatch.setattr(dc, "BLOCK", 3)
    monkeypatch.setattr(dc, "ROUND_BYTES", 1)
    monkeypatch.setattr(dc, "_search", lambda rows, blocks, space: sizes.append(len(blocks)) or search(rows, blocks, space))
    df = spark.createDataFrame([(i, " ".join(w), "x") for i, w in docs.items()], SCHEMA).repartition(4)
    assert held_by(df, items, spark) == held
    assert len(sizes) > 2 and set(sizes) == {1}


def topics(n):
    """Words in two equal vocabularies that stand in like company: each document of a topic draws from both."""
    return [([f"t{k}a{i}" for i in range(30)], [f"t{k}b{i}" for i in range(30)], [f"t{k}c{i}" for i in range(40)]) for k in range(n)]


def test_paraphrases_by_words_in_like_company(spark, monkeypatch):
    """The rare words of an item replaced by others of its topic: too little is left for lexical overlap, not for the latent space."""
    pick = random.Random(15)
    common = [f"the{i}" for i in range(40)]
    subjects = topics(48)
    prose = lambda k, n: [pick.choice(common) if pick.random() < 0.5 else pick.choice(pick.choice(subjects[k])) for _ in range(n)]
    docs = {i: prose(i % 48, pick.randrange(60, 200)) for i in range(2400)}
    items, changed = [], []
    for k in range(12):
        words = [subjects[k][0][j] if j % 2 else common[(j * 7 + k) % 40] for j in range(30)]
        items.append(words)
        # every topic word becomes another of the topic, the common ones and the answer's stay
        changed.append([subjects[k][1][j] if j % 2 else w for j, w in enumerate(words)])
    answers = [[f"the{i}", f"the{i + 1}"] for i in range(12)]
    bench = spark.createDataFrame([(k, f"{' '.join(w)} answer: {' '.join(a)}") for k, (w, a) in enumerate(zip(items, answers))], "item_id long, text string")
    for k in range(12):
        docs[5000 + k] = prose((k + 5) % 48, 40) + changed[k] + answers[k] + prose((k + 5) % 48, 40)
    df = spark.createDataFrame([(i, " ".join(w), "x") for i, w in docs.items()], SCHEMA).repartition(4)
    whole = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(df, bench).collect()}
    planted = {(5000 + k, k) for k in range(12)}
    monkeypatch.setattr(dc, "LATENT", 2.0)  # the verbatim route alone
    lexical = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(df, bench).collect()}
    assert len(planted & lexical) <= 2 and len(planted & whole) >= 11
    assert not {d for d, _ in whole} & set(range(2400))


def test_the_space_is_that_of_the_whole_matrix(spark):
    """Sums over tasks give the leading singular vectors that one decomposition of the whole matrix gives."""
    pick = random.Random(16)
    subjects = topics(12)
    texts = [" ".join(pick.choice(pick.choice(subjects[k % 12])) for _ in range(25)) for k in range(500)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA).repartition(7)
    frequencies, n, passages = dc.survey(docs)
    assert n == 500 and frequencies.sum() == sum(len(set(t.split())) for t in texts)
    words = [np.array(r["words"]) for r in passages.collect()]
    assert len(words) == len(set(texts))
    idf = dc._weights(frequencies, n)
    space = dc.latent_space(passages.repartition(5), idf, 12)
    matrix = np.zeros((len(words), dc.BUCKETS))
    begins, rows, tokens, weights = dc._units(words, idf)
    np.add.at(matrix, (rows, tokens), weights)
    used = np.flatnonzero(matrix.any(axis=0))
    left, singular, right = np.linalg.svd(matrix[:, used], full_matrices=False)
    exact = left[:, :12] * np.sqrt(len(words))
    assert np.allclose(space.passages(np.concatenate(words), begins, np.array([len(w) for w in words])), space.windows(np.concatenate(words), np.array([len(w) for w in words])), atol=1e-5)
    found = np.array([space.rows[w].sum(axis=0) / np.sqrt((idf[w].astype(float) ** 2).sum()) for w in words])
    # the same subspace, and the same cosines in it
    assert np.linalg.svd(np.linalg.qr(exact)[0].T @ np.linalg.qr(found)[0])[1].min() > 0.95
    ours = space.passages(np.concatenate(words), begins, np.array([len(w) for w in words]))
    truth = exact - exact.mean(axis=0)
    truth /= np.linalg.norm(truth, axis=1, keepdims=True)
    assert np.abs(ours @ ours.T - truth @ truth.T).mean() < 0.05


def test_candidates_are_all_pairs_above_the_cosine(spark):
    """Recall of the latent search against brute force over all windows and passages."""
    docs, items, _ = corpus()
    df = spark.createDataFrame([(i, " ".join(w), "x") for i, w in docs.items()], SCHEMA)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    frequencies, n, passages = dc.survey(df)
    space = dc.latent_space(passages.unionByName(dc.benchmark_passages(bench)), dc._weights(frequencies, n))
    blocks = [b for part in dc._rounds(dc._blocks(bench, frequencies, n, space)) for b in part if b.size == dc.WINDOW]
    texts = pa.array([" ".join(w) for w in docs.values()])
    hashes, rows = dc._words(*dc.flat(texts))
    counts = np.bincount(rows, minlength=len(texts))
    first, length, of = dc._windows(counts, dc.WINDOW)
    first = first + (np.cumsum(counts) - counts)[of]
    semantic = space.windows(dc._bucket(hashes), counts)
    assert np.allclose(semantic, space.passages(dc._bucket(hashes), first, length), atol=1e-4)
    for block in blocks:
        block.prepare()
        at, item, cosine = dc._candidates((first, length), block, space, dc._bucket(hashes), semantic)
        brute = {(w, int(block.owner[p])) for w, p in zip(*np.nonzero(semantic @ block.semantic.T >= dc.LATENT))}
        assert brute and brute <= set(zip(at.tolist(), item.tolist()))
        assert np.allclose(cosine, [max((semantic[w] @ block.semantic[block.owner == i].T)) for w, i in zip(at, item)], atol=1e-5)


def test_the_space_is_fitted_on_every_passage_of_every_document(spark, monkeypatch):
    """Far more documents than any fixed number of them, long ones in several rows, copies counted: nothing is left out."""
    pick = random.Random(17)
    subjects = topics(6)
    prose = lambda k, n: [pick.choice(pick.choice(subjects[k])) for _ in range(n)]
    texts = [prose(k % 6, pick.choice((1, 15, 16, 17, 32, 33, 48, 49))) for k in range(6000)] + [prose(k, 5000 + k) for k in range(6)]
    texts += texts[:200]
    df = spark.createDataFrame([(i, " ".join(t), "x") for i, t in enumerate(texts)] + [(-1, None, "x"), (-2, "-", "x")], SCHEMA).repartition(5)
    frequencies, n, rows = dc.survey(df)
    words = [np.array(r["words"]) for r in rows.collect()]
    # a row's last half window is the first of the text's next row
    assert sum(map(len, words)) == sum(map(len, texts)) + 6 * 16
    windows = [dc._bucket(dc._words(*dc.flat(pa.array([" ".join(t[a : a + 32])])))[0]) for t in texts for a in range(0, max(1, len(t) - 16), 16)]
    idf = dc._weights(frequencies, n)
    _, of, tokens, weights = dc._units(windows, idf)
    used, column = np.unique(tokens, return_inverse=True)
    matrix = np.zeros((len(windows), len(used)), np.float32)
    np.add.at(matrix, (of, column), weights.astype(np.float32))
    factor = np.random.default_rng(5).normal(size=(dc.BUCKETS, 7)).astype(np.float32)
    monkeypatch.setattr(dc, "MULTIPLIED", 1000)
    found = dc._product(rows.repartition(3), idf, factor, 7)
    expected = np.column_stack([matrix.T @ (matrix @ factor[used]), matrix.sum(axis=0)])
    assert np.allclose(found[used], expected, rtol=1e-3, atol=1e-2) and not np.delete(found, used, axis=0).any()
    space = dc.latent_space(rows, idf, 6)
    at = np.cumsum([0, *map(len, windows)])
    ours = space.passages(np.concatenate(windows), at[:-1], np.diff(at))
    truth = np.linalg.svd(matrix, full_matrices=False)[0][:, :6] * np.sqrt(len(windows))
    truth -= truth.mean(axis=0)
    pairs = np.random.default_rng(6).integers(0, len(windows), (2, 4000))
    truth /= np.maximum(np.linalg.norm(truth, axis=1, keepdims=True), 0.5 * np.sqrt(6))
    assert np.abs((ours[pairs[0]] * ours[pairs[1]]).sum(axis=1) - (truth[pairs[0]] * truth[pairs[1]]).sum(axis=1)).mean() < 0.05


def test_the_space_is_fitted_on_every_passage_of_the_benchmark(spark):
    """Far more items than any fixed number of them, some long: each word that they alone hold is in the space."""
    items = [[f"q{k}w{i}" for i in range(1 + k % 40)] for k in range(5000)] + [[f"long{i}" for i in range(4500)]]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(-1, None), (-2, "?")], "item_id long, text string").repartition(3)
    rows = dc.benchmark_passages(bench)
    words = [r["words"] for r in rows.collect()]
    assert len(words) == 5002 and sum(map(len, words)) == sum(map(len, items)) + 16
    held = np.unique(dc._bucket(dc._words(*dc.flat(pa.array([" ".join(w) for w in items])))[0]))
    space = dc.latent_space(rows, np.ones(dc.BUCKETS, np.float32))
    assert (space.index == held).all()
    assert dc.benchmark_passages(bench.limit(0)).count() == 0


def test_sums_of_runs_of_any_length():
    pick = np.random.default_rng(18)
    table = pick.normal(size=(500, 5)).astype(np.float32)
    for longest, step in ((3, 16), (40, 16), (3000, 8)):
        lengths = pick.integers(1, longest + 1, 700)
        words, begins = pick.integers(0, 500, lengths.sum()), np.cumsum(lengths) - lengths
        assert np.allclose(dc._sums(table, words, begins, step), np.add.reduceat(table[words], begins), atol=1e-2)
    assert dc._sums(table, words[:0], begins[:0]).shape == (0, 5)


def test_bounds_of_groups_lose_no_pair(spark):
    """The verbatim route gives what all products of passages and windows give, for windows of each size."""
    pick = random.Random(19)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: [pick.choice(words[:40]) if pick.random() < 0.5 else pick.choice(words) for _ in range(n)]
    items = [text(n) for n in [2, 3, 4, 5, 7, 8, 9, 20, 33, 90] * 8]
    docs = [text(pick.randrange(0, 80)) + pick.choice(items)[pick.randrange(3) :] + text(pick.randrange(0, 40)) for _ in range(800)]
    df = spark.createDataFrame([(i, " ".join(w), "x") for i, w in enumerate(docs)], SCHEMA)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    frequencies, n, passages = dc.survey(df)
    idf = dc._weights(frequencies, n)
    space = dc.latent_space(passages, idf)
    hashes, rows = dc._words(*dc.flat(pa.array([" ".join(w) for w in docs])))
    counts, buckets = np.bincount(rows, minlength=len(docs)), dc._bucket(hashes)
    blocks = [b for part in dc._rounds(dc._blocks(bench, frequencies, n, space)) for b in part]
    assert {b.size for b in blocks} == {4, 8, 32}
    for block in blocks:
        block.prepare()
        first, length, of = dc._windows(counts, block.size)
        first = first + (np.cumsum(counts) - counts)[of]
        weights = np.zeros((len(first), dc.BUCKETS), np.float32)
        np.add.at(weights, (np.repeat(np.arange(len(first)), length), buckets[dc.ragged(first, length)]), 1)
        shares = (weights[:, block.index] * idf[block.index]) @ (block.basis @ block.latent.T) * block.scale
        sure = {(w, int(block.owner[p])) for w, p in zip(*np.nonzero(shares >= dc.COSINE**2 + 1e-4))}
        maybe = {(w, int(block.owner[p])) for w, p in zip(*np.nonzero(shares >= dc.COSINE**2 - 1e-4))}
        found = set(zip(*(x.tolist() for x in dc._near(block, buckets, first, length))))
        assert sure and sure <= found <= maybe


def test_words_are_written_as_bytes_and_sums_reach_the_driver_in_parts(spark, monkeypatch):
    texts = [" ".join(f"w{i * k}" for i in range(k)) for k in range(60)] + [None, "", "a " * 5000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    _, _, written = dc._survey(df)
    assert written.dtypes == [("words", "binary")]
    packed = [np.frombuffer(r["words"], np.uint8).reshape(-1, dc.BYTES) for r in written.collect()]
    found = sorted((x @ (1 << np.arange(0, 24, 8))).tolist() for x in packed)
    assert found == sorted(r["words"] for r in dc.survey(df)[2].collect())
    assert sum(map(len, found)) == sum(len((t or "").split()) for t in texts) + 16
    whole = []
    monkeypatch.setattr(type(df), "toArrow", lambda self: whole.append(self))
    assert dc._product(written, np.ones(dc.BUCKETS, np.float32), None, 4).any() and not whole


def test_a_product_holds_its_factor_once(monkeypatch):
    idf = np.linspace(0.1, 9, dc.BUCKETS, dtype=np.float32)
    tracemalloc.start()
    weighted = dc._weighted(idf, None, 8)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1.5 * weighted.nbytes
    assert (weighted[:, :-1] == dc._signs(8) * idf[:, None]).all() and (weighted[:, -1] == idf**2).all()
    assert (dc._weighted(idf, dc._signs(8), 8) == weighted).all()
    words, counts = np.random.default_rng(4).integers(0, 500, 3000), np.array([40, 0, 2000, 960])
    found = []
    for added in (dc.ADDED, 7):
        monkeypatch.setattr(dc, "ADDED", added)
        sums = np.ones_like(weighted)
        dc._add_product(sums, words, counts, weighted)
        found.append(sums)
    assert (found[0] == found[1]).all() and (found[0] != 1).any()
