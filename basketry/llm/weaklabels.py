"""Quality classifier from weak labels: overlapping heuristics, their accuracies by EM, a hashed linear scorer.

*Labellers.* Ten heuristics vote good, bad or nothing on every document, from shares of its words: written in capitals,
carrying symbols, repeating the word before, listed as function words, ending in symbols, holding digits, and so on.
*Label model.* Votes are taken as independent given the class. EM over the counts of all vote patterns (at most 3^10,
however many documents) estimates each labeller's rates and the share of good documents; it starts from the majority.
A pattern's posterior is the label of its documents. *Scorer.* A logistic model on hashed byte triplets and word
shapes is fitted to the posteriors of at most ``FIT_ROWS`` distinct documents, half of them from either side, chosen by the
hash of their texts; it then scores every whole text. Documents that score under one half are rejected.

A text without words (or null) has no features: its score is 0 and it is rejected. Repeated rows score alike, the id is not
used, further columns pass through, and an empty table gives an empty result. If all documents fall on one side, the
posterior's majority decides for all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm._columns import packed
from basketry.llm._text import chunks, flat, give_back, word_bounds, word_hashes
from basketry.session import materialize

#: most rows that the scorer is fitted on
FIT_ROWS = 4000
TRIPLETS, SHAPES = 4096, 64
#: bytes of text that are looked at together, and rows of features that are widened together
AT_ONCE, ROWS = 1 << 18, 128
GOOD, BAD, NONE = 1, 0, 2

#: fixed values: frequent function words of the four languages
FUNCTION_WORDS = (
    "the of and to in a is that it for on with as was are be this by or from at an "
    "der die das und ist von zu mit den im für auf des ein eine dem nicht sich auch "
    "le la les de des et un une est que qui dans pour sur par pas au plus avec "
    "el los las del y en se con por no su al es una lo"
).split()

_UPPER, _LOW, _SYMBOL, _DIGIT = (np.zeros(256, np.uint8) for _ in range(4))
_UPPER[65:91] = 1
_LOW[97:123] = 1
_LOW[128:] = 1
_DIGIT[48:58] = 1
_SYMBOL[[ord(c) for c in "#$%&*!|^~<>{}[]\\"]] = 1


def _hash_words(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    ends = np.cumsum([len(d) for d in data])
    starts = ends - [len(d) for d in data]
    return np.sort(word_hashes(np.frombuffer(b"".join(data), np.uint8), starts, ends))


_FUNCTION_HASHES = _hash_words(sorted(set(FUNCTION_WORDS)))


@dataclass
class Words:
    """The words of a batch of texts, each with what the labellers and the scorer look at."""

    rows: np.ndarray
    counts: np.ndarray
    length: np.ndarray
    capitals: np.ndarray
    symbol: np.ndarray
    digit: np.ndarray
    lower: np.ndarray
    repeated: np.ndarray
    function: np.ndarray

    def share(self, flags: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, flags, len(self.counts)) / np.maximum(1, self.counts)


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends, rows = word_bounds(data, offsets)
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n)
    if not len(starts):
        none = np.zeros(0)
        return Words(rows, counts, *[none] * 7)

    def inside(table: np.ndarray) -> np.ndarray:
        # words are apart by bytes of no class, so sums from start to start are sums over words
        return np.add.reduceat(table[data], starts, dtype=np.int64)

    hashes = word_hashes(data, starts, ends)
    repeated = np.zeros(len(starts), bool)
    repeated[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    upper, lower = inside(_UPPER), inside(_LOW)
    at = np.minimum(np.searchsorted(_FUNCTION_HASHES, hashes), len(_FUNCTION_HASHES) - 1)
    return Words(
        rows,
        counts,
        ends - starts,
        (upper >= 2) & (lower * 4 <= upper),
        inside(_SYMBOL) > 0,
        inside(_DIGIT) > 0,
        lower > 0,
        repeated,
        _FUNCTION_HASHES[at] == hashes,
    )


def _vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, NONE))


def votes(words: Words) -> np.ndarray:
    """One column for each labeller; texts of under ten words are judged by what they hold, not by what they lack."""
    long = words.counts >= 10
    capitals, symbols = words.share(words.capitals), words.share(words.symbol)
    repeats, function = words.share(words.repeated), words.share(words.function)
    plain = words.share(words.lower & ~words.symbol)
    noise = words.share(words.capitals | words.symbol | words.repeated)
    length = words.share(words.length)
    some = words.counts > 0
    return np.stack(
        [
            _vote(capitals > 0.2, capitals < 0.05),
            _vote(capitals > 0.08, some & (capitals < 0.01)),
            _vote(symbols > 0.15, symbols < 0.03),
            _vote(symbols > 0.06, some & (symbols < 0.01)),
            _vote(repeats > 0.3, repeats < 0.1),
            _vote(repeats > 0.15, some & (repeats < 0.05)),
            _vote(long & (function < 0.04), long & (function > 0.12)),
            _vote(some & (plain < 0.7), plain > 0.93),
            _vote(some & (noise > 0.2), some & (noise < 0.08)),
            _vote(long & ((length > 14) | (length < 2.5)), long & (length > 3.5) & (length < 11)),
        ],
        axis=1,
    )


LABELLERS = 10
_PLACES = 3 ** np.arange(LABELLERS)


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        found = [np.zeros(0, np.int64)]
        for lo, hi in chunks(offsets, AT_ONCE):
            at = offsets[lo : hi + 1]
            found.append(votes(words_of(data[at[0] : at[-1]], at - at[0])) @ _PLACES)
        yield pa.RecordBatch.from_arrays([batch.column("hash"), pa.array(np.concatenate(found), pa.int32())], ["hash", "pattern"])
    give_back()


@dataclass
class LabelModel:
    """``rates[labeller, class, vote]`` and the share of good documents."""

    rates: np.ndarray
    good: float

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        given = (patterns[:, None] // _PLACES) % 3
        which = np.arange(LABELLERS)
        odds = np.log(self.good) - np.log1p(-self.good) + np.zeros(len(patterns))
        odds += (np.log(self.rates[which, GOOD, given]) - np.log(self.rates[which, BAD, given])).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))

    def accuracies(self) -> np.ndarray:
        """Per labeller: how often a vote is right, if it votes."""
        right = self.rates[:, GOOD, GOOD] * self.good + self.rates[:, BAD, BAD] * (1 - self.good)
        wrong = self.rates[:, GOOD, BAD] * self.good + self.rates[:, BAD, GOOD] * (1 - self.good)
        return right / np.maximum(right + wrong, 1e-12)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """EM over pattern counts; a pseudo-count of one keeps every rate above 0."""
    given = (patterns[:, None] // _PLACES) % 3
    against, total = (given == BAD).sum(axis=1), counts.sum()
    posterior = np.where(against >= 2, 0.1, 0.9)
    for _ in range(rounds):
        rates = np.empty((LABELLERS, 2, 3))
        for c, weight in ((GOOD, posterior), (BAD, 1 - posterior)):
            for v in range(3):
                rates[:, c, v] = ((given == v) * (weight * counts)[:, None]).sum(axis=0) + 1
        rates /= rates.sum(axis=2, keepdims=True)
        model = LabelModel(rates, float(np.clip((posterior * counts).sum() / total, 0.01, 0.99)))
        posterior, before = model.posterior(patterns), posterior
        if np.abs(posterior - before).max() < 1e-6:
            break
    return model


def _hashed(data: np.ndarray, offsets: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of each byte triplet that lies in one text, and the shape of each word."""
    part = data.astype(np.uint32)
    n = max(0, len(part) - 2)
    key = (part[:n] | part[1 : n + 1] << np.uint32(8) | part[2 : n + 2] << np.uint32(16)) * np.uint32(0x9E3779B1)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    within = rows[:n] == rows[2 : n + 2]
    shape = (
        words.capitals * 1 + words.symbol * 2 + words.digit * 4 + words.repeated * 8 + words.function * 16 + words.lower * 32
    ).astype(np.int64)
    return (key >> np.uint32(20)).astype(np.int64)[within], rows[:n][within], shape


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        for lo, hi in chunks(offsets, AT_ONCE):
            at = offsets[lo : hi + 1]
            part, n = data[at[0] : at[-1]], hi - lo
            words = words_of(part, at - at[0])
            triplets, rows, shape = _hashed(part, at - at[0], words)
            wide = TRIPLETS + SHAPES
            x = np.bincount(rows * wide + triplets, minlength=n * wide)
            x += np.bincount(words.rows * wide + TRIPLETS + shape, minlength=n * wide)
            x = x.reshape(n, wide).astype(np.float32)
            x[:, :TRIPLETS] /= np.maximum(1, x[:, :TRIPLETS].sum(axis=1, keepdims=True))
            x[:, TRIPLETS:] /= np.maximum(1, x[:, TRIPLETS:].sum(axis=1, keepdims=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("hash").slice(lo, n), pa.array([row.tobytes() for row in x], pa.binary())], ["hash", "x"]
            )
    give_back()


@dataclass
class Scorer:
    """Weights of the buckets and a bias."""

    weights: np.ndarray
    bias: float

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The chance that each text is good; 0 without words."""
        words = words_of(data, offsets)
        triplets, rows, shape = _hashed(data, offsets, words)
        n = len(offsets) - 1
        score = np.bincount(rows, self.weights[triplets], n) / np.maximum(1, np.bincount(rows, minlength=n))
        score += words.share(self.weights[TRIPLETS + shape])
        return np.where(words.counts > 0, 1 / (1 + np.exp(-np.clip(score + self.bias, -50, 50))), 0.0)


def fit_scorer(x: np.ndarray, labels: np.ndarray, rounds: int = 300, decay: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels by accelerated gradient steps, on features of about equal variance.

    ``x`` is scaled in place, and only a few of its rows at a time are widened: it may be most of a task's memory.
    """
    scale = 1 / np.sqrt(x.mean(axis=0) + 1e-4).astype(np.float32)
    x *= scale
    cuts = [slice(lo, lo + ROWS) for lo in range(0, len(x), ROWS)]
    step = 4 / (np.concatenate([np.square(x[cut]).sum(axis=1) for cut in cuts]).mean() + 1)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    v, c = w, b
    for k in range(rounds):
        miss = 1 / (1 + np.exp(-np.clip(x @ v + c, -50, 50))) - labels
        total = sum(miss[cut] @ x[cut] for cut in cuts)
        w_next = v - step * (total / len(x) + decay * v).astype(np.float32)
        b_next = c - step * float(miss.mean())
        momentum = k / (k + 3)
        v, c = w_next + momentum * (w_next - w), b_next + momentum * (b_next - b)
        w, b = w_next, b_next
    return Scorer((w * scale).astype(np.float64), float(b))


@dataclass
class QualityModel:
    label_model: LabelModel | None
    scorer: Scorer

    def score(self, text: str = "text") -> Column:
        """The chance of being good for each text of a column."""
        scorer = self.scorer

        @F.arrow_udf("double")
        def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                data, offsets = flat(batch)
                parts = [np.zeros(0)]
                for lo, hi in chunks(offsets, AT_ONCE):
                    at = offsets[lo : hi + 1]
                    parts.append(scorer.probabilities(data[at[0] : at[-1]], at - at[0]))
                yield pa.array(np.concatenate(parts))
            give_back()

        return scores(F.col(text))


def fit(documents: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[QualityModel, DataFrame]:
    """Model of ``documents`` (``text``) and the vote pattern of each text (``hash``, ``pattern``)."""
    spark = documents.sparkSession
    texts = documents.select(F.xxhash64("text").alias("hash"), "text")
    patterns = materialize(texts.mapInArrow(_patterns, "hash long, pattern int"))
    counted = patterns.groupBy("pattern").count().toPandas()  # at most 3 ** LABELLERS rows
    if counted.empty:
        return QualityModel(None, Scorer(np.zeros(TRIPLETS + SHAPES), 0.0)), patterns
    counted = counted.sort_values("pattern")
    codes, counts = counted["pattern"].to_numpy(np.int64), counted["count"].to_numpy(np.float64)
    model = estimate(codes, counts)
    posterior = model.posterior(codes)
    table = spark.createDataFrame([(int(c), float(p)) for c, p in zip(codes, posterior, strict=True)], "pattern int, posterior double")
    labelled = patterns.join(F.broadcast(table), "pattern").select("hash", "posterior").distinct()
    mixed = F.xxhash64(F.col("hash"), F.lit(11))
    sides = [labelled.where(side).orderBy(mixed, "hash").limit(fit_rows // 2) for side in ("posterior < 0.5", "posterior >= 0.5")]
    sample = materialize(sides[0].unionByName(sides[1]))
    chosen = texts.join(F.broadcast(sample.select("hash")), "hash", "left_semi").dropDuplicates(["hash"])
    rows = chosen.mapInArrow(_features, "hash long, x binary").join(F.broadcast(sample), "hash")
    # at most fit_rows rows meet in one task; only the weights come to the driver
    ordered = rows.repartition(1).sortWithinPartitions("hash")
    fitted = ordered.mapInArrow(_fit_task, "weights binary, bias double").first()
    return QualityModel(model, Scorer(np.frombuffer(fitted["weights"], np.float64), fitted["bias"])), patterns


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of features in a column, without a copy."""
    column = column.cast(pa.large_binary())
    begin = int(np.frombuffer(column.buffers()[1], np.int64)[column.offset]) if len(column) else 0
    values = np.frombuffer(column.buffers()[2] or b"", np.uint8)[begin:].view(np.float32)
    return values[: len(column) * (TRIPLETS + SHAPES)].reshape(len(column), TRIPLETS + SHAPES)


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, labels = [], []
    for batch in batches:
        parts.append(_matrix(batch.column("x")))
        labels.append(batch.column("posterior").to_numpy())
    if not parts:
        return
    labels, x = np.concatenate(labels), np.concatenate(parts)
    parts = batch = None
    if not len(labels):
        return
    if (labels < 0.5).all() or (labels >= 0.5).all():
        scorer = Scorer(np.zeros(TRIPLETS + SHAPES), 1.0 if labels[0] >= 0.5 else -1.0)
    else:
        scorer = fit_scorer(x, labels)
    yield pa.RecordBatch.from_pydict({"weights": [scorer.weights.tobytes()], "bias": [scorer.bias]})
    del x
    give_back()


def keep_good(documents: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``documents`` that the classifier fitted on them does not reject."""
    model, _ = fit(documents, fit_rows)
    return packed(documents, score=model.score()).where("score >= 0.5").select("row.*")


def classify(documents: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, score, kept`` of every document."""
    model, _ = fit(documents, fit_rows)
    scored = documents.select("doc_id", model.score().alias("score"))
    return scored.withColumn("kept", F.col("score") >= 0.5)
