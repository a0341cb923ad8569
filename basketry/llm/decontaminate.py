"""Benchmark decontamination: latent semantic retrieval, then longest common subsequence and answer checks.

*Passages.* Lower-cased texts are words (letters, digits, bytes above 127; all else separates), cut into windows of
32 words that start every 16. A passage is a TF-IDF vector over ``BUCKETS`` hashed words; document frequencies are counted
over all documents, and no weight is below ``FLOOR``, so an item that many or all documents hold keeps a length.

*Latent space.* A randomised SVD of passages of documents and benchmark, distributed: a random projection and a power step are
matrix products AᵀA·X that tasks compute over their passages and Spark sums by word; orthonormalisation and the decomposition
of the small product matrix follow on sums of a fixed size. It is fitted on every passage of every document, copies counted as in the
document frequencies, and on every passage of the benchmark; its rank ``LATENT_RANK`` is far below their number, so words that
stand in like company fall together. Coordinates are centred and divided by the singular values. Every passage of every
document is projected and held against every passage of the benchmark: a pair is a candidate from a cosine of ``LATENT``. The search
tries all pairs, so its recall against brute force is 1.

*Verbatim route.* Copies must not depend on a space of low rank, so beside it a passage is a candidate if it holds a share of
``COSINE`` squared of the item's length on the item's own words; for items of at most 8 or 4 words in windows of 8 or 4 words that start
every 4 or 2. The benchmark's passages are dealt into blocks of ``BLOCK`` with a basis each that holds them
whole, the documents are searched in rounds of ``ROUND_BYTES`` of blocks, and the largest shares that each word can add to any of
``TOGETHER`` of their passages bound a document's passage before, without loss. Item words that no document holds are left out of the item's length.

*Checks.* A candidate of either route is confirmed on the words around the passage, unless too few of them are the item's in any
order: the longest common subsequence reaches ``LCS`` of the item, or reaches ``PARAPHRASE`` of it and the answer check
holds: most words of the answer occur there. The answer is what follows "answer:" or the last question mark, else the
item's rarest words. Items of fewer than ``LEAST`` words need the subsequence. The cosine that is returned is the latent one.

Null or wordless texts match nothing; items without words are ignored; equal items are matched each. An
item without an id is matched like any other, under a null. Rows that share an id are told
apart by their texts' hash. Empty tables give empty results. Columns other than id and text pass through or are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from basketry.llm import _text
from basketry.llm._columns import packed
from basketry.llm._text import chunks, flat, give_back, mix, ragged, word_hashes
from basketry.session import discard, materialize

WINDOW = 32
#: windows for items of at most so many words
SHORT = (4, 8)
#: an item of fewer words must be held by the longest common subsequence alone: two of three words are no paraphrase
LEAST = 4
#: hashed words, and bytes of a written one
BUCKETS, BYTES = 1 << 18, 3
RANK = 256
#: passages that share a space; fewer than its directions, so that it holds them whole
BLOCK = RANK - 32
#: passages of a block that share a bound
TOGETHER = 8
#: bytes of blocks that pass the driver and are held against the documents at a time
ROUND_BYTES = 64 << 20
COSINE = 0.35
#: least weight of a word
FLOOR = 0.1
LCS, PARAPHRASE, ANSWER = 0.7, 0.45, 0.6

#: dimensions of the latent space, and least cosine of a candidate
LATENT_RANK = 32
LATENT = 0.6
#: further directions of the random projection
OVERSAMPLE = 16
#: half windows; passages in a row of the written words, and words for each task that multiplies them
HALF = WINDOW // 2
PIECE = 255
PORTION = 1 << 24
#: words that are multiplied at a time, words whose passages are, half windows whose rows are summed at a time, buckets whose sums travel in one row
MULTIPLIED, FORWARD, SUMMED, RANGE = 1 << 20, 1 << 14, 256, 1024
#: words whose sums are added at a time
ADDED = 1 << 14

_PAIRS = StructType(
    [StructField(c, LongType()) for c in ("doc_id", "row_hash", "item_id", "key")]
    + [StructField(c, DoubleType()) for c in ("cosine", "common", "answer")]
)
_OUTSIDE = np.ones(256, bool)
_OUTSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word."""
    starts, ends, rows = _text.word_bounds(data, offsets, _OUTSIDE)
    return word_hashes(data, starts, ends), rows


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(46)).astype(np.int64)


def survey(documents: DataFrame) -> tuple[np.ndarray, int, DataFrame]:
    """One scan: of each bucket the number of documents that hold it, the number of documents, and the words of all (:func:`_pieces`)."""
    frequencies, n, words = _survey(documents)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = _unpacked(batch.column("words"))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))], ["words"])

    return frequencies, n, words.mapInArrow(unpack, "words array<int>")


def _survey(documents: DataFrame) -> tuple[np.ndarray, int, DataFrame]:
    """:func:`survey`, with the words as bytes (:func:`_packed`), which Spark copies at once and not one by one."""
    n = documents.count()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            for lo, hi in chunks(offsets):
                at = offsets[lo : hi + 1]
                hashes, rows = _words(data[at[0] : at[-1]], at - at[0])
                buckets = _bucket(hashes)
                held = np.sort(rows * BUCKETS + buckets)
                once = held[np.append(True, held[1:] != held[:-1])[: len(held)]]
                totals += np.bincount(once % BUCKETS, minlength=BUCKETS)
                words = _packed(_pieces(buckets, np.bincount(rows, minlength=hi - lo)))
                none = pa.nulls(len(words), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, words], ["bucket", "n", "words"])
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(totals[some]), pa.nulls(len(some), pa.binary())], ["bucket", "n", "words"]
        )
        give_back()

    found = materialize(documents.select(F.lower("text").alias("text")).mapInArrow(count, "bucket long, n long, words binary"))
    counted = found.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS rows
    out = np.zeros(BUCKETS, np.int64)
    out[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    return out, n, found.where("words IS NOT NULL").select("words")


def _pieces(buckets: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Words of texts with so many of them, a text in rows of at most ``PIECE`` passages; a row's last half window begins the next."""
    halves = -(-counts // HALF)
    n = np.where(counts > 0, np.maximum(1, -(-(halves - 1) // PIECE)), 0)
    rows = np.repeat(np.arange(len(counts)), n)
    first = ragged(np.zeros(len(n), np.int64), n) * (PIECE * HALF)
    length = np.minimum((PIECE + 1) * HALF, counts[rows] - first)
    words = buckets[ragged((np.cumsum(counts) - counts)[rows] + first, length)]
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(words, pa.int32()))


def _packed(words: pa.Array) -> pa.Array:
    """Lists of words as bytes, ``BYTES`` for each."""
    values, offsets = _unpacked(words)
    data = values.astype("<i4", copy=False).view(np.uint8).reshape(-1, 4)[:, :BYTES].tobytes()
    return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets * BYTES), pa.py_buffer(data)]).cast(pa.binary())


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All words of a column of lists or of their bytes, and where each row begins and ends."""
    if pa.types.is_list(column.type):
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        return column.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    values = np.zeros(((offsets[-1] - offsets[0]) // BYTES, 4), np.uint8)
    if len(values):
        values[:, :BYTES] = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(-1, BYTES)
    return values.view("<i4").ravel(), (offsets - offsets[0]) // BYTES


def _halves(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and row of each half window, and the half windows that begin a window.

    A window is a half and the next of its text, if there is one; the last half of several begins none.
    """
    n = -(-counts // HALF)
    rows = np.repeat(np.arange(len(counts)), n)
    number = ragged(np.zeros(len(n), np.int64), n)
    return (np.cumsum(counts) - counts)[rows] + number * HALF, rows, np.flatnonzero((number == 0) | (number < n[rows] - 1))


def _added(table: np.ndarray, words: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``table`` for ``counts`` words each from ``first``; counts descend.

    The k-th words of some runs are added as whole rows, for few runs at a time, so that they stay in the cache.
    """
    out = np.empty((len(first), table.shape[1]), table.dtype)
    taken = np.empty((SUMMED, table.shape[1]), table.dtype)
    for lo in range(0, len(first), SUMMED):
        into, begin, many = out[lo : lo + SUMMED], first[lo : lo + SUMMED], counts[lo : lo + SUMMED]
        np.take(table, words[begin], axis=0, out=into, mode="clip")
        have = len(begin)
        for k in range(1, int(many[0])):
            while many[have - 1] <= k:
                have -= 1
            into[:have] += np.take(table, words[begin[:have] + k], axis=0, out=taken[:have], mode="clip")
    return out


def _sums(table: np.ndarray, words: np.ndarray, begins: np.ndarray, step: int = HALF) -> np.ndarray:
    """Sums of the rows of ``table`` for the words from each of ``begins`` to the next: of whole pieces of ``step`` words and of what is left."""
    words = words.astype(np.int64, copy=False)
    whole, left = np.divmod(np.diff(np.append(begins, len(words))), step)
    out = np.zeros((len(begins), table.shape[1]), table.dtype)
    runs = np.flatnonzero(left)
    runs = runs[np.argsort(-left[runs].astype(np.int8), kind="stable")]
    out[runs] = _added(table, words, (begins + whole * step)[runs], left[runs])
    runs = np.flatnonzero(whole)
    number = whole[runs]
    first = np.repeat(begins[runs], number) + ragged(np.zeros(len(runs), np.int64), number) * step
    pieces = _added(table, words, first, np.full(len(first), step))
    if len(first) > len(runs):
        pieces = _sums(pieces, np.arange(len(first)), np.cumsum(number) - number, step)
    out[runs] += pieces
    return out


def _units(words: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Passages of some words as rows of unit length: where each begins, its number at every word, buckets, weights."""
    counts = np.array([len(w) for w in words], np.int64)
    tokens = np.concatenate([*words, np.zeros(0, np.int64)]).astype(np.int64)
    rows, begins = np.repeat(np.arange(len(words)), counts), np.cumsum(counts) - counts
    weights = idf[tokens].astype(np.float64)
    return begins, rows, tokens, weights / np.sqrt(np.bincount(rows, weights**2, len(words)))[rows]


def _signs(width: int, out: np.ndarray | None = None) -> np.ndarray:
    """Random projection, a row for each bucket: signs from a hash, the same in every run and task."""
    columns, out = mix(np.arange(width, dtype=np.uint64)), np.empty((BUCKETS, width), np.float32) if out is None else out
    for lo in range(0, BUCKETS, RANGE):
        seeds = mix(np.arange(lo, lo + RANGE, dtype=np.uint64)[:, None] ^ columns)
        out[lo : lo + RANGE] = np.where(seeds & np.uint64(1), 1, -1)
    return out


def _weighted(idf: np.ndarray, factor: np.ndarray | None, width: int) -> np.ndarray:
    """``factor``, or the random projection, times the weights and, last, the weights' squares."""
    out = np.empty((BUCKETS, width + 1), np.float32)
    if factor is None:
        _signs(width, out[:, :-1])
    else:
        out[:, :-1] = factor
    out[:, :-1] *= idf[:, None]
    out[:, -1] = idf**2
    return out


def _forward(words: np.ndarray, counts: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """For each half window of texts with so many words the sum of its passages' rows of A·X, and of A's 1, each by the passage's length.

    ``factor``: X times the weights and, last, the weights' squares.
    """
    first, rows, begins = _halves(counts)
    halves = _sums(factor, words, first)
    two = np.append(rows, -1)[begins + 1] == rows[begins]
    windows = halves[begins]
    windows[two] += halves[begins[two] + 1]
    # a passage has length 1: its product is divided by its squared length, and Aᵀ·1 by its length
    lengths = windows[:, -1:].copy()
    windows /= lengths
    windows[:, -1:] = 1 / np.sqrt(lengths)
    halves[:] = 0
    halves[begins] = windows
    halves[begins[two] + 1] += windows[two]
    return halves


def _add_product(sums: np.ndarray, words: np.ndarray, counts: np.ndarray, factor: np.ndarray) -> None:
    """Add to ``sums`` what the passages of texts with so many words contribute to AᵀA·X and Aᵀ·1, short of the weight of the row's word."""
    ends = np.append(0, np.cumsum(counts))
    back = np.concatenate([_forward(words[ends[lo] : ends[hi]], counts[lo:hi], factor) for lo, hi in chunks(ends, FORWARD)])
    first = _halves(counts)[0]
    # by word: a sum for each, added once
    order = np.sort(words.astype(np.int64) << 32 | np.repeat(np.arange(len(first)), np.diff(np.append(first, len(words)))))
    sorted_words = order >> 32
    starts = np.flatnonzero(np.append(True, sorted_words[1:] != sorted_words[:-1]))
    which, order = sorted_words[starts], order & 0xFFFFFFFF
    del sorted_words
    found = _sums(back, order, starts, HALF // 2)
    for lo in range(0, len(which), ADDED):
        sums[which[lo : lo + ADDED]] += found[lo : lo + ADDED]


def _product(passages: DataFrame, idf: np.ndarray, factor: np.ndarray | None, width: int, tasks: int = 1) -> np.ndarray:
    """For each bucket its row of AᵀA·X and, last, of Aᵀ·1; X: ``factor``, or the random projection.

    ``tasks`` multiply their passages and Spark brings together the sums of each range of buckets, in as many tasks while there are
    as many ranges: the result has a fixed size.
    """
    # a given factor travels with its weights, so that a task holds it once
    shared = passages.sparkSession.sparkContext.broadcast((idf, None if factor is None else _weighted(idf, factor, width)))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, weighted = shared.value
        if weighted is None:
            weighted = _weighted(idf, None, width)
        sums = np.zeros((BUCKETS, width + 1), np.float32)
        for batch in batches:
            values, offsets = _unpacked(batch.column("words"))
            for lo, hi in chunks(offsets, MULTIPLIED):
                _add_product(sums, values[offsets[lo] : offsets[hi]], np.diff(offsets[lo : hi + 1]), weighted)
        sums *= idf[:, None]
        for lo in range(0, BUCKETS, RANGE):
            part = sums[lo : lo + RANGE]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([part.tobytes()], pa.binary())], ["first", "sums"])
        del weighted, sums, part
        give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for first, sums in zip(batch.column("first").to_pylist(), batch.column("sums"), strict=True):
                part = np.frombuffer(sums.as_buffer(), np.float32).astype(np.float64)
                totals[first] = totals[first] + part if first in totals else part
        for first, sums in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([sums.astype(np.float32).tobytes()], pa.binary())], ["first", "sums"])
        totals.clear()
        give_back()

    schema = "first long, sums binary"
    table = materialize(passages.mapInArrow(multiply, schema).repartition(min(BUCKETS // RANGE, max(8, tasks)), "first").mapInArrow(add, schema))
    shared.destroy()
    out = np.zeros((BUCKETS, width + 1), np.float32)
    # file by file: the driver holds the result once, not also in its Java heap and as a table
    for first, sums in table.toLocalIterator():
        out[first : first + RANGE] = np.frombuffer(sums, np.float32).reshape(-1, width + 1)
    discard(table)
    return out


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` in double precision, some rows at a time."""
    return sum(a[lo : lo + 8192].T.astype(np.float64) @ b[lo : lo + 8192].astype(np.float64) for lo in range(0, len(a), 8192))


class Space:
    """What each word adds to a passage's coordinates (its weight included), and the ``mean`` of the fitted passages.

    It travels as the rows of the words that it knows, at most ``BUCKETS``, and is spread out where it is used.
    """

    def __init__(self, index: np.ndarray, rows: np.ndarray, mean: np.ndarray, idf: np.ndarray, least: float = LATENT) -> None:
        self.__setstate__((index, rows.astype(np.float32), mean, idf, least))

    def __getstate__(self) -> tuple:
        return self.index, self.rows[self.index], self.mean, self.idf, self.least

    def __setstate__(self, state: tuple) -> None:
        #: buckets of known words; least cosine of a candidate
        self.index, rows, self.mean, self.idf, self.least = state
        # with each word's squared weight, and once more if it is known
        self.wide = np.zeros((BUCKETS, rows.shape[1] + 2), np.float32)
        self.rows = self.wide[:, :-2]
        self.rows[self.index] = rows
        self.wide[:, -2] = self.idf.astype(np.float32) ** 2
        self.wide[self.index, -1] = self.wide[self.index, -2] * rows.any(axis=1)

    def passages(self, buckets: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Coordinates of passages of at least one word, by first word and number of words."""
        if not len(first):
            return np.zeros((0, self.rows.shape[1]), np.float32)
        return self._placed(_sums(self.wide, buckets[ragged(first, length)], np.cumsum(length) - length))

    def windows(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Coordinates of all windows of ``WINDOW`` words, each two half windows of words that are read once."""
        first, rows, begins = _halves(counts)
        sums = np.concatenate([_sums(self.wide, buckets, first), np.zeros((1, self.wide.shape[1]), np.float32)])
        following = np.where(np.append(rows, -1)[begins + 1] == rows[begins], begins + 1, len(rows))
        return self._placed(sums[begins] + sums[following])

    def _placed(self, sums: np.ndarray) -> np.ndarray:
        """Vectors of unit length unless too little of the passage is known.

        The fitted passages have a length of about the root of the rank; a vector under half of that, which one or two known
        words may make, keeps its share of it and so a lower cosine.
        """
        every = np.maximum(sums[:, -2], 1e-9)
        out = sums[:, :-2] / np.sqrt(every)[:, None] - self.mean.astype(np.float32) * (sums[:, -1] / every)[:, None]
        usual = 0.5 * np.sqrt(self.rows.shape[1])
        return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), usual)).astype(np.float32)


def latent_space(passages: DataFrame, idf: np.ndarray, rank: int = LATENT_RANK) -> Space:
    """Randomised SVD of the TF-IDF matrix A of all passages of ``words`` (:func:`_pieces`), by distributed products with AᵀA."""
    size = F.size("words") if "array" in dict(passages.dtypes)["words"] else F.expr(f"octet_length(words) div {BYTES}")
    n, words = passages.agg(F.sum(F.greatest(F.lit(1), F.ceil(size / HALF) - 1)), F.sum(size)).first()
    if not words:
        return Space(np.zeros(0, np.int64), np.zeros((0, rank)), np.zeros(rank), idf, LATENT)
    # as many sums of all buckets travel as there are tasks
    tasks = -(-words // PORTION)
    passages = passages.coalesce(tasks)
    product = _product(passages, idf, None, rank + OVERSAMPLE, tasks)[:, :-1]
    values, vectors = np.linalg.eigh(_inner(product, product))
    # beyond are directions that only rounding made
    sound = values > 1e-10 * values[-1]
    before = product @ (vectors[:, sound] / np.sqrt(values[sound])).astype(np.float32)
    del product
    product = _product(passages, idf, before, before.shape[1], tasks)
    after, total = product[:, :-1], product[:, -1:]
    # Nystroem: A.T A is approximated by F @ F.T, F = after @ root, whose leading singular vectors these are
    small = _inner(before, after)
    del before
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    sound = values > 1e-6 * values[-1]
    root = vectors[:, sound] / np.sqrt(values[sound])
    squares, vectors = np.linalg.eigh(root.T @ _inner(after, after) @ root)
    turn = (root @ vectors / squares * np.sqrt(n))[:, ::-1][:, :rank]
    mean = np.zeros(rank)
    mean[: turn.shape[1]] = (_inner(total, after) @ turn / n)[0]
    index = np.flatnonzero(total)
    rows = np.zeros((len(index), rank), np.float32)
    for lo in range(0, len(index), 8192):
        some = index[lo : lo + 8192]
        rows[lo : lo + 8192, : turn.shape[1]] = after[some] @ turn.astype(np.float32) * idf[some, None]
    return Space(index, rows, mean, idf, LATENT)


def benchmark_passages(benchmark: DataFrame) -> DataFrame:
    """``words`` of all texts of the benchmark (:func:`_pieces`)."""
    return benchmark.select(F.lower("text").alias("text")).mapInArrow(_cut, "words array<int>")


def _benchmark_passages(benchmark: DataFrame) -> DataFrame:
    """:func:`benchmark_passages` as bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches):
            yield pa.RecordBatch.from_arrays([_packed(batch.column("words"))], ["words"])

    return benchmark.select(F.lower("text").alias("text")).mapInArrow(cut, "words binary")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        for lo, hi in chunks(offsets):
            at = offsets[lo : hi + 1]
            hashes, rows = _words(data[at[0] : at[-1]], at - at[0])
            yield pa.RecordBatch.from_arrays([_pieces(_bucket(hashes), np.bincount(rows, minlength=hi - lo))], ["words"])


def _weights(frequencies: np.ndarray, n: int) -> np.ndarray:
    """``FLOOR`` at least: an item that all documents hold makes its own words frequent and must still have a length."""
    return np.maximum(np.log((n + 1) / (frequencies + 1)), FLOOR).astype(np.float32)


def _windows(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and row of each passage of at most ``size`` words, for texts of so many words."""
    n = np.where(counts > 0, np.maximum(0, -(-(counts - size) // (size // 2))) + 1, 0)
    rows = np.repeat(np.arange(len(counts)), n)
    first = ragged(np.zeros(len(n), np.int64), n) * (size // 2)
    return first, np.minimum(size, counts[rows] - first), rows


def _size(n: int) -> int:
    """Words in the windows in which an item of ``n`` words is searched."""
    return next((size for size in SHORT if n <= size), WINDOW)


def _vector(buckets: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Distinct buckets of a passage, their TF-IDF weights, of length 1, and the length before."""
    which, times = np.unique(buckets, return_counts=True)
    weights = times * idf[which]
    length = float(np.sqrt((weights**2).sum()))
    return which, weights / max(length, 1e-9), length


def _passages(words: np.ndarray, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """Words, buckets, weights and length of each passage of an item."""
    for a, n, _ in zip(*_windows(np.array([len(words)]), _size(len(words))), strict=True):
        yield words[a : a + n], *_vector(_bucket(words[a : a + n]), idf)


def item_passages(benchmark: DataFrame, idf) -> DataFrame:
    """``item_id, buckets, weights`` of the benchmark's passages; ``idf``: a broadcast variable."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            hashes, rows = _words(data, offsets)
            found = [(i, *v) for i in range(batch.num_rows) for v in _passages(hashes[rows == i], idf.value)]
            of, _, buckets, weights, _ = ([f[k] for f in found] for k in range(5))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id").take(pa.array(of, pa.int64())),
                    pa.array(buckets, pa.list_(pa.int64())),
                    pa.array(weights, pa.list_(pa.float64())),
                ],
                ["item_id", "buckets", "weights"],
            )

    return materialize(
        benchmark.select("item_id", F.lower("text").alias("text")).mapInArrow(cut, "item_id long, buckets array<long>, weights array<double>")
    )


def _basis(buckets: list[np.ndarray], weights: list[np.ndarray], rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in use and an orthonormal basis of the leading right singular vectors, one row for each bucket."""
    index = np.unique(np.concatenate([*buckets, np.zeros(0, np.int64)]))
    if not len(index):
        return index, np.zeros((0, 1), np.float32)
    passages = np.zeros((len(buckets), len(index)))
    for row, b, w in zip(passages, buckets, weights, strict=True):
        row[np.searchsorted(index, b)] = w
    width = min(rank, len(index))
    # signs from a hash: the same random projection in every run
    seeds = mix(index.astype(np.uint64)[:, None] ^ mix(np.arange(width, dtype=np.uint64)))
    basis = np.where(seeds & np.uint64(1), 1.0, -1.0)
    for _ in range(2):
        before = np.linalg.qr(basis)[0]
        basis = passages.T @ (passages @ before)
    # Nystroem: A.T A is approximated by basis @ inverse(projection) @ basis.T, whose leading vectors these are
    projected = before.T @ basis
    values, vectors = np.linalg.eigh((projected + projected.T) / 2)
    sound = values > 1e-9 * values[-1]
    vectors = np.linalg.svd(basis @ (vectors[:, sound] / np.sqrt(values[sound])), full_matrices=False)[0]
    return index, vectors.astype(np.float32)


def latent_basis(passages: DataFrame, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_basis` of a table of passages that is one block."""
    rows = passages.select("buckets", "weights").toArrow()
    return _basis(*([np.array(x) for x in rows[c].to_pylist()] for c in ("buckets", "weights")), rank)


def _answer(text: str) -> str | None:
    """What follows "answer:" or the last question mark, if anything does."""
    found = re.split(r"\banswer\s*:|\?", text)
    return found[-1] if len(found) > 1 and found[-1].strip() else None


def longest_common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by one bit for each element of ``a``."""
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for x in b.tolist():
        hit = open_ & places.get(x, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(a) - open_.bit_count()


@dataclass
class Block:
    """At most ``BLOCK`` passages of items that are searched in windows of one size, their latent space, and the items themselves."""

    size: int
    ids: list[int | None]
    #: hash of the text of items without an id, to tell them apart
    keys: list[int | None]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    index: np.ndarray
    basis: np.ndarray
    latent: np.ndarray
    owner: np.ndarray
    #: what turns a product with each passage's direction into a share of its squared length
    scale: np.ndarray
    #: weight of each word of the basis
    weights: np.ndarray
    #: the passages' coordinates in the latent space
    semantic: np.ndarray

    def prepare(self) -> None:
        """What is made anew in each task: rows of the basis and of the items' words by bucket, and what a word adds to each passage's product.

        A group of ``TOGETHER`` passages has a row of ``products`` and, for a word that no passage holds, one of zeros; ``bounds``
        holds the most that an occurrence adds to a share of any of them.
        """
        self.place = np.full(BUCKETS, len(self.index), np.int32)
        self.place[self.index] = np.arange(len(self.index))
        groups = -(-len(self.owner) // TOGETHER)
        products = np.zeros((len(self.index) + 1, groups * TOGETHER), np.float32)
        products[:-1, : len(self.owner)] = self.basis @ self.latent.T * self.weights[:, None]
        self.shares = np.zeros((groups, TOGETHER), np.float32)
        self.shares.ravel()[: len(self.owner)] = self.scale
        self.bounds = np.maximum((products * self.shares.ravel()).reshape(len(products), groups, TOGETHER).max(axis=2), 0)
        self.products = products.reshape(-1, TOGETHER)
        buckets = [np.unique(_bucket(w), return_counts=True) for w in self.words]
        vocabulary = np.unique(np.concatenate([b for b, _ in buckets]))
        self.entry = np.full(BUCKETS, len(vocabulary), np.int32)
        self.entry[vocabulary] = np.arange(len(vocabulary))
        self.times = np.zeros((len(self.words), len(vocabulary) + 1), np.int32)
        for row, (b, n) in zip(self.times, buckets, strict=True):
            row[self.entry[b]] = n
        self.holds = self.times.ravel() > 0


def _block(passages: list[tuple], idf: np.ndarray, known: np.ndarray, space: Space) -> Block:
    """``passages``: the item (``id, key, words, answer``), its words, buckets, weights and length; ``known``: which buckets documents hold."""
    items = list({id(item): item for item, *_ in passages}.values())
    at = {id(item): i for i, item in enumerate(items)}
    _, words_of, buckets, weights, lengths = zip(*passages, strict=True)
    ends = np.cumsum([0, *map(len, words_of)])
    semantic = space.passages(_bucket(np.concatenate(words_of)), ends[:-1], np.diff(ends))
    index, basis = _basis(list(buckets), list(weights))
    # shares are of the length on words that documents hold: the others can be in no copy, however often it was edited
    held = np.array([np.square(w[known[b]]).sum() for b, w in zip(buckets, weights, strict=True)])
    scale = np.where(held > 0, 1 / np.maximum(held * np.array(lengths), 1e-9), 0)
    latent = np.zeros((len(passages), basis.shape[1]))
    for row, b, w in zip(latent, buckets, weights, strict=True):
        row[:] = w @ basis[np.searchsorted(index, b)]
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    ids, keys, words, answers = zip(*items, strict=True)
    return Block(
        _size(len(words[0])),
        list(ids),
        list(keys),
        list(words),
        list(answers),
        index,
        basis,
        latent.astype(np.float32),
        np.array([at[id(item)] for item, *_ in passages], np.int64),
        scale.astype(np.float32),
        idf[index],
        semantic,
    )


def _blocks(benchmark: DataFrame, frequencies: np.ndarray, n: int, space: Space) -> DataFrame:
    """``block, size, data``: the benchmark's blocks, pickled, with a number and their bytes."""
    shared = benchmark.sparkSession.sparkContext.broadcast((_weights(frequencies, n), frequencies > 0, space))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, known, space = shared.value

        def row(passages: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_block(passages, idf, known, space))], pa.binary())], ["data"])

        waiting: dict[int, list] = {}
        for batch in batches:
            for item_id, key, text in zip(*(batch.column(c).to_pylist() for c in ("item_id", "key", "text")), strict=True):
                words = _words(*flat(pa.array([text], pa.large_string())))[0]
                if (answer := _answer(text)) is not None:
                    answers = np.unique(_words(*flat(pa.array([answer], pa.large_string())))[0])
                else:
                    distinct = np.unique(words)
                    rarest = np.argsort(-idf[_bucket(distinct)], kind="stable")
                    answers = distinct[rarest[: max(3, len(distinct) // 4)]]
                item = (item_id, key, words, answers)
                group = waiting.setdefault(_size(len(words)), [])
                for passage in _passages(words, idf):
                    group.append((item, *passage))
                    if len(group) == BLOCK:
                        yield row(group)
                        group.clear()
        yield from map(row, filter(None, waiting.values()))

    items = benchmark.where("text IS NOT NULL").select("item_id", F.lower("text").alias("text")).distinct()
    items = materialize(items.select("item_id", F.when(F.isnull("item_id"), F.xxhash64("text")).alias("key"), "text"))
    tasks = -(-items.count() // 1024)
    built = items.repartition(max(1, tasks)).mapInArrow(build, "data binary")
    return materialize(built.select(F.monotonically_increasing_id().alias("block"), F.octet_length("data").alias("size"), "data"))


def _rounds(blocks: DataFrame) -> Iterator[list[Block]]:
    """The blocks in portions of at most ``ROUND_BYTES``, or of one block."""
    table = blocks.select("block", "size").orderBy("block").toArrow()
    sizes = np.concatenate([[0], np.cumsum(table["size"].to_numpy(), dtype=np.int64)])
    for lo, hi in chunks(sizes, ROUND_BYTES):
        chosen = blocks.where(F.col("block").isin(table["block"][lo:hi].to_pylist()))
        yield [pickle.loads(b) for b in chosen.select("data").toArrow()["data"].to_pylist()]


def _possible(starts: np.ndarray, ends: np.ndarray, which: np.ndarray, buckets: np.ndarray, block: Block) -> np.ndarray:
    """Of stretches of words and items, those whose words in common, in any order, reach ``PARAPHRASE`` of the item."""
    out = np.zeros(len(starts), bool)
    entries, many = block.entry[buckets], block.times.shape[1]
    least = PARAPHRASE * np.array([len(w) for w in block.words])[which]
    for lo, hi in chunks(np.concatenate([[0], np.cumsum(ends - starts)]), 1 << 18):
        length = ends[lo:hi] - starts[lo:hi]
        keys = np.repeat(which[lo:hi] * many, length) + entries[ragged(starts[lo:hi], length)]
        held = block.holds.take(keys)
        # with all occurrences first, which are as many at least
        enough = np.add.reduceat(held, np.cumsum(length) - length, dtype=np.int64) >= least[lo:hi]
        held &= np.repeat(enough, length)
        of, n = np.unique(np.repeat(np.arange(hi - lo), length)[held] * block.times.size + keys[held], return_counts=True)
        common = np.bincount(of // block.times.size, np.minimum(n, block.times.ravel()[of % block.times.size]), hi - lo)
        out[lo:hi] = common >= least[lo:hi]
    return out


def _near(block: Block, buckets: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage and item of pairs whose share of the item's length reaches ``COSINE``; the passages are all of some texts."""
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # two halves each: the second is the next passage's first, or stands alone behind a text's last passage
    half = block.size // 2
    two = length > half
    alone = two.copy()
    alone[:-1] &= first[1:] != first[:-1] + half
    begin = np.arange(len(first)) + np.cumsum(alone) - alone
    begins = np.repeat(first, 1 + alone)
    begins[begin[alone] + 1] += half
    place = block.place[buckets]
    sums = _sums(block.bounds, place, begins)
    bounds = sums[begin]
    bounds[two] += sums[begin[two] + 1]
    at, group = np.divmod(np.flatnonzero(bounds >= 0.99 * COSINE**2), bounds.shape[1])
    found = []
    for lo, hi in chunks(np.append(0, np.cumsum(length[at])), 1 << 16):
        which, many = group[lo:hi], length[at[lo:hi]]
        rows = place[ragged(first[at[lo:hi]], many)] * np.int64(bounds.shape[1]) + np.repeat(which, many)
        products = np.add.reduceat(block.products.take(rows, axis=0), np.cumsum(many) - many, axis=0)
        row, column = np.nonzero(products * block.shares[which] >= COSINE**2)
        found.append((at[lo:hi][row], block.owner[which[row] * TOGETHER + column]))
    return tuple(np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in range(2))


def _candidates(windows: tuple, block: Block, space: Space, buckets: np.ndarray, semantic: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Passage, item and latent cosine of the candidates of both routes."""
    first, length = windows
    at, item = _near(block, buckets, first, length)
    pairs = [at * len(block.words) + item]
    if semantic is not None:
        for lo in range(0, len(semantic), 2048):
            near, passage = np.divmod(np.flatnonzero(semantic[lo : lo + 2048] @ block.semantic.T >= space.least), len(block.semantic))
            pairs.append((lo + near) * len(block.words) + block.owner[passage])
    pairs = np.unique(np.concatenate(pairs))
    at, item = pairs // len(block.words), pairs % len(block.words)
    cosine = np.full(len(at), -1.0)
    vectors = space.passages(buckets, first[at], length[at]) if semantic is None else semantic[at]
    # an item's passages stand next to each other
    begin = np.searchsorted(block.owner, np.arange(len(block.words) + 1))
    for k in range(int(np.diff(begin).max(initial=0))):
        has = np.flatnonzero(begin[item] + k < begin[item + 1])
        cosine[has] = np.maximum(cosine[has], (vectors[has] * block.semantic[begin[item[has]] + k]).sum(axis=1))
    return at, item, cosine


def _matches(
    hashes: np.ndarray, counts: np.ndarray, block: Block, space: Space, semantic: np.ndarray
) -> Iterator[tuple[int, int, float, float, float]]:
    """Row, item, cosine, share of the item in common, share of the answer, for each confirmed pair.

    ``semantic``: coordinates of the windows of ``WINDOW`` words.
    """
    begin = np.cumsum(counts) - counts
    first, length, rows = _windows(counts, block.size)
    first = first + begin[rows]
    buckets = _bucket(hashes)
    at, item, cosine = _candidates((first, length), block, space, buckets, semantic if block.size == WINDOW else None)
    if not len(at):
        return
    size = np.array([len(w) for w in block.words])[item]
    starts = np.maximum(begin[rows[at]], first[at] - size)
    ends = np.minimum((begin + counts)[rows[at]], first[at] + length[at] + size)
    sound = np.flatnonzero(_possible(starts, ends, item, buckets, block))
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for n in sound.tolist():
        p, i = at[n], int(item[n])
        words, around = block.words[i], hashes[starts[n] : ends[n]]
        common = longest_common(words, around) / len(words)
        if common < PARAPHRASE:
            continue
        answer = float(np.isin(block.answers[i], around).mean())
        if common >= LCS or (answer >= ANSWER and len(words) >= LEAST):
            found = (common, answer, float(cosine[n]))
            best[int(rows[p]), i] = max(found, best.get((int(rows[p]), i), found))
    for (row, i), (common, answer, cosine_) in best.items():
        yield row, i, cosine_, common, answer


def _search(rows: DataFrame, blocks: list[Block], space: Space) -> DataFrame:
    """Each confirmed pair of ``rows`` and an item of the blocks, as often as it is found."""
    shared = rows.sparkSession.sparkContext.broadcast((blocks, space))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, space = shared.value
        for block in blocks:
            block.prepare()
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            for lo, hi in chunks(offsets):
                at = offsets[lo : hi + 1]
                hashes, rows = _words(data[at[0] : at[-1]], at - at[0])
                counts = np.bincount(rows, minlength=hi - lo)
                semantic = space.windows(_bucket(hashes), counts)
                found = [(lo + r, b.ids[i], b.keys[i], *m) for b in blocks for r, i, *m in _matches(hashes, counts, b, space, semantic)]
                row, item, key, cosine, common, answer = ([f[k] for f in found] for k in range(6))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).take(pa.array(row, pa.int64())) for c in ("doc_id", "row_hash")],
                        pa.array(item, pa.int64()),
                        pa.array(key, pa.int64()),
                        pa.array(cosine, pa.float64()),
                        pa.array(common, pa.float64()),
                        pa.array(answer, pa.float64()),
                    ],
                    _PAIRS.names,
                )
        give_back()

    pairs = materialize(rows.mapInArrow(search, _PAIRS))
    shared.destroy()
    return pairs


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, row_hash, item_id, cosine, common, answer``: each pair of a document and an item that it holds."""
    frequencies, n, passages = _survey(documents)
    idf = _weights(frequencies, n)
    space = latent_space(passages.unionByName(materialize(_benchmark_passages(benchmark))), idf)
    rows = documents.select("doc_id", F.xxhash64("text").alias("row_hash"), F.lower("text").alias("text"))
    pairs = documents.sparkSession.createDataFrame([], _PAIRS)
    for blocks in _rounds(_blocks(benchmark, frequencies, n, space)):
        pairs = pairs.unionByName(_search(rows, blocks, space))
    best = F.max(F.struct("common", "answer", "cosine")).alias("m")
    found = pairs.groupBy("doc_id", "row_hash", "item_id", "key").agg(best)
    return found.select("doc_id", "row_hash", "item_id", "m.cosine", "m.common", "m.answer")


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without the rows that hold an item."""
    found = contaminated(documents, benchmark)
    leaked = materialize(found.select("doc_id", "row_hash").distinct())
    rows = packed(documents, key=F.xxhash64("text"), id=F.col("doc_id"))
    same = (F.col("key") == F.col("row_hash")) & F.col("id").eqNullSafe(F.col("doc_id"))
    return rows.join(leaked, same, "left_anti").select("row.*")
