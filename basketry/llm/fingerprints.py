"""Document fingerprints: quartile digests of hashed byte triplets.

Every three bytes that stand within a window of four (positions 0-1-2, 0-1-3, 0-2-3) are hashed to one of 256
buckets. A bucket's code is the quartile its count falls in (2 bits), so the digest holds 64 bytes of codes, one
byte for the length on a logarithmic scale and one checksum byte, in hexadecimal. Two digests differ by a
bounded score: 0, 1, 2 or 6 for each bucket, 4 for each step of length up to 12 steps, 1 for the checksum; the
likeness is 1 for a score of 0 and 0 from the score on that unrelated codes are expected to have.

Null texts are empty texts; texts under three bytes have no triplet and differ by length and checksum alone.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm._text import CHUNK_BYTES
from basketry.session import materialize

BUCKETS = 256
#: the mean score of a bucket for two independent codes: (6 * 1 + 4 * 2 + 2 * 6) / 16
UNRELATED = 1.625 * BUCKETS
_STEP = np.array([0, 1, 2, 6], np.uint8)
_WINDOW = ((0, 1, 2), (0, 1, 3), (0, 2, 3))


def _buckets(data: np.ndarray) -> np.ndarray:
    """Counts of the 256 buckets for one text."""
    counts = np.zeros(BUCKETS, np.int64)
    for lo in range(0, len(data), CHUNK_BYTES):
        part = data[lo : lo + CHUNK_BYTES + 3].astype(np.uint32)
        for k, (a, b, c) in enumerate(_WINDOW):
            n = min(len(part) - c, CHUNK_BYTES)
            if n <= 0:
                continue
            key = part[a : a + n] | part[b : b + n] << np.uint32(8)
            key |= part[c : c + n] << np.uint32(16)
            key ^= np.uint32(k << 24)
            key *= np.uint32(0x9E3779B1)
            key >>= np.uint32(24)
            counts += np.bincount(key, minlength=BUCKETS)
    return counts


def _length_code(n: int) -> int:
    return min(255, int(np.log2(n + 1) * 6))


def codes(text: str) -> np.ndarray:
    """The digest as numbers: 256 quartile codes, the length code, the checksum."""
    raw = text.encode("utf-8", "surrogatepass")
    counts = _buckets(np.frombuffer(raw, np.uint8))
    quartiles = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    out = np.empty(BUCKETS + 2, np.uint8)
    out[:BUCKETS] = (counts[:, None] > quartiles).sum(axis=1)
    out[BUCKETS] = _length_code(len(raw))
    out[BUCKETS + 1] = zlib.crc32(raw) & 255
    return out


def digest(code: np.ndarray) -> str:
    packed = code[:BUCKETS].reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    return (bytes(packed.astype(np.uint8)) + bytes(code[BUCKETS:])).hex()


def undigest(text: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(text), np.uint8)
    quartiles = (raw[:-2, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3
    return np.concatenate([quartiles.ravel(), raw[-2:]])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal digests, 0 for a score of unrelated ones or above."""
    far = np.abs(a[:-1].astype(np.int16) - b[:-1])
    score = int(_STEP[far[:-1]].sum(dtype=np.int64)) + 4 * min(12, int(far[-1])) + int(a[-1] != b[-1])
    return 1.0 - min(1.0, score / UNRELATED)


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the digest of a text column."""

    @F.pandas_udf("string")
    def digests(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: digest(codes(t or "")))

    return df.withColumn(out, digests(F.coalesce(text, F.lit(""))))


def compare(left: str, right: str):
    """Likeness of two digest columns."""

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(undigest(x), undigest(y)) for x, y in zip(a, b, strict=True)], dtype=float)

    return score(left, right)


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_COLUMNS = [part.split()[0] for part in _RESULT.split(", ")]


def _row(doc_id, text: str, code: np.ndarray, following: str, following_code: np.ndarray) -> tuple:
    cut = len(text) // 3
    edited = text[: len(text) - cut] + following[:cut]
    edited_code = codes(edited)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        digest(code),
        digest(edited_code),
        likeness(code, edited_code),
        likeness(code, following_code),
    )


def edited_likeness(documents: DataFrame) -> DataFrame:
    """Fingerprint every text and its edited text, whose last third comes from the next document.

    ``documents``: ``doc_id``, ``text``, other columns are ignored. The next document is the one that follows in
    descending ``doc_id`` (nulls last; equal ids by the text's hash), after the last the first; of one document
    alone it is itself. Repeated rows are documents of their own. An empty table gives an empty result.

    Texts are shuffled once, by ranges of ``doc_id``. Each task pairs neighbours while it streams its range; the
    first and last text of a range go to a table of two rows for each range, which pairs the seams.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    dealt = (
        documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )

    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here = TaskContext.get().partitionId()
        held = None
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                code = codes(text)
                if held is None:
                    rows.append((None,) * 7 + ("first", here, doc_id, text))
                else:
                    rows.append(_row(*held, text, code) + (None, None, None, None))
                held = doc_id, text, code
            yield _frame(rows)
        if held is not None:
            yield _frame([(None,) * 7 + ("last", here, held[0], held[1])])

    names = [*_COLUMNS, "_edge", "_range", "_id", "_text"]

    def _frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        return out.astype({"doc_id": "Int64", "n_chars": "Int64", "_range": "Int64", "_id": "Int64"})

    seen = materialize(
        dealt.mapInPandas(pair, f"{_RESULT}, _edge string, _range long, _id long, _text string")
    )
    edges = seen.where(F.col("_edge").isNotNull())
    ranges = edges.select("_range").distinct()
    in_order = Window.orderBy("_range")
    following = ranges.select(
        "_range",
        F.coalesce(F.lead("_range").over(in_order), F.min("_range").over(Window.partitionBy())).alias("_next"),
    )
    firsts = edges.where("_edge = 'first'").select(F.col("_range").alias("_next"), F.col("_text").alias("_after"))
    seams = (
        edges.where("_edge = 'last'")
        .select("_range", F.col("_id").alias("doc_id"), "_text")
        .join(following, "_range")
        .join(firsts, "_next")
        .select("doc_id", "_text", "_after")
    )

    def seam(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                _row(None if pd.isna(i) else int(i), a, codes(a), b, codes(b))
                for i, a, b in zip(batch["doc_id"], batch["_text"], batch["_after"], strict=True)
            ]
            yield pd.DataFrame(rows, columns=_COLUMNS).astype({"doc_id": "Int64", "n_chars": "Int64"})

    inner = seen.where(F.col("_edge").isNull()).select(*_COLUMNS)
    return inner.unionByName(seams.mapInPandas(seam, _RESULT))
