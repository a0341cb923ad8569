"""Token-id output: texts encoded with a public tokenizer, ids coded by :mod:`rangecoder` in checksummed blocks.

*Files.* Documents go in ascending ``doc_id`` (nulls last, equal ids by their text's hash) to parts by range; a part's ids
are cut into blocks of ``rangecoder.BLOCK``, whatever document they belong to. The files are Parquet tables of
``part, block, payload``, committed by Spark's writer, so an attempt lost with its executor leaves nothing. A payload
is self-contained (little-endian): ``magic`` "CMRC", version and bits (one byte each), number of pieces and of ids
(32 bits each), number of the first document in the part (64), CRC-32 of the ids as 32-bit integers, CRC-32 of the
coded block, CRC-32 of all before and of the pieces; then for each piece its document id (64), its length (32) and flags
(8: 1 null id, 2 the document begins, 4 it ends); then the coded block (alphabet and words). A reader checks the header's sum and bounds and the
words' sum before it decodes a block, the ids' sum after, and needs no other block.

*Encoding.* A text's bytes are cut where white space follows something else and where ASCII punctuation follows an ASCII
letter; the tokenizer's own pre-tokenizer always cuts there, so encoding the pieces gives the ids of the whole text, and
a piece that recurs is encoded once per task; pieces go to the tokenizer many at a time, parted by its special token. A text with white space beyond ASCII, or a tokenizer of another kind, is
encoded whole.

A null text is empty and has only the end id. Repeated rows are documents of their own. Other columns are ignored. An empty
table gives empty files and an empty result.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm import rangecoder
from basketry.llm._text import chunks, flat, give_back, ragged
from basketry.session import materialize, new_table_path

END_ID = 2
_HEAD = np.dtype(
    [
        ("magic", "S4"),
        ("version", "u1"),
        ("bits", "u1"),
        ("pieces", "<u4"),
        ("ids", "<u4"),
        ("first", "<i8"),
        ("ids_crc", "<u4"),
        ("words_crc", "<u4"),
        ("head_crc", "<u4"),
    ]
)
_PIECE = np.dtype([("doc_id", "<i8"), ("n", "<u4"), ("flags", "u1")])
VERSION = 3
NULL, BEGINS, ENDS = 1, 2, 4
#: pieces that a task remembers before it starts anew, and pieces that go to the tokenizer at a time
REMEMBERED, LEARNED = 500_000, 4096
#: pieces that go as one text, parted by a token that the tokenizer finds before it cuts
JOINED = 64
#: bytes of text that are cut into pieces at a time
CUT_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
#: leading bytes of white space beyond ASCII in UTF-8
_WIDE = np.zeros(256, bool)
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


class Encoder:
    """Ids of texts, piece by piece where the tokenizer allows it."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut = spec.get("pre_tokenizer") or {}
        plain = not spec.get("normalizer") and cut.get("type") == "ByteLevel"
        self.by_piece = plain and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        # added tokens are found before the text is cut
        self.by_piece &= not any(
            t["lstrip"] or t["rstrip"] or any(_SPACE[b] or _LETTER[a] and _MARK[b] for a, b in _pairs(t["content"]))
            for t in spec.get("added_tokens", [])
            if t["content"] != "<|endoftext|>"
        )
        self.whole = "<|endoftext|>"
        self.parting = self._parting(spec) if self.by_piece else None
        self.bits = max(16, (self.tokenizer.get_vocab_size() - 1).bit_length())
        self.forget()

    def forget(self) -> None:
        #: number of each piece, ids of all, where a piece's begin and how many it has
        self._known: dict[str, int] = {}
        self._ids = np.zeros(0, np.uint32)
        self._begins, self._sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _parting(self, spec: dict) -> int | None:
        """The id of ``whole`` if texts may be joined by it: no other added token, nothing stripped, no length set."""
        added = spec.get("added_tokens", [])
        free = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
        if [t["content"] for t in added] != [self.whole] or not free or spec.get("truncation") or spec.get("padding"):
            return None
        return self.tokenizer.token_to_id(self.whole)

    def _learn(self, pieces: list[str]) -> None:
        apart = [self.parting is None or self.whole in p for p in pieces]
        odd = [p for p, alone in zip(pieces, apart, strict=True) if alone]
        plain = [p for p, alone in zip(pieces, apart, strict=True) if not alone]
        pieces, all_ids, all_sizes = odd + plain, [self._ids], [self._sizes]
        for some, encoded in ((odd, self._one_by_one), (plain, self._joined)):
            for lo in range(0, len(some), LEARNED):
                ids, sizes = encoded(some[lo : lo + LEARNED])
                all_ids.append(ids)
                all_sizes.append(sizes)
        self._known.update(zip(pieces, range(len(self._sizes), len(self._sizes) + len(pieces)), strict=True))
        self._ids, self._sizes = np.concatenate(all_ids), np.concatenate(all_sizes)
        self._begins = np.cumsum(self._sizes) - self._sizes

    def _one_by_one(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces and how many each has."""
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter(chain.from_iterable(encoded), np.uint32, int(sizes.sum())), sizes

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_one_by_one``, for pieces without ``whole``; a call costs as much as a short piece."""
        texts = [self.whole.join(pieces[lo : lo + JOINED]) + self.whole for lo in range(0, len(pieces), JOINED)]
        ids, _ = self._one_by_one(texts)
        parting = ids == self.parting
        ends = np.flatnonzero(parting)
        if len(ends) != len(pieces):
            raise ValueError("pieces were not parted")
        return ids[~parting], np.diff(ends, prepend=-1) - 1

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and how many each has."""
        n = len(offsets) - 1
        starts = self._cuts(data, offsets)
        pieces = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data.tobytes())
        ).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        if len(self._known) > REMEMBERED:
            self.forget()
        self._learn([p for p in distinct if p not in self._known])
        numbers = np.fromiter(map(self._known.__getitem__, distinct), np.int64, len(distinct))
        at = numbers[pieces.indices.to_numpy(zero_copy_only=False)]
        sizes = self._sizes[at]
        rows = np.searchsorted(offsets[1:], starts, "right")
        counts = np.bincount(rows, sizes, n).astype(np.int64) if len(starts) else np.zeros(n, np.int64)
        return self._ids[ragged(self._begins[at], sizes)], counts

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        first = np.zeros(len(data), bool)
        first[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
        if self.by_piece and len(data):
            space = _SPACE[data]
            cut = np.zeros(len(data), bool)
            cut[1:] = (space[1:] & ~space[:-1]) | (_MARK[data[1:]] & _LETTER[data[:-1]])
            wide = np.flatnonzero(_WIDE[data])
            if len(wide):
                suspect = np.unique(np.searchsorted(offsets[1:], wide, "right"))
                for row in suspect:
                    a, b = offsets[row], offsets[row + 1]
                    text = data[a:b].tobytes().decode("utf-8", "replace")
                    if any(c.isspace() and not c.isascii() for c in set(text)):
                        cut[a:b] = False
            special = self.whole.encode()
            raw = data.tobytes()
            at = raw.find(special)
            while at >= 0:  # letters and marks inside the special token stay together
                cut[at + 1 : at + len(special)] = False
                at = raw.find(special, at + 1)
            first |= cut
        return np.flatnonzero(first)


def _pairs(text: str) -> list[tuple[int, int]]:
    raw = text.encode()
    return list(zip(raw, raw[1:], strict=False))


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _head_crc(head: bytes, pieces: bytes) -> int:
    return zlib.crc32(pieces, zlib.crc32(head[:-4]))


def _payloads(blocks: list[tuple[int, np.ndarray, np.ndarray]], bits: int) -> list[bytes]:
    """The blocks as they are written; ``blocks`` is emptied, so that ids stand in memory once while they are coded."""
    heads = [(first, pieces, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for first, pieces, ids in blocks]
    coded = rangecoder.encode_blocks([blocks.pop(0)[2] for _ in heads], bits)
    out = []
    for (first, pieces, n, ids_crc), words in zip(heads, coded, strict=True):
        head = np.zeros(1, _HEAD)
        head[0] = (b"CMRC", VERSION, bits, len(pieces), n, first, ids_crc, zlib.crc32(words), 0)
        head[0]["head_crc"] = _head_crc(head.tobytes(), pieces.tobytes())
        out.append(head.tobytes() + pieces.tobytes() + words)
    return out


class _Blocks:
    """Cuts a part's stream of ids into blocks."""

    def __init__(self, bits: int, end: int) -> None:
        self.bits, self.end = bits, end
        self.pieces: list[tuple[int, int, int]] = []
        self.ids: list[np.ndarray] = []
        self.held = self.docs = self.first = 0
        self.full: list[tuple[int, np.ndarray, np.ndarray]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        ids = np.append(ids, np.uint32(self.end)).astype(np.uint32)
        flags, at = BEGINS | (NULL if doc_id is None else 0), 0
        while at < len(ids):
            part = ids[at : at + rangecoder.BLOCK - self.held]
            at += len(part)
            self.pieces.append((doc_id or 0, len(part), flags | (ENDS if at == len(ids) else 0)))
            flags &= ~BEGINS
            self.ids.append(part)
            self.held += len(part)
            if at == len(ids):
                self.docs += 1
            if self.held == rangecoder.BLOCK:
                self.close()

    def close(self) -> None:
        if self.held:
            self.full.append((self.first, np.array(self.pieces, _PIECE), np.concatenate(self.ids)))
        self.pieces, self.ids, self.held, self.first = [], [], 0, self.docs


def _encoded(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, np.ndarray]]:
    """Document id and token ids of each row; at the end the encoder forgets what it learned from them."""
    try:
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            names = batch.column("doc_id").to_pylist()
            for lo, hi in chunks(offsets, CUT_BYTES):
                at = offsets[lo : hi + 1]
                ids, counts = encoder.encode(data[at[0] : at[-1]], at - at[0])
                ends = np.cumsum(counts)
                for k in range(hi - lo):
                    yield names[lo + k], ids[ends[k] - counts[k] : ends[k]]
    finally:
        encoder.forget()
        give_back()


def write_tokens(documents: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the ids of ``documents`` (``doc_id``, ``text``) to ``folder``; ``tokenizer``: path of its file on all machines."""
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    dealt = documents.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, written = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        blocks = _Blocks(encoder.bits, end_id)

        def emit() -> pa.RecordBatch:
            nonlocal written
            group = blocks.full[: rangecoder.LANES]
            del blocks.full[: rangecoder.LANES]
            payloads = _payloads(group, blocks.bits)
            numbers = np.arange(written, written + len(payloads), dtype=np.int64)
            written += len(payloads)
            parts = np.full(len(payloads), part, np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(parts), pa.array(numbers), pa.array(payloads, pa.binary())], ["part", "block", "payload"]
            )

        for name, ids in _encoded(encoder, batches):
            blocks.add(name, ids)
            while len(blocks.full) >= rangecoder.LANES:
                yield emit()
        blocks.close()
        while blocks.full:
            yield emit()
        give_back()

    coded = dealt.mapInArrow(code, "part int, block long, payload binary")
    coded.write.option("compression", "none").parquet(folder)


def read_blocks(payloads: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First document number, pieces and ids of each payload; wrong sums and numbers raise, before decoding where they can."""
    heads, pieces, words = [], [], []
    for p in payloads:
        if len(p) < _HEAD.itemsize:
            raise ValueError("not a block of token ids")
        head = np.frombuffer(p, _HEAD, 1)[0]
        if head["magic"] != b"CMRC" or head["version"] != VERSION:
            raise ValueError("not a block of token ids")
        middle = _HEAD.itemsize + int(head["pieces"]) * _PIECE.itemsize
        # before anything is read by the header's numbers: a damaged count would ask for years or terabytes
        if middle > len(p) or _head_crc(p[: _HEAD.itemsize], p[_HEAD.itemsize : middle]) != head["head_crc"]:
            raise ValueError("a block's header is damaged")
        piece = np.frombuffer(p[_HEAD.itemsize : middle], _PIECE)
        if head["ids"] > rangecoder.BLOCK or head["ids"] != piece["n"].sum(dtype=np.int64) or head["bits"] > 20:
            raise ValueError("a block's header is out of bounds")
        heads.append(head)
        pieces.append(piece)
        words.append(p[middle:])
        if zlib.crc32(p[middle:]) != head["words_crc"]:
            raise ValueError("a block's words are damaged")
    if not heads:
        return
    if len({int(h["bits"]) for h in heads}) > 1:
        raise ValueError("blocks of different widths")
    decoded = rangecoder.decode_blocks(words, [int(h["ids"]) for h in heads], int(heads[0]["bits"]))
    for head, piece, ids in zip(heads, pieces, decoded, strict=True):
        if zlib.crc32(ids.astype("<u4").tobytes()) != head["ids_crc"]:
            raise ValueError("a block's ids are damaged")
        yield int(head["first"]), piece, ids


def _shift(crc: int, n: int) -> int:
    """The CRC-32 register after ``n`` zero bytes: a product with x^(8n) modulo the polynomial, bits reflected."""
    factor, power, bits = 0x80000000, 0x00800000, n
    while bits:
        if bits & 1:
            factor = _product(factor, power)
        power = _product(power, power)
        bits >>= 1
    return _product(crc, factor)


def _product(a: int, b: int) -> int:
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def crc_of_parts(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of byte strings joined, from the sum and length of each."""
    crc = 0
    for part, n in parts:
        crc = _shift(crc, n) ^ part
    return crc


def _joined_crc(pieces: pd.Series) -> pd.Series:
    return pieces.map(
        lambda ps: int(ps[0]["crc"]) if len(ps) == 1 else crc_of_parts([(int(p["crc"]), 4 * int(p["n"])) for p in ps])
    )


def _groups(n: int) -> Iterator[tuple[int, int]]:
    """Ranges of blocks that are decoded together: a step costs nearly as much for few lanes, so a few join the last group."""
    lo = 0
    while lo < n:
        hi = n if n - lo <= rangecoder.LANES * 5 // 4 else lo + rangecoder.LANES
        yield lo, hi
        lo = hi


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document in the files of ``folder``."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in _groups(batch.num_rows):
                rows = batch.slice(lo, hi - lo)
                blocks = read_blocks(rows.column("payload").to_pylist())
                for part, number, (first, cut, ids) in zip(
                    rows.column("part").to_pylist(), rows.column("block").to_pylist(), blocks, strict=True
                ):
                    begins = (cut["flags"] & BEGINS) > 0
                    # the first piece goes on with the document that the block before left open, or begins one
                    docs = first + np.cumsum(begins) - (1 if begins[0] else 0)
                    n = cut["n"].astype(np.int64)
                    raw, ends = ids.astype("<u4").tobytes(), np.cumsum(n) * 4
                    sums = [zlib.crc32(raw[e - 4 * k : e]) for e, k in zip(ends, n, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(cut), part, np.int32)),
                            pa.array(docs.astype(np.int64)),
                            pa.array(np.full(len(cut), number, np.int64)),
                            pa.array(cut["doc_id"].astype(np.int64), mask=(cut["flags"] & NULL) > 0),
                            pa.array(n),
                            pa.array(sums, pa.int64()),
                        ],
                        ["part", "doc", "block", "doc_id", "n", "crc"],
                    )
        give_back()

    schema = "part int, doc long, block long, doc_id long, n long, crc long"
    found = spark.read.schema("part int, block long, payload binary").parquet(folder).mapInArrow(pieces, schema)
    docs = found.groupBy("part", "doc").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("block", "n", "crc"))).alias("pieces"),
    )
    docs = materialize(
        docs.select("part", "doc", "doc_id", "n_tokens", F.pandas_udf(_joined_crc, "long")("pieces").alias("ids_crc32"))
    )
    # one row for each part
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = docs.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("doc").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(parts, "part").select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenize(documents: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write the ids and describe each document as read back from the files."""
    spark = documents.sparkSession
    folder = folder or new_table_path(spark)
    write_tokens(documents, folder, tokenizer)
    return read_documents(spark, folder)
