"""Repeated byte strings, found with run-length indexes (:mod:`runindex`) over the stretches of text that can repeat.

A byte is removed if a string of ``LENGTH`` bytes that covers it starts anywhere else too, in the same text or another; overlaps
count, and all strings are judged on the input. Matches never cross texts.

*Which index holds a string.* The least hash among the ``GRAM``-byte grams of a string, its anchor, depends on its bytes alone, so
equal strings share it. Strings next to each other with one anchor form a stretch of text; only stretches whose anchor occurs
more than once, in others or inside, can repeat. They are dealt by anchor to tasks, where blocks of some megabytes each get their own index: a
run-compressed Burrows-Wheeler transform with sampled run ends, whose matching statistics are streamed along the block. Equal
stretches (same anchor, hash and length) stand in the index once, with their number. Every decision compares bytes.

*Hot anchors.* An anchor in more than ``HOT`` different stretches would fill its task with strings that mostly differ outside the
shared gram. Such stretches are split by where in a string its anchor stands, in bands of 32 places, and dealt by the
bytes that all strings of a band share as well; bands whose bytes occur once fall away, those that are still hot are split
again in bands of 8, 2 and 1. Bands of one share the whole string, so no group is unbounded, whatever a corpus shares.

*Travel.* Rows are entries of a few integers; texts are shuffled twice, to cut the candidates' bytes and to take the repeats out. A text
is known by a 64-bit hash and 20 further bits, so repeated rows and null or equal ids need no care: equal texts get equal results.

Null texts are empty. Texts of under ``LENGTH`` bytes stay whole. Very long texts are read in pieces of some megabytes. Columns
other than the text pass through unchanged; new columns whose name is taken get underscores behind it. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm._columns import free, packed
from basketry.llm._text import _BASE, _INVERSE, _power, chunks, mix, ragged
from basketry.llm.runindex import repeated_spans
from basketry.session import materialize

LENGTH = 200
GRAM = 32
#: different stretches of an anchor beyond which they are split, and the bands they are split into
HOT = 4096
BANDS = (32, 8, 2, 1)
#: strings in a stretch at most, so a stretch has under 2,048 bytes
STRETCH = 1024
#: bytes that one index holds, a last group of at most HOT stretches apart; small blocks stay in a core's cache
BLOCK_BYTES = 1 << 17
SLICE = 2 << 20
#: texts whose hash a task remembers, so that copies in it are read once
REMEMBERED = 1_000_000

#: ``at``: a stretch in its text as one integer: 20 bits of the text's check, 31 of the start, one if the anchor recurs inside,
#: 11 of the length
_ENTRY = "anchor bigint, seg bigint, key bigint, at bigint"


@dataclass(frozen=True)
class Sizes:
    """What the strings are; smaller ones are for tests."""

    length: int = LENGTH
    gram: int = GRAM
    hot: int = HOT
    bands: tuple[int, ...] = BANDS


def _texts(documents: DataFrame, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    return documents.select(body).select(
        F.xxhash64("text").alias("key"), F.crc32("text").bitwiseAND((1 << 20) - 1).cast("int").alias("check"), F.col("text").cast("binary")
    )


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def _sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums, from which the hash of any stretch follows."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, len(data))[: len(data)], out=out[1:])
    return out


def _hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * _power("down", _INVERSE, len(sums))[start] + (end - start).astype(np.uint64))


def _grams(sums: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the gram at each place, mixed enough for its order to look random."""
    n = len(sums) - gram
    out = sums[gram:] - sums[:-gram]
    out *= _power("down", _INVERSE, n)[:n]
    out ^= out >> np.uint64(31)
    out *= _BASE
    out ^= out >> np.uint64(29)
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(values) - width + 1
    padded = np.append(values, np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _stretches(data: np.ndarray, ends: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, ...] | None:
    """``anchor, seg, start, end`` of all stretches of ``data``, texts ending at ``ends``, and whether the anchor recurs inside."""
    n = len(data) - sizes.length + 1
    if n <= 0:
        return None
    sums = _sums(data)
    grams = _grams(sums, sizes.gram)
    anchor = _least(grams, sizes.length - sizes.gram + 1)
    # strings that lie in one text
    inside = np.ones(n + sizes.length, bool)
    inside[ragged(np.maximum(ends - sizes.length + 1, 0), np.minimum(ends, sizes.length - 1))] = False
    inside = inside[:n]
    change = anchor[1:] != anchor[:-1]
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= change | ~inside[:-1]
    finishes[:-1] &= change | ~inside[1:]
    start = np.flatnonzero(begins)
    if not len(start):
        return None
    strings = np.flatnonzero(finishes) - start + 1
    pieces = -(-strings // STRETCH)
    part = ragged(np.zeros(len(start), np.int64), pieces)
    end = np.repeat(start + strings, pieces)
    start = np.repeat(start, pieces) + part * STRETCH
    end = np.minimum(end, start + STRETCH) + sizes.length - 1
    # two equal strings in one stretch: the first begins no later than its anchor, which the second has behind it
    recur = np.flatnonzero((grams[:n] == anchor) & inside)
    which = np.searchsorted(start, recur, "right") - 1
    twice = np.zeros(len(start), bool)
    twice[which[recur < end[which] - sizes.length]] = True
    return anchor[start], _hashes(sums, start, end), start, end, twice


def _slices(data: np.ndarray, offsets: np.ndarray, overlap: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """Pieces of whole rows, or of one long row: rows ``a`` to ``b``, the bytes, the rows' ends and the first byte's place."""
    for a, b in chunks(offsets, SLICE):
        lo, hi = int(offsets[a]), int(offsets[b])
        if hi - lo <= 2 * SLICE:
            yield a, b, data[lo:hi], offsets[a + 1 : b + 1] - lo, lo
            continue
        for at in range(lo, hi, SLICE):
            to = min(hi, at + SLICE + overlap)
            yield a, b, data[at:to], np.array([to - at], np.int64), at
            if to == hi:
                break


def entry_finder(sizes: Sizes):
    """``key, check, text`` to ``anchor, seg, key, at`` of every stretch of every text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _binary(batch.column("text"))
            keys = batch.column("key").to_numpy()
            checks = batch.column("check").to_numpy().astype(np.int64)
            for a, b, part, ends, lo in _slices(data, offsets, sizes.length - 1):
                found = _stretches(part, ends, sizes)
                if found is None:
                    continue
                anchor, seg, start, end, twice = found
                row = a + np.searchsorted(ends, start, "right") if b - a > 1 else np.full(len(start), a)
                at = (checks[row] << 43) | ((start + lo - offsets[row]) << 12) | (twice.astype(np.int64) << 11) | (end - start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(seg.view(np.int64)), pa.array(keys[row]), pa.array(at)],
                    names=["anchor", "seg", "key", "at"],
                )

    return find


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, memoryview, list[dict]]]:
    """Texts with the stretches wanted of them: each different text of a task once."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        for i in range(batch.num_rows):
            key, check = batch.column("key")[i].as_py(), batch.column("check")[i].as_py()
            if (key, check) in seen:
                continue
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen.add((key, check))
            text = memoryview(batch.column("text")[i].as_buffer())
            mine = [w for w in batch.column("wanted")[i].as_py() if w["at"] >> 43 == check]
            yield key, text, [w for w in mine if (w["at"] >> 12 & 0x7FFFFFFF) + (w["at"] & 0x7FF) <= len(text)]


_STRETCH_SCHEMA = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("n", pa.int64()), ("body", pa.binary())])


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``anchor, seg, n, body`` of the wanted stretches."""
    rows: list[tuple] = []
    size = 0
    for _, text, wanted in _wanted(batches):
        for w in wanted:
            start, length = w["at"] >> 12 & 0x7FFFFFFF, w["at"] & 0x7FF
            rows.append((w["anchor"], w["seg"], w["n"], bytes(text[start : start + length])))
            size += length
            if size >= SLICE:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _STRETCH_SCHEMA.types)], schema=_STRETCH_SCHEMA)
                rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _STRETCH_SCHEMA.types)], schema=_STRETCH_SCHEMA)


_PARTS = "anchor bigint, seg bigint, key bigint, at bigint, n bigint, of_anchor bigint, of_seg bigint, off int"


def band_splitter(sizes: Sizes, width: int):
    """The wanted stretches in parts: strings with their anchor in one band of ``width`` places, dealt by what they share."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, text, wanted in _wanted(batches):
            for w in wanted:
                start, length = w["at"] >> 12 & 0x7FFFFFFF, w["at"] & 0x7FF
                sums = _sums(np.frombuffer(text[start : start + length], np.uint8))
                grams = _grams(sums, sizes.gram)
                n = length - sizes.length + 1
                places = np.flatnonzero(grams == grams[: sizes.length - sizes.gram + 1].min())
                string = np.arange(n)
                # the first anchor in each string, and the band of places that it is in
                place = places[np.searchsorted(places, string)]
                band = (place - string) // width
                begins = np.flatnonzero(np.append(True, (np.diff(place) != 0) | (np.diff(band) != 0)))
                ends = np.append(begins[1:], n) + sizes.length - 1
                place, band = place[begins], band[begins]
                shared = place - width * band
                anchor = _hashes(sums, shared, shared - width + 1 + sizes.length)
                anchor = mix(mix(anchor + band.astype(np.uint64)) + np.uint64(width))
                at = (w["at"] >> 43 << 43) | ((start + begins) << 12) | (ends - begins)
                m = len(begins)
                columns = [anchor.view(np.int64), _hashes(sums, begins, ends).view(np.int64), np.full(m, key), at, np.full(m, w["n"])]
                columns += [np.full(m, w["anchor"]), np.full(m, w["seg"]), begins.astype(np.int32)]
                names = ["anchor", "seg", "key", "at", "n", "of_anchor", "of_seg", "off"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return split


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Different stretches in order of anchor, cut between anchors where a block is full."""
    rows: list[tuple[int, int, int, bytes]] = []
    size = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("anchor", "seg", "n", "body")]
        for row in zip(*columns):
            if rows and row[0] == rows[-1][0]:
                if row[1] == rows[-1][1] and row[3] == rows[-1][3]:
                    continue
            else:
                if rows and size >= BLOCK_BYTES:
                    yield rows
                    rows, size = [], 0
            rows.append(row)
            size += len(row[3])
    if rows:
        yield rows


_FOUND = "anchor bigint, seg bigint, spans array<struct<a: int, b: int>>"
_FOUND_SCHEMA = pa.schema(
    [("anchor", pa.int64()), ("seg", pa.int64()), ("spans", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))]
)


def index_blocks(sizes: Sizes):
    """Builds the indexes: ``anchor, seg, spans`` of the stretches that hold a repeated string."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            counts = np.array([r[2] for r in rows], np.int64)
            row, start, end = repeated_spans([r[3] for r in rows], counts, sizes.length)
            if not len(row):
                continue
            spans: dict[int, list[dict]] = {}
            for i, a, b in zip(row.tolist(), start.tolist(), end.tolist()):
                spans.setdefault(i, []).append({"a": a, "b": b})
            columns = [[rows[i][0] for i in spans], [rows[i][1] for i in spans], list(spans.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _FOUND_SCHEMA.types)], schema=_FOUND_SCHEMA)

    return find


def _wanted_of(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """Texts with the list of ``entries`` to cut from each; a list is no longer than its text."""
    lists = entries.groupBy("key").agg(F.collect_list(F.struct("anchor", "seg", "at", "n")).alias("wanted"))
    return texts.join(lists, "key").select("key", "check", "text", "wanted")


def _hot(different: DataFrame, sizes: Sizes) -> DataFrame | None:
    """The anchors of too many different stretches, if there are any."""
    found = materialize(different.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > sizes.hot).select("anchor"))
    return None if found.isEmpty() else found


def _split(texts: DataFrame, different: DataFrame, sizes: Sizes) -> tuple[DataFrame, list[DataFrame]]:
    """Stretches of anchors that are not hot, or their parts; and the tables that say whose parts they are, coarse ones first."""
    ready, tables = [], []
    for width in sizes.bands:
        hot = _hot(different, sizes)
        if hot is None:
            break
        ready.append(different.join(hot, "anchor", "left_anti"))
        parts = materialize(_wanted_of(texts, different.join(hot, "anchor", "left_semi")).mapInArrow(band_splitter(sizes, width), _PARTS))
        tables.append(parts)
        several = parts.groupBy("anchor").agg(F.sum("n").alias("m")).where("m > 1").select("anchor")
        different = materialize(
            parts.join(several, "anchor", "left_semi")
            .groupBy("anchor", "seg")
            .agg(F.min(F.struct("key", "at")).alias("place"), F.sum("n").alias("n"))
            .select("anchor", "seg", "place.key", "place.at", "n")
        )
    return reduce(DataFrame.unionByName, [*ready, different]), tables


def _joined(found: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Spans of parts brought back to the stretches that they are parts of, fine ones first."""
    for parts in reversed(tables):
        # a part stands there once for each copy in a task that its stretch was cut from
        own = parts.select("anchor", "seg", "of_anchor", "of_seg", "off").distinct()
        spans = own.join(found, ["anchor", "seg"]).select("of_anchor", "of_seg", "off", F.explode("spans").alias("s"))
        spans = spans.select("of_anchor", "of_seg", F.struct((F.col("s.a") + F.col("off")).alias("a"), (F.col("s.b") + F.col("off")).alias("b")).alias("s"))
        back = spans.groupBy(F.col("of_anchor").alias("anchor"), F.col("of_seg").alias("seg")).agg(F.collect_list("s").alias("spans"))
        found = materialize(found.unionByName(back))
    return found


def repeated(documents: DataFrame, text: str = "text", sizes: Sizes = Sizes()) -> DataFrame:
    """``key, check, spans``: stretches of bytes to remove, which may overlap, of each different text that has any."""
    texts = _texts(documents, text)
    entries = texts.mapInArrow(entry_finder(sizes), _ENTRY)
    counts = entries.groupBy("anchor").agg(F.sum(F.shiftright("at", 11).bitwiseAND(1) + 1).alias("n")).where("n > 1")
    candidates = materialize(entries.join(counts.select("anchor"), "anchor").select(*entries.columns))
    different = materialize(
        candidates.groupBy("anchor", "seg")
        .agg(F.min(F.struct("key", "at")).alias("place"), F.count(F.lit(1)).alias("n"))
        .select("anchor", "seg", "place.key", "place.at", "n")
    )
    wanted, tables = _split(texts, different, sizes)
    bodies = _wanted_of(texts, wanted).mapInArrow(cut, "anchor bigint, seg bigint, n bigint, body binary")
    found = bodies.repartition("anchor").sortWithinPartitions("anchor", "seg").mapInArrow(index_blocks(sizes), _FOUND)
    if tables:
        found = _joined(materialize(found), tables)
    start = F.shiftrightunsigned("at", 12).bitwiseAND(0x7FFFFFFF).cast("int")
    spans = (
        candidates.join(found, ["anchor", "seg"])
        .select("key", F.shiftrightunsigned("at", 43).cast("int").alias("check"), start.alias("start"), F.explode("spans").alias("s"))
        .select("key", "check", F.struct((F.col("start") + F.col("s.a")).alias("a"), (F.col("start") + F.col("s.b")).alias("b")).alias("s"))
    )
    return spans.groupBy("key", "check").agg(F.collect_set("s").alias("spans"))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remover(with_bytes: bool):
    """``row, text, spans`` to ``row``, sizes and the bytes that stay, or their SHA-256 in hex."""
    last = pa.binary() if with_bytes else pa.string()
    names = ["row", "n_bytes", "n_removed", "n_spans", "kept"]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, spans in zip(batch.column("text"), batch.column("spans")):
                body = memoryview(body.as_buffer())
                spans = _merged(spans.as_py()) if spans.is_valid else []
                edges = [0, *(x for s in spans for x in s), len(body)]
                pieces = [body[a:b] for a, b in zip(edges[::2], edges[1::2])]
                if with_bytes:
                    kept = b"".join(pieces)
                else:
                    digest = hashlib.sha256()
                    for piece in pieces:
                        digest.update(piece)
                    kept = digest.hexdigest()
                out.append((len(body), sum(b - a for a, b in spans), len(spans), kept))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), last))] if out else []
            if out:
                yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], names=names)

    return remove


def remove_repeats(documents: DataFrame, text: str = "text", with_bytes: bool = True, sizes: Sizes = Sizes()) -> DataFrame:
    """``documents`` with ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), and ``kept``, the bytes that stay
    (a character may be cut); without ``with_bytes`` their SHA-256 in hex as ``kept_sha256``."""
    found = repeated(documents, text, sizes)
    rows = packed(documents, text=F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = rows.withColumns({"key": F.xxhash64("text"), "check": F.crc32("text").bitwiseAND((1 << 20) - 1).cast("int")})
    joined = rows.join(found.hint("merge"), ["key", "check"], "left").select("row", F.col("text").cast("binary"), "spans")
    schema = T.StructType([rows.schema["row"], *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans"))])
    done = joined.mapInArrow(remover(with_bytes), schema.add("kept", T.BinaryType() if with_bytes else T.StringType()))
    names = {"n_bytes": "n_bytes", "n_removed": "n_removed", "n_spans": "n_spans", "kept": "kept" if with_bytes else "kept_sha256"}
    return done.select("row.*", *[F.col(c).alias(free(name, documents.columns)) for c, name in names.items()])


#: every string by its own hash, cut from blocks of 200 bytes in hex so that none is searched for from a text's start
ORACLE = f"""
WITH t AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), blocks AS (
  SELECT r, regexp_extract_all(h, '.{{1,{2 * LENGTH}}}') AS parts, length(h) // 2 AS n FROM t WHERE length(h) >= {2 * LENGTH}
), strings AS MATERIALIZED (
  SELECT r, u.i, md5(substr(parts[u.i // {LENGTH} + 1] || coalesce(parts[u.i // {LENGTH} + 2], ''), 2 * (u.i % {LENGTH}) + 1, {2 * LENGTH})) AS k
  FROM blocks, LATERAL (SELECT unnest(range(0, n - {LENGTH - 1})) AS i) u
), again AS (
  SELECT r, i FROM strings WHERE k IN (SELECT k FROM strings GROUP BY k HAVING count(*) > 1)
), islands AS (
  SELECT r, i, sum(CASE WHEN i - before <= {LENGTH} THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS island
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM again)
), spans AS MATERIALIZED (
  SELECT r, min(i) AS a, max(i) + {LENGTH} AS b FROM islands GROUP BY r, island
), pieces AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS lo, a AS hi FROM spans
  UNION ALL
  SELECT t.r, coalesce(max(s.b), 0), any_value(length(t.h)) // 2 FROM t LEFT JOIN spans s ON s.r = t.r GROUP BY t.r
), kept AS (
  SELECT p.r, string_agg(substr(t.h, 2 * p.lo + 1, 2 * (p.hi - p.lo)), '' ORDER BY p.lo) AS h FROM pieces p JOIN t ON t.r = p.r GROUP BY p.r
), sums AS (
  SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r
)
SELECT t.doc_id, (length(t.h) // 2)::BIGINT AS n_bytes, coalesce(s.n_removed, 0)::BIGINT AS n_removed,
       coalesce(s.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(k.h)) AS kept_sha256
FROM t JOIN kept k ON k.r = t.r LEFT JOIN sums s ON s.r = t.r
"""
