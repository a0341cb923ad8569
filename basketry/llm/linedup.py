"""Repeated passages of lines: overlapping windows of three, later occurrences removed.

Every three consecutive lines of a text (split at line feeds) are hashed, and a window that occurs again anywhere is kept
where it comes first, by ``doc_id`` (nulls first; equal ids by their text's hash) and line. All positions that later
occurrences cover are merged and removed. Where a later occurrence overlaps the first of its own hash, the shared
lines stay. Texts of under three lines have no window and stay as they are.

Windows are shuffled as 16-byte hashes with positions, combined in each task before; texts are shuffled once,
to meet the positions they lose. Null texts stay null; rows of equal id and text are one document and
get the same result. Columns other than id and text pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm._columns import free, packed
from basketry.session import materialize

LINES = 3


def _key(text: str) -> Column:
    """Identity of a document: its id and text."""
    return F.unhex(F.md5(F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(text))))


def _once(array: Column, then: Callable[[Column], Column]) -> Column:
    """``then(array)``, the array bound to a name, so that it isn't computed again for each element of another."""
    return F.get(F.transform(F.array(array), then), 0)


def removed_positions(documents: DataFrame, text: str = "text") -> DataFrame:
    """``key, removed`` (sorted positions of lines, from 0) of the documents that lose lines."""
    lines = documents.select("doc_id", _key(text).alias("key"), F.split(text, "\n", -1).alias("lines"))

    def hashes(lines: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(lines) - LINES)
        return F.transform(starts, lambda i: F.md5(F.concat_ws("\n", F.slice(lines, i + 1, LINES))))

    lines = lines.where(F.size("lines") >= LINES)
    windows = lines.select("doc_id", "key", F.posexplode(_once(F.col("lines"), hashes)).alias("at", "window"))
    windows = materialize(windows.withColumn("window", F.unhex("window")))
    firsts = (
        windows.groupBy("window")
        .agg(F.min(F.struct("doc_id", "key", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    later = windows.join(firsts, "window").where("key != first.key OR at != first.at")
    kept = F.when(F.col("key") == F.col("first.key"), F.col("first.at") + LINES).otherwise(0)
    covered = later.select(
        "key", F.explode(F.sequence(F.greatest(F.col("at"), kept), F.col("at") + LINES - 1)).alias("at")
    )
    return covered.groupBy("key").agg(F.array_sort(F.collect_set("at")).alias("removed"))


def remove_repeated_lines(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` without repeated passages, with ``n_lines`` and ``n_removed`` added (underscores behind them if taken)."""
    removed = materialize(removed_positions(documents, text))
    rows = packed(documents, key=_key(text), lines=F.split(text, "\n", -1))

    def left(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed"))
        return F.array_join(F.transform(places, lambda at: F.get(lines, at)), "\n")

    # a sorted merge at every size: broadcast plans for few removals would change the plan with the data
    joined = rows.join(removed.hint("merge"), "key", "left")
    cleaned = F.when(F.col("removed").isNull(), F.col("row")[text]).otherwise(_once(F.col("lines"), left))
    return joined.select(
        *[cleaned.alias(c) if c == text else F.col("row")[c].alias(c) for c in documents.columns],
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias(free("n_lines", documents.columns)),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias(free("n_removed", documents.columns)),
    )


ORACLE = """
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), windows AS (
  SELECT doc_id, u.spot, array_to_string(lines[u.spot + 1 : u.spot + 3], chr(10)) AS body
  FROM lines, LATERAL (SELECT unnest(range(0, len(lines) - 2)) AS spot) u
), ranked AS (
  SELECT doc_id, spot, first_value(doc_id) OVER w AS first_doc, first_value(spot) OVER w AS first_spot
  FROM windows WINDOW w AS (PARTITION BY body ORDER BY doc_id, spot)
), covered AS (
  SELECT DISTINCT doc_id, p.pos
  FROM ranked, LATERAL (SELECT unnest(range(
         CASE WHEN doc_id = first_doc THEN greatest(spot, first_spot + 3) ELSE spot END, spot + 3)) AS pos) p
  WHERE doc_id <> first_doc OR spot <> first_spot
), removed AS (
  SELECT doc_id, list(pos) AS positions FROM covered GROUP BY doc_id
), kept AS (
  SELECT l.doc_id, l.lines, l.text, coalesce(len(r.positions), 0)::BIGINT AS n_removed,
         CASE WHEN r.positions IS NULL THEN l.text ELSE array_to_string(
           [lines[i + 1] FOR i IN range(0, len(lines)) IF NOT list_contains(r.positions, i)], chr(10)) END AS cleaned
  FROM lines l LEFT JOIN removed r ON l.doc_id = r.doc_id
)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, n_removed, sha256(cleaned) AS cleaned_sha256 FROM kept
"""
