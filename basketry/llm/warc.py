"""WARC archives with revisit records for repeated payloads.

Pages are written as response records, the archives read back, headers shuffled by payload digest, and a second
set of archives written with fresh headers: of equal payloads the record of the largest page id stays a response,
the others become revisit records that refer to it and carry no payload. Archives may hold revisit records already: they
are joined to the responses by digest and refer to the one that stays; where none has the digest, they stay as they are.

Archives are gzip-compressed WARC/1.1 files that Spark's own writer commits, so a lost executor's attempt leaves
nothing behind and any store that Spark reaches will do; a record is one line of the text writer, whose line end is the
record's end (two CRLF). They are read back as binary files by Content-Length, never by searching for line ends. Payloads are
bytes throughout, of any kind. A file holds ``RECORDS_PER_FILE`` records and ``FILE_BYTES`` of payload at most, or one record: larger
payloads are written apart, by powers of 16 of their size, with fewer records to a file. So the task that reads a file holds it
compressed, and one payload.

A null payload is empty; a null page id stays null and is smaller than all others; a null URL has no header; line ends
in URLs are percent-encoded. Repeated rows are records of their own: one of them, the last written, is the response.
Columns other than ``page_id, url, html`` are ignored. Empty tables give empty archives and results.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import discard, materialize, new_table_path

RECORDS_PER_FILE = 4096
FILE_BYTES = 256 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_HEADERS = (
    "file string, at long, record_id string, record_type string, page_id long, url string, "
    "refers_to_id string, refers_to long, payload_bytes long, payload_digest string"
)
_NAMES = [f.split()[0] for f in _HEADERS.split(", ")]


def record(record_type: Column, record_id: Column, date: str, block: Column, **fields: Column) -> Column:
    """The text of a record up to its closing line ends; fields that are null are left out."""
    named = [F.lit("WARC/1.1")]
    for name, value in {
        "WARC-Type": record_type,
        "WARC-Record-ID": record_id,
        "WARC-Date": F.lit(date),
        **{k.replace("_", "-"): v for k, v in fields.items()},
        "Content-Type": F.lit("application/http; msgtype=response"),
        "Content-Length": F.octet_length(block).cast("string"),
    }.items():
        named.append(F.concat(F.lit(f"{name}: "), value))
    return F.concat(F.concat_ws("\r\n", *named), F.lit("\r\n\r\n"), block)


def record_id(*parts: Column) -> Column:
    """A record id made from its parts, so that a repeated task writes the same."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _class(size: Column) -> Column:
    """0 for payloads of which a full file holds ``RECORDS_PER_FILE``, then one more for each factor of 16."""
    small = FILE_BYTES // RECORDS_PER_FILE
    return F.greatest(F.lit(0), F.ceil(F.log(F.greatest(size, F.lit(1)) / small) / F.log(F.lit(16.0)))).cast("int")


def write_archives(records: DataFrame, folder: str, size_class: int = 0) -> None:
    """``records``: one column ``value`` from :func:`record`, payloads of one class of sizes."""
    (
        records.select("value")
        .write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        # a third of the default level's time for an eighth more bytes
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", max(1, RECORDS_PER_FILE // 16**size_class))
        .text(f"{folder}/size={size_class}" if size_class else folder)
    )


def _classes(sizes: DataFrame) -> list[int]:
    """The classes that occur, a handful at most; an empty table has the first."""
    return sorted(r[0] for r in sizes.select(_class(F.col("size"))).distinct().collect()) or [0]


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and payload of each record of one compressed archive."""
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as archive:
        while line := archive.readline():
            if line == b"\r\n":
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError("not at the start of a record")
            fields = {}
            while (line := archive.readline()) not in (b"\r\n", b""):
                name, _, value = line[:-2].decode("utf-8").partition(": ")
                fields[name] = value
            block = archive.read(int(fields["Content-Length"]))
            if len(block) != int(fields["Content-Length"]):
                raise ValueError("the archive ends inside a record")
            yield fields, block.partition(b"\r\n\r\n")[2]


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz")
    return reader.load(folder).select("path", "content")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records' headers; a response's length and digest are taken from its payload."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                for at, (fields, payload) in enumerate(parse(content)):
                    found = fields["WARC-Type"] == "response"
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    rows.append(
                        (
                            path,
                            at,
                            fields["WARC-Record-ID"],
                            fields["WARC-Type"],
                            _number(fields.get("Page-ID")),
                            fields.get("WARC-Target-URI"),
                            fields.get("WARC-Refers-To"),
                            _number(fields.get("Refers-To-Page-ID")),
                            len(payload) if found else None,
                            digest if found else fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                        )
                    )
                whole = {k: "Int64" for k in ("at", "page_id", "refers_to", "payload_bytes")}
                yield pd.DataFrame(rows, columns=_NAMES).astype(whole)

    return _files(spark, folder).mapInPandas(records, _HEADERS)


def archive_pages(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``pages`` (``page_id``, ``url``, ``html``) as response records."""
    html = F.coalesce("html", F.lit(""))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    page = F.col("page_id").cast("string")
    value = record(
        F.lit("response"),
        record_id(F.lit("crawl"), page, F.col("url"), F.sha1(html)),
        date,
        F.concat(F.lit(_HTTP), html),
        WARC_Target_URI=url,
        Page_ID=page,
    )
    size = F.octet_length(html).alias("size")
    for size_class in _classes(pages.select(size)):
        write_archives(pages.where(_class(size) == size_class).select(value.alias("value")), folder, size_class)


def resolve_revisits(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Per header: ``file, at, fresh_id, record_type, refers_to_id, refers_to``, by payload digest and length.

    A given revisit refers to the response that stays, or, if none has its digest, to what it referred to.
    """
    fresh = record_id(F.lit("resolved"), F.col("page_id"), F.col("payload_digest"), F.col("at"), F.col("file"))
    headers = headers.withColumn("fresh_id", fresh)
    responses, given = headers.where("record_type = 'response'"), headers.where("record_type != 'response'")
    same = ["payload_digest", "payload_bytes"]
    groups = responses.groupBy(*same).agg(
        F.max(F.struct("page_id", "file", "at", "fresh_id")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    originals = groups.where((F.col("payload_bytes") >= least_bytes) & (F.col("n") > 1)).drop("n")
    again = F.col("first").isNotNull() & (F.col("first.fresh_id") != F.col("fresh_id"))
    names = ["file", "at", "page_id", "url", "fresh_id", "payload_digest", "payload_bytes"]
    decided = responses.join(originals, same, "left").select(
        *names,
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first.fresh_id")).alias("refers_to_id"),
        F.when(again, F.col("first.page_id")).alias("refers_to"),
    )
    # given revisits know the digest alone: length and id are the original's
    by_digest = groups.groupBy("payload_digest").agg(F.max(F.struct("first", F.col("payload_bytes").alias("bytes"))).alias("g"))
    found = F.col("g").isNotNull()
    revisits = given.join(by_digest, "payload_digest", "left").select(
        *names[:-1],
        F.col("g.bytes").alias("payload_bytes"),
        F.lit("revisit").alias("record_type"),
        F.when(found, F.col("g.first.fresh_id")).otherwise(F.col("refers_to_id")).alias("refers_to_id"),
        F.when(found, F.col("g.first.page_id")).otherwise(F.col("refers_to")).alias("refers_to"),
    )
    return decided.unionByName(revisits)


def write_resolved(spark: SparkSession, crawl: str, resolved: DataFrame, folder: str, date: str) -> None:
    """Write the archives of ``crawl`` anew: fresh headers, payloads of responses only.

    Decisions meet their records file by file, as lists of ``RECORDS_PER_FILE`` at most, so the shuffle carries
    compressed archives and not payloads.
    """
    names = ["at", "page_id", "url", "fresh_id", "record_type", "payload_digest", "refers_to_id", "refers_to"]
    fields = ", ".join(f"{n} {resolved.schema[n].dataType.simpleString()}" for n in names)

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(rows: list[tuple]) -> pd.DataFrame:
            whole = {k: "Int64" for k in ("at", "page_id", "refers_to")}
            return pd.DataFrame(rows, columns=[*names, "payload"]).astype(whole)

        for batch in batches:
            for content, decisions in zip(batch["content"], batch["decided"], strict=True):
                rows, held = [], 0
                wanted = {d["at"]: d for d in decisions}
                for at, (_, payload) in enumerate(parse(content)):
                    if (decision := wanted.pop(at, None)) is None:
                        continue
                    kept = payload if decision["record_type"] == "response" else b""
                    rows.append((*[decision[n] for n in names], kept))
                    held += len(kept)
                    if held > 4 << 20:
                        yield frame(rows)
                        rows, held = [], 0
                if wanted:
                    raise ValueError("decisions on records that the archive does not have")
                yield frame(rows)

    revisit = F.col("record_type") == "revisit"
    value = record(
        F.col("record_type"),
        F.col("fresh_id"),
        date,
        # the bytes as they are: a cast to text keeps them, whatever they are
        F.concat(F.lit(_HTTP), F.col("payload").cast("string")),
        WARC_Target_URI=F.col("url"),
        Page_ID=F.col("page_id").cast("string"),
        WARC_Payload_Digest=F.concat(F.lit("sha1:"), F.col("payload_digest")),
        WARC_Profile=F.when(revisit, PROFILE),
        WARC_Refers_To=F.col("refers_to_id"),
        Refers_To_Page_ID=F.col("refers_to").cast("string"),
    )
    kept = F.when(revisit, 0).otherwise(F.col("payload_bytes")).alias("size")
    for size_class in _classes(resolved.select(kept)):
        decided = resolved.where(_class(kept) == size_class).groupBy("file").agg(F.collect_list(F.struct(*names)).alias("decided"))
        files = _files(spark, crawl).join(decided, F.col("path") == F.col("file")).select("content", "decided")
        write_archives(files.mapInPandas(rewrite, f"{fields}, payload binary").select(value.alias("value")), folder, size_class)


def deduplicate_pages(
    pages: DataFrame, least_bytes: int = 0, folder: str | None = None, date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """Archive, resolve, archive anew below ``folder``, and describe each page's record as read back from there."""
    spark = pages.sparkSession
    crawl, folder = new_table_path(spark), folder or new_table_path(spark)
    archive_pages(pages, crawl, date)
    headers = materialize(read_archives(spark, crawl))
    resolved = materialize(resolve_revisits(headers, least_bytes))
    write_resolved(spark, crawl, resolved, folder, date)
    records = materialize(read_archives(spark, folder))
    responses = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("payload_bytes").alias("full")
    )
    discard(headers, resolved)
    return records.join(responses, "refers_to_id", "left").select(
        "page_id",
        F.coalesce("payload_bytes", "full").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
