"""Archives: payloads survive, equal ones become revisits."""

import base64
import gzip
import hashlib

import pytest

from basketry.llm import warc
from basketry.session import new_table_path

SCHEMA = "page_id long, url string, html string, file string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_pages(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 3)
    tricky = "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\nWARC/1.1"
    pages = [(i, f"http://h/{i}", f"<p>é{i % 4}</p>") for i in range(9)]
    pages += [(20, None, None), (21, "a\r\nb", ""), (22, "u", tricky), (23, "u", "x" * 300_000), (None, "u", "<p>é1</p>"), (24, "", tricky)]
    df = spark.createDataFrame([(*p, "f") for p in pages], SCHEMA).repartition(3)
    got = {r["page_id"]: r for r in warc.deduplicate_pages(df).collect()}
    assert len(got) == len(pages)
    best = {}
    for i, _, html in pages:
        best[html or ""] = max(best.get(html or "", -1), -1 if i is None else i)
    for i, _, html in pages:
        first = best[html or ""]
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len((html or "").encode()), digest(html))
        assert (got[i]["record_type"], got[i]["refers_to"]) == (("response", None) if i == first else ("revisit", first))
    small = {r["page_id"]: r["record_type"] for r in warc.deduplicate_pages(df, least_bytes=100).collect()}
    assert set(small.values()) == {"response"}


def test_repeated_rows_and_files(spark):
    df = spark.createDataFrame([(1, "u", "same", "f")] * 4, SCHEMA)
    folder = new_table_path(spark)
    got = warc.deduplicate_pages(df, folder=folder).collect()
    assert sorted(r["record_type"] for r in got) == ["response"] + ["revisit"] * 3
    files = spark.read.format("binaryFile").load(f"{folder}/*.gz").collect()
    records = [r for f in files for r in warc.parse(bytes(f["content"]))]
    assert sorted(payload for _, payload in records) == [b"", b"", b"", b"same"]
    fields = next(f for f, p in records if not p)
    assert fields["WARC-Profile"] == warc.PROFILE and fields["WARC-Payload-Digest"] == f"sha1:{digest('same')}"
    assert fields["WARC-Refers-To"] in {f["WARC-Record-ID"] for f, p in records if p}


def test_empty_and_broken(spark):
    assert warc.deduplicate_pages(spark.createDataFrame([], SCHEMA)).count() == 0
    import gzip

    with pytest.raises(ValueError):
        list(warc.parse(gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n")))
    with pytest.raises(ValueError):
        list(warc.parse(gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")))


def given(kind, number, payload=b"", digest_of=None, refers=None):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    named = base64.b32encode(hashlib.sha1(payload if digest_of is None else digest_of).digest()).decode()
    fields = {
        "WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{number}>", "WARC-Target-URI": f"http://h/{number}", "Page-ID": str(number),
        "WARC-Payload-Digest": f"sha1:{named}", "Content-Length": str(len(block)),
    }
    if refers is not None:
        fields |= {"WARC-Refers-To": f"<urn:uuid:{refers}>", "Refers-To-Page-ID": str(refers)}
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items()) + b"\r\n" + block + b"\r\n\r\n"


def test_archives_that_hold_revisits_and_binary_payloads(spark, tmp_path):
    picture = bytes(range(256)) + b"\x89PNG\r\n\x1a\n\r\n\r\n\xff\xfe"
    records = [
        given("response", 1, picture), given("revisit", 2, digest_of=picture, refers=1), given("response", 3, picture),
        given("response", 4, b"alone"), given("revisit", 5, digest_of=b"alone", refers=4),
        given("revisit", 6, digest_of=b"nowhere", refers=99), given("revisit", 7, digest_of=picture, refers=1),
    ]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join(records[:3])))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(b"".join(records[3:])))
    headers = warc.read_archives(spark, str(tmp_path))
    folder = new_table_path(spark)
    warc.write_resolved(spark, str(tmp_path), warc.resolve_revisits(headers), folder, "1970-01-01T00:00:00Z")
    back = {r["page_id"]: r for r in warc.read_archives(spark, folder).collect()}
    kinds = {i: (r["record_type"], r["refers_to"]) for i, r in back.items()}
    assert kinds == {
        1: ("revisit", 3), 2: ("revisit", 3), 3: ("response", None), 4: ("response", None), 5: ("revisit", 4), 6: ("revisit", 99), 7: ("revisit", 3),
    }
    assert back[2]["refers_to_id"] == back[3]["record_id"] and back[6]["refers_to_id"] == "<urn:uuid:99>"
    assert {back[i]["payload_digest"] for i in (1, 2, 3, 7)} == {base64.b32encode(hashlib.sha1(picture).digest()).decode()}
    files = spark.read.format("binaryFile").load(f"{folder}/*.gz").collect()
    payloads = sorted(p for f in files for _, p in warc.parse(bytes(f["content"])) if p)
    assert payloads == sorted([picture, b"alone"])


def test_files_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 16)
    monkeypatch.setattr(warc, "FILE_BYTES", 16 * 64)
    pages = [(i, "u", "s" * 60 + str(i)) for i in range(40)] + [(100 + i, "u", f"{i:03}" * 300) for i in range(6)] + [(200, "u", "x" * 20_000)]
    folder = new_table_path(spark)
    got = warc.deduplicate_pages(spark.createDataFrame([(*p, "f") for p in pages], SCHEMA).coalesce(1), folder=folder).collect()
    assert sorted((r["page_id"], r["payload_bytes"]) for r in got) == [(i, len(h)) for i, _, h in pages]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(folder).collect()
    for f in files:
        sizes = [len(p) for _, p in warc.parse(bytes(f["content"]))]
        assert len(sizes) == 1 or (len(sizes) <= 16 and sum(sizes) <= 16 * 64)
