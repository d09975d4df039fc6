"""Archive round trips: records byte for byte, references, verification."""

import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dimforge.llm import archive, files

BIG = "<p>" + "payload " * 30
PAGES = [(5, "http://a/", BIG), (2, "http://b/\r\nX: y", BIG), (9, None, BIG), (3, "http://c/", "short"), (4, "u", "short"),
         (7, "u", None), (8, "u", ""), (1, "u", "é" * 60), (6, "u", "x" * 100), (10, "u", "x" * 100), (11, "u", "y" * 99),
         (12, "u", "y" * 99), (13, "long", "z" * 300_000)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id bigint, url string, html string")


def expected(rows):
    out, first = {}, {}
    for page_id, _, html in sorted(rows):
        body = (html or "").encode()
        first.setdefault(body, page_id)
        again = len(body) >= 100 and first[body] != page_id
        out[page_id] = (len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response",
                        first[body] if again else None)
    return out


def test_facts_equal_brute_force(pages, with_clashes):
    for df in (pages, with_clashes(pages.repartition(4), "digest", "payload", "row", "first", "header", "n_bytes")):
        got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
               for r in archive.facts(archive.write_archive(df)).collect()}
        assert got == expected(PAGES)


def test_payloads_are_stored_once_and_records_come_back_whole(spark, pages):
    written = archive.write_archive(pages)
    assert written.payloads.count() == len({html or "" for _, _, html in PAGES})
    want = expected(PAGES)
    for r in archive.reconstruct(written).collect():
        record, html = bytes(r.record), {p: (h or "").encode() for p, _, h in PAGES}[r.page_id]
        head, _, body = record.partition(b"\r\n\r\n")
        lines = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert bytes(r.payload) == html
        kept = b"" if want[r.page_id][2] == "revisit" else html
        assert body == kept + b"\r\n\r\n" and int(lines[b"Content-Length"]) == len(kept)
        assert lines[b"WARC-Payload-Digest"] == b"sha256:" + hashlib.sha256(html).hexdigest().encode()
        assert b"X" not in lines  # a line break in a url begins no header line
    made = archive.export_warc(spark, written).collect()
    size = {r.path: len(files.get(r.path)) for r in made}
    assert all(size[r.path] == r.n_bytes for r in made) and sum(r.n_records for r in made) == len(PAGES)


def test_damage_is_found(spark, pages):
    written = archive.write_archive(pages)
    damaged = written.payloads.withColumn("payload", F.when(F.col("n_bytes") == 100, F.lit(b"x" * 99 + b"!")).otherwise(F.col("payload")))
    with pytest.raises(PySparkException):
        archive.facts(archive.Archive(damaged, written.records)).collect()


def test_repeated_rows_null_ids_and_empty(spark):
    rows = [(1, "u", BIG), (1, "u", BIG), (None, "u", BIG), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = [tuple(r) for r in archive.facts(archive.write_archive(df)).collect()]
    kinds = sorted((str(r[0]), r[3], str(r[4])) for r in got)
    assert kinds == [("1", "response", "None"), ("1", "revisit", "1"), ("None", "response", "None"), ("None", "revisit", "1")]
    empty = archive.write_archive(df.limit(0))
    assert archive.facts(empty).count() == archive.reconstruct(empty).count() == 0
