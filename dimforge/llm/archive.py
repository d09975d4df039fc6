"""Content-addressed WARC archive.

Payload bytes are stored once, under their SHA-256.  Record headers are kept
by themselves, byte for byte, with the digest of the payload they describe.
A WARC record is the header and the payload behind it; joining the two tables
by digest gives back the records, whole.

    payloads  digest, n_bytes, payload                    one row a digest
    records   page_id, digest, header                     one row a page

Of pages with equal payloads of at least ``LEAST`` bytes, that with the
smallest page_id is a response, the others are revisits that refer to it;
smaller payloads are always responses.  Equal digests are verified: a second,
independent hash and the length must agree over all rows of a digest, and a
stored payload is digested again when it is read.

Defined cases: a null html is the empty payload; a null url leaves the target
line out; control characters of a url are written as percent codes; among
equal rows the first written is the response; null page_ids sort last; an
empty table gives an empty archive; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.llm import files
from dimforge.llm.common import materialize, new_folder, require

LEAST = 100
_LINE = "\r\n"
_DATE = "1970-01-01T00:00:00Z"


@dataclass(frozen=True)
class Archive:
    payloads: DataFrame
    records: DataFrame


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", page_id.cast("string"), digest).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _safe(url: Column) -> Column:
    """Control characters as percent codes, so a url stays one header line."""
    for code in [*range(32), 127]:
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def write_archive(pages: DataFrame, least: int = LEAST, date: str = _DATE) -> Archive:
    """Archive of rows (page_id, url, html)."""
    base = require(pages, ["page_id", "url", "html"])
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    held = base.select("page_id", "url", payload.alias("payload"))
    meta = materialize(
        held.select("page_id", "url", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("n_bytes"))
        .withColumn("row", F.monotonically_increasing_id()), "page-digests")
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "row")
    first = materialize(meta.groupBy("digest").agg(F.min(order).alias("first")), "page-firsts")
    keyed = meta.join(first, "digest")
    revisit = (F.col("n_bytes") >= least) & (F.col("row") != F.col("first.row"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("digest"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _safe(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("first.page_id"), F.col("digest")))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To-Page: "), F.col("first.page_id").cast("string"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("WARC-Page-ID: "), F.col("page_id").cast("string")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, 0).otherwise(F.col("n_bytes")).cast("string")),
    ]
    header = F.concat(F.concat_ws(_LINE, *lines), F.lit(_LINE + _LINE)).cast("binary")
    records = materialize(keyed.select("page_id", "digest", header.alias("header")), "warc-records")
    # copies are combined before the shuffle: one payload a digest and task
    stored = (held.withColumn("digest", F.sha2("payload", 256)).withColumn("second", F.xxhash64("payload"))
              .groupBy("digest").agg(F.first("payload").alias("payload"), F.min("second").alias("least"),
                                     F.max("second").alias("most"), F.min(F.octet_length("payload")).alias("shortest"),
                                     F.max(F.octet_length("payload")).alias("longest")))
    same = F.when((F.col("least") == F.col("most")) & (F.col("shortest") == F.col("longest")), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("different payloads have the digest "), F.col("digest"))).cast("binary"))
    payloads = materialize(stored.select("digest", F.octet_length("payload").cast("long").alias("n_bytes"),
                                         same.alias("payload")), "warc-payloads")
    return Archive(payloads, records)


def verified(payloads: DataFrame) -> DataFrame:
    """The payloads, each digested again; a damaged one raises."""
    good = (F.sha2("payload", 256) == F.col("digest")) & (F.octet_length("payload") == F.col("n_bytes"))
    return payloads.withColumn("payload", F.when(good, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))).cast("binary")))


def reconstruct(archive: Archive) -> DataFrame:
    """page_id, record (the bytes of the WARC record), payload (also a revisit's), by join.

    A revisit's record ends after its header; its payload is the response's.
    """
    whole = archive.records.join(verified(archive.payloads).select("digest", "payload"), "digest")
    body = F.when(header_line(F.col("header"), "WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return whole.select("page_id", F.concat("header", body, F.lit((_LINE + _LINE).encode())).alias("record"), "payload")


def header_line(record: Column, name: str) -> Column:
    """Value of a header line of a record, null if it has none."""
    return _line(F.substring_index(F.decode(record, "UTF-8"), _LINE + _LINE, 1), name)


def _line(head: Column, name: str) -> Column:
    found = F.regexp_extract(F.concat(F.lit(_LINE), head, F.lit(_LINE)), f"\\r\\n{name}: ([^\\r\\n]*)\\r\\n", 1)
    return F.when(found != "", found)


def facts(archive: Archive) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back
    from the rebuilt records: a response's payload is cut out of its record, a
    revisit's is the joined one, and both are measured and digested again."""
    record = F.col("record")
    read = reconstruct(archive).withColumn("head", F.substring_index(F.decode(record, "UTF-8"), _LINE + _LINE, 1))
    head = {name: _line(F.col("head"), name) for name in (
        "WARC-Page-ID", "WARC-Type", "WARC-Refers-To-Page", "WARC-Payload-Digest", "Content-Length")}
    read = read.select("record", "head", "payload", *[c.alias(n.lower()) for n, c in head.items()])
    body = F.substring(record, F.octet_length("head") + F.lit(5), F.col("`content-length`").cast("int"))
    read = read.withColumn("body", F.when(F.col("`warc-type`") == "response", body).otherwise(F.col("payload")))
    read = read.withColumn("found", F.sha2("body", 256))
    told = F.substring_index("`warc-payload-digest`", ":", -1)
    same = F.when(F.col("found") == told, F.col("found")).otherwise(
        F.raise_error(F.concat(F.lit("a record does not hold the payload "), told)).cast("string"))
    return read.select(
        F.col("`warc-page-id`").cast("long").alias("page_id"), F.octet_length("body").cast("long").alias("payload_bytes"),
        same.alias("payload_digest"), F.col("`warc-type`").alias("record_type"),
        F.col("`warc-refers-to-page`").cast("long").alias("refers_to"))


def export_warc(spark: SparkSession, archive: Archive, folder: str | None = None) -> DataFrame:
    """Writes the records as .warc files, one a partition; path, n_records, n_bytes of each."""
    folder = folder or new_folder(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, n, size = files.own_name(folder, "part", ".warc"), None, 0, 0
        for batch in batches:
            for record in batch.column(0).to_pylist():
                out = out or files.open_output(path)
                out.write(record)
                n, size = n + 1, size + len(record)
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64()), pa.array([size], pa.int64())],
                                             ["path", "n_records", "n_bytes"])

    return materialize(reconstruct(archive).select("record").mapInArrow(write, "path string, n_records long, n_bytes long"),
                       "warc-files")
