"""Token-id files: rANS blocks with a shared frequency table.

``write_token_files`` encodes every text, counts all ids, and writes one file
per range of doc_ids.  A file (little-endian) is

    "DFRANS1\\n"
    blocks of at most ``BLOCK`` ids (see ``rans``), back to back
    zlib: the documents' id counts (int64)
    zlib: the checkpoints, one a block: its byte offset and the ids before it (int64 pairs)
    trailer: bytes of the two tables, number of documents, number of blocks,
             CRC-32 of the two tables (uint64 each), "DFRANSX\\n"

The manifest (a Parquet table written by Spark) names the files that count,
in order, with the doc_ids they hold.  ``read_documents`` reads whole files in
parallel; ``read_range`` decodes only the blocks that a range touches.

Defined cases: a null text is the empty text (its ids are the end id alone);
an empty table gives an empty manifest; rows with a null doc_id come first;
rows with equal doc_ids are all kept, ordered by the checksum of their ids;
very long documents span blocks; further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimforge.llm import files, rans
from dimforge.llm.common import discard, materialize, new_folder, require, table_folder
from dimforge.llm.tokens import encoder, tokenizer_path

BLOCK = 1 << 20
FILE_IDS = 1 << 25
_MAGIC, _END = b"DFRANS1\n", b"DFRANSX\n"
_TRAILER = struct.Struct("<QQQQQ8s")
_MANIFEST = "part int, path string, n_ids long, n_docs long, n_bytes long"


def token_rows(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int) -> DataFrame:
    """doc_id, ids (little-endian bytes, end id appended), n_tokens, ids_crc32 of
    each document; and a row for each task with documents, with nothing but
    ``counts``: how often each id of the vocabulary occurs in it (compressed int64)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([end_id], dtype=encode.dtype).tobytes()
        seen = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = [x + end for x in encode(part.column(1).to_pylist())]
                arrays = [np.frombuffer(x, dtype=encode.dtype) for x in ids]
                seen += np.bincount(np.frombuffer(b"".join(ids), dtype=encode.dtype), minlength=vocabulary)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(ids, pa.binary()), pa.array([len(x) for x in arrays], pa.int64()),
                     pa.array([rans.checksum(x) for x in arrays], pa.int64()), pa.nulls(len(ids), pa.binary())], names)
        if seen.any():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                 pa.array([zlib.compress(seen.tobytes(), 1)], pa.binary())], names)

    names = ["doc_id", "ids", "n_tokens", "ids_crc32", "counts"]
    return require(docs, ["doc_id", "text"]).mapInArrow(
        rows, "doc_id long, ids binary, n_tokens long, ids_crc32 long, counts binary")


def id_counts(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs in all documents (one count per id and partition is shuffled)."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                seen += np.frombuffer(zlib.decompress(raw), dtype=np.int64)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], ["id", "n"])

    rows = (tokens.where("counts IS NOT NULL").select("counts").mapInArrow(counts, "id int, n long")
            .groupBy("id").agg(F.sum("n").alias("n")))
    out = np.zeros(vocabulary, dtype=np.int64)
    for row in rows.collect():  # at most one row for each id of the vocabulary
        out[row.id] = row.n
    return out


@dataclass(frozen=True)
class TokenFiles:
    """A written set: its folder and its manifest."""

    folder: str
    manifest: DataFrame


class _Writer:
    """Writes one file; holds at most one block of ids."""

    def __init__(self, folder: str, part: int, table: rans.Table, dtype: np.dtype):
        self.path = files.own_name(folder, f"part-{part:07d}", ".rans")
        self.out, self.table, self.dtype = files.open_output(self.path), table, dtype
        self.out.write(_MAGIC)
        self.size, self.waiting, self.held = len(_MAGIC), [], 0
        self.ids, self.counts, self.checkpoints = 0, [], []

    def add(self, ids: np.ndarray) -> None:
        self.counts.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK:
            held = np.concatenate(self.waiting)
            whole = len(held) // BLOCK * BLOCK
            for at in range(0, whole, BLOCK):
                self._block(held[at:at + BLOCK])
            self.waiting, self.held = [held[whole:].copy()], len(held) - whole

    def _block(self, ids: np.ndarray) -> None:
        self.checkpoints.append((self.size, self.ids))
        block = rans.encode(ids, self.table)
        self.out.write(block)
        self.size += len(block)
        self.ids += len(ids)

    def close(self) -> tuple[str, int, int, int]:
        if self.held:
            self._block(np.concatenate(self.waiting))
        docs = zlib.compress(np.array(self.counts, dtype="<i8").tobytes())
        points = zlib.compress(np.array(self.checkpoints, dtype="<i8").tobytes())
        tail = _TRAILER.pack(len(docs), len(points), len(self.counts), len(self.checkpoints),
                             zlib.crc32(docs + points), _END)
        self.out.write(docs + points + tail)
        self.out.close()
        return self.path, self.ids, len(self.counts), self.size + len(docs) + len(points) + len(tail)


def write_token_files(docs: DataFrame, end_id: int, tokenizer: str | None = None,
                      file_ids: int = FILE_IDS) -> TokenFiles:
    """Encodes all texts and writes them in ascending doc_id order."""
    spark, tokenizer = docs.sparkSession, tokenizer or tokenizer_path()
    local = encoder(tokenizer)
    vocabulary, dtype = max(len(local.spaced), end_id + 1), local.dtype.str
    written = materialize(token_rows(docs, tokenizer, end_id, vocabulary), "token-ids")
    counts = id_counts(written, vocabulary)
    n_ids, tokens = int(counts.sum()), written.where("counts IS NULL")
    folder = new_folder(spark, "token-files")
    frequencies = rans.scaled_frequencies(counts)
    files.put(f"{folder}/frequencies.bin", zlib.compress(frequencies.astype("<u4").tobytes()))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, doc_ids = TaskContext.get().partitionId(), None, []
        for batch in batches:
            if writer is None and batch.num_rows:
                writer = _Writer(folder, part, read_table(folder), np.dtype(dtype))
            for ids in batch.column(0).to_pylist():
                writer.add(np.frombuffer(ids, dtype=dtype))
            doc_ids.append(batch.column(1))
        if writer is None:
            return
        path, ids, count, size = writer.close()
        names = pa.chunked_array(doc_ids).combine_chunks().cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (part, path, ids, count, size)] + [pa.array([names.to_pylist()], pa.list_(pa.int64()))],
            schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64()),
                              ("n_bytes", pa.int64()), ("doc_ids", pa.list_(pa.int64()))]))

    parts = max(1, -(-n_ids // file_ids), min(spark.sparkContext.defaultParallelism, -(-n_ids // (1 << 20))))
    ordered = (tokens.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "ids_crc32")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids_crc32"))
    manifest = materialize(ordered.select("ids", "doc_id").mapInArrow(write, f"{_MANIFEST}, doc_ids array<long>"),
                           "token-manifest")
    old = table_folder(written)
    if old:
        discard(spark, old)
    return TokenFiles(folder, manifest)


_tables: dict[str, rans.Table] = {}


def read_table(folder: str) -> rans.Table:
    """The shared frequency table of a folder, kept by the worker."""
    if folder not in _tables:
        _tables.clear()
        raw = zlib.decompress(files.get(f"{folder}/frequencies.bin"))
        _tables[folder] = rans.Table(np.frombuffer(raw, dtype="<u4"))
    return _tables[folder]


def _tables_of(f) -> tuple[np.ndarray, np.ndarray, int]:
    """Document lengths, checkpoints and the end of the blocks."""
    size = f.size()
    f.seek(size - _TRAILER.size)
    docs, points, n_docs, n_blocks, crc, end = _TRAILER.unpack(f.read(_TRAILER.size))
    f.seek(size - _TRAILER.size - docs - points)
    raw = f.read(docs + points)
    if end != _END or zlib.crc32(raw) != crc:
        raise ValueError("the tables of a token file are damaged")
    lengths = np.frombuffer(zlib.decompress(raw[:docs]), dtype="<i8")
    checkpoints = np.frombuffer(zlib.decompress(raw[docs:]), dtype="<i8").reshape(n_blocks, 2)
    if len(lengths) != n_docs:
        raise ValueError("the tables of a token file are damaged")
    return lengths, checkpoints, size - _TRAILER.size - docs - points


def read_range(folder: str, path: str, start: int, length: int) -> np.ndarray:
    """Ids ``start`` to ``start + length`` of one file, from the nearest checkpoint on."""
    with files.open_input(path) as f:
        _, points, end = _tables_of(f)
        first = max(0, int(np.searchsorted(points[:, 1], start, "right")) - 1)
        last = int(np.searchsorted(points[:, 1], start + length, "left"))
        got = []
        for k in range(first, last):
            f.seek(int(points[k, 0]))
            got.append(rans.decode(f.read(int(points[k + 1, 0] if k + 1 < len(points) else end) - int(points[k, 0])),
                                   read_table(folder)))
    ids = np.concatenate(got) if got else np.zeros(0, dtype=np.uint32)
    return ids[start - int(points[first, 1]):][:length] if len(points) else ids


def documents_of(folder: str, path: str) -> Iterator[np.ndarray]:
    """The ids of each document of a file, block after block."""
    with files.open_input(path) as f:
        lengths, points, end = _tables_of(f)
        held, ends, k = np.zeros(0, dtype=np.uint32), [*points[1:, 0].tolist(), end], 0
        for n in lengths.tolist():
            parts = [held]
            have = len(held)
            while have < n:
                f.seek(int(points[k, 0]))
                parts.append(rans.decode(f.read(ends[k] - int(points[k, 0])), read_table(folder)))
                have += len(parts[-1])
                k += 1
            joined = np.concatenate(parts) if len(parts) > 1 else held
            yield joined[:n]
            held = joined[n:]


def read_documents(spark: SparkSession, written: TokenFiles, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and,
    ``with_ids``, the ids; all taken from the files."""
    folder = written.folder
    # a row a file, numbered by the range it holds
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = written.manifest.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    work = written.manifest.join(listed, "part").select("path", "start", "doc_ids")
    fields = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, names in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows: list[tuple] = []
                for name, ids in zip(names, documents_of(folder, path), strict=True):
                    rows.append((name, start, len(ids), rans.checksum(ids)) + ((ids,) if with_ids else ()))
                    start += len(ids)
                    if len(rows) == 1000:
                        yield _batch(rows, with_ids)
                        rows = []
                if rows:
                    yield _batch(rows, with_ids)

    n = max(1, min(written.manifest.count(), 100_000))
    return work.repartition(n, "path").mapInArrow(read, fields)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    if with_ids:
        arrays.append(pa.array([x.tolist() for x in columns[4]], pa.list_(pa.int64())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names)


def token_digest(docs: DataFrame, end_id: int = 2, tokenizer: str | None = None) -> DataFrame:
    """Writes the files and reads them back: doc_id, start, n_tokens, ids_crc32."""
    return read_documents(docs.sparkSession, write_token_files(docs, end_id, tokenizer), with_ids=False)
