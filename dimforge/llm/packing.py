"""Harmonic packing of documents into sequences of a fixed capacity.

Pieces are cut so that they fill bins exactly: class k holds pieces of
``capacity // k`` ids, and each of its bins takes exactly k of them.  A
document gives its full sequences first (class 1); from the rest the longest
class length that fits is cut, again and again, and what is left after that
falls short of 1/(k(k-1)) of the capacity, so two or three cuts end it.  Only
class lengths that waste at most 1/128 of the capacity are used (all powers of
two among them), so a filled bin is nearly full.

Bins are filled independently: the pieces of a class are dealt to shards of
about ``SHARD`` pieces, and each shard numbers its own.  At most k - 1 pieces
a shard are left over; those are placed best-fit into the fewest bins, again
in shards of bounded size.

Defined cases: a null text is the empty text (one piece: the end id); equal
rows are packed as often as they occur; very long documents give class-1
pieces; an empty table gives no rows; further columns are ignored; null
doc_ids are kept.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm import rans
from dimforge.llm.common import materialize, require
from dimforge.llm.tokens import encoder, tokenizer_path

CAPACITY = 1024
SHARD = 50_000
_RANDOM_SEED = 11


def class_lengths(capacity: int = CAPACITY) -> list[int]:
    """Piece lengths whose bins waste at most 1/128 of the capacity, ascending."""
    lengths = {capacity // k for k in range(1, capacity + 1)}
    return sorted(n for n in lengths if capacity - capacity // n * n <= capacity // 128)


def cuts(n_tokens: int, lengths: list[int]) -> list[int]:
    """Lengths of a document's pieces, in text order."""
    out, left = [], n_tokens
    while left:
        piece = lengths[bisect_left(lengths, left + 1) - 1]
        out += [piece] * (left // piece)
        left %= piece
    return out


def pieces(docs: DataFrame, end_id: int = 0, capacity: int = CAPACITY, tokenizer: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece and,
    ``with_ids``, its ids (little-endian unsigned 32-bit integers)."""
    tokenizer, lengths = tokenizer or tokenizer_path(), class_lengths(capacity)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end, wide = np.array([end_id], dtype=encode.dtype).tobytes(), encode.dtype.itemsize
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                row, start, length, crc, size, held = [], [], [], [], [], []
                for i, raw in enumerate(encode(part.column(1).to_pylist())):
                    ids = np.frombuffer(raw + end, dtype=encode.dtype).astype("<u4")
                    at_id = 0
                    for n in cuts(len(ids), lengths):
                        row.append(i)
                        start.append(at_id)
                        length.append(n)
                        crc.append(rans.checksum(ids[at_id:at_id + n]))
                        size.append(len(raw) // wide + 1)
                        if with_ids:
                            held.append(ids[at_id:at_id + n].tobytes())
                        at_id += n
                columns = [part.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, size))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(held, pa.binary())] * with_ids, names)

    return require(docs, ["doc_id", "text"]).mapInArrow(
        rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids)


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length: longest first, each into the fullest bin it fits."""
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    free: list[tuple[int, int]] = []  # (room, bin), ascending
    used = 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(free, (lengths[i], -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            room, b = capacity, used
            used += 1
        bins[i], offsets[i] = b, capacity - room
        insort(free, (room - lengths[i], b))
    return bins, offsets


def pack(docs: DataFrame, end_id: int = 0, capacity: int = CAPACITY, tokenizer: str | None = None,
         shard: int = SHARD, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset per
    piece and, ``with_ids``, its ids.

    ``sequence_id`` holds, from the high bits down, the number of the class
    (from 1, by ascending length; 0 for mixed bins), the shard and the bin.
    """
    spark = docs.sparkSession
    # the key is drawn once and written, so later steps and reruns see the same
    cut = materialize(pieces(docs, end_id, capacity, tokenizer, with_ids).withColumn("key", F.rand(_RANDOM_SEED)), "pieces")
    # one row for each class length
    number = {n: i for i, n in enumerate(class_lengths(capacity), 1)}
    sizes = [(r.length, number[r.length], -(-r.n // shard)) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()]
    shards = spark.createDataFrame(sizes, "length long, class long, shards long")
    dealt = cut.join(F.broadcast(shards), "length").withColumn(
        "shard", F.floor(F.col("key") * F.col("shards")))
    group = Window.partitionBy("length", "shard")
    each = F.lit(capacity).cast("long")
    numbered = (dealt
                .withColumn("rank", F.row_number().over(group.orderBy("key", "doc_id", "start")) - 1)
                .withColumn("n", F.count("*").over(group))
                .withColumn("each", F.floor(each / F.col("length")))
                .withColumn("bin", F.floor(F.col("rank") / F.col("each")))
                .withColumn("full", F.col("bin") < F.floor(F.col("n") / F.col("each"))))
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    numbered = materialize(numbered.select(
        *keep, "key", "class", "shard", "bin", "full", ((F.col("rank") % F.col("each")) * F.col("length")).alias("offset")), "ranked-pieces")
    filled = numbered.where("full").select(
        *keep, (F.col("class") * (1 << 52) + F.col("shard") * (1 << 26) + F.col("bin")).alias("sequence_id"), "offset")

    left = numbered.where("not full")
    parts = max(1, -(-left.count() // shard))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "key", "doc_id", "start"], ascending=[False, True, True, True])
        bins, offsets = best_fit(rows["length"].tolist(), capacity)
        part = rows["part"].iloc[0] if len(rows) else 0
        return rows[keep].assign(sequence_id=np.array(bins, dtype=np.int64) + (int(part) << 26),
                                 offset=np.array(offsets, dtype=np.int64))

    mixed = (left.withColumn("part", F.floor(F.col("key") * parts))
             .groupBy("part").applyInPandas(place, filled.schema))
    return filled.unionByName(mixed)


def sequences(docs: DataFrame, end_id: int = 0, capacity: int = CAPACITY, tokenizer: str | None = None,
              pad_id: int = 0, shard: int = SHARD) -> DataFrame:
    """sequence_id, n_tokens, ids: the packed sequences, each padded to ``capacity``
    (a power of two of ids stays as it is), as little-endian unsigned 32-bit integers.

    A sequence has at most ``capacity`` pieces, so its group is bounded; its
    pieces must lie one behind the other, else the task fails.
    """
    packed = pack(docs, end_id, capacity, tokenizer, shard, with_ids=True)
    joined = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("parts"))
    n = F.aggregate("parts", F.lit(0).cast("long"), lambda done, p: done + p["length"])
    gapless = F.aggregate("parts", F.lit(0).cast("long"), lambda done, p: F.when(p["offset"] == done, done + p["length"])) == n
    # hex strings join and pad inside Spark; 8 digits an id
    ids = F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")
    power = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n_tokens").cast("double")))).cast("long") == F.col("n_tokens")
    size = F.when(power, F.col("n_tokens")).otherwise(F.lit(capacity)).cast("int")
    pad = F.expr(f"repeat('{int(pad_id).to_bytes(4, 'little').hex()}', {capacity})")
    whole = joined.select("sequence_id", n.alias("n_tokens"), ids.alias("digits"), gapless.alias("gapless"))
    whole = whole.withColumn("digits", F.when(F.coalesce("gapless", F.lit(False)), F.col("digits")).otherwise(
        F.raise_error(F.concat(F.lit("pieces of a sequence overlap or leave a gap: "), F.col("sequence_id"))).cast("string")))
    return whole.select("sequence_id", "n_tokens", F.unhex(F.substring(F.concat("digits", pad), F.lit(1), 8 * size)).alias("ids"))
