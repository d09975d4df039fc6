"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints of 64 bits link at a Hamming distance of at most ``radius``.
With the bits in ``radius + 2`` blocks, two linked fingerprints agree on at
least two whole blocks, so every link lies in a bucket of some pair of blocks.
A bucket's fingerprints are stored as bit planes (plane b holds bit b of 64
fingerprints a word); a query fingerprint adds one plane after the other to
carry-save bit counters, 64 distances a step, and a block of words is left as
soon as every distance in it exceeds the radius.

Equal fingerprints are one row from the start.  A bucket of more than
``CHUNK`` fingerprints is cut into chunks and each pair of chunks is compared
in a task of its own, so no link is lost and no task grows with the bucket.
A pair of chunks returns no pairs but the edges to the smallest member of each
group it found, fewer than its fingerprints.

Defined cases: a null text counts as the empty text; a text without words has
the fingerprint zero, which links like any other; fewer words than a shingle
give one shingle; repeated shingles count each time; equal doc_ids are kept as
rows; a null doc_id is its own component unless it links, and is never a
representative of others; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import materialize, require
from dimforge.llm.components import connected, forest

BITS = 64
CHUNK = 4096
_SEED = 42
_QUERIES = 256


def fingerprint(text: str | None, words_each: int = 4) -> int:
    """SimHash of a text's word shingles (XXH64 of the UTF-8 bytes, seed 42).

    Words are runs of other bytes than space, tab to carriage return; A-Z
    count as a-z.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = [0, *(ends[:-1] + 1).tolist()]
    last = ends[words_each - 1:].tolist() or [len(joined)]
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(joined[a:b], _SEED) for a, b in zip(first, last)]), dtype=np.uint8)
    ones = np.zeros(BITS, dtype=np.int64)
    rows = hashes.reshape(-1, 8)
    for at in range(0, len(rows), 1 << 14):
        ones += np.unpackbits(rows[at:at + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame, words_each: int = 4, *keys: str) -> DataFrame:
    """doc_id, the named columns (longs), fp (the 64 bits as a long)."""
    names = ["doc_id", *keys]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words_each) for t in batch.column(len(names)).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], [*names, "fp"])

    return require(docs, [*names, "text"]).mapInArrow(rows, "".join(f"{n} long, " for n in names) + "fp long")


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes (64, words): bit j of word w of plane b is bit b of fingerprint 64w + j."""
    words = -(-len(fps) // 64)
    padded = np.zeros(words * 64, dtype=np.uint64)
    padded[:len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")  # (n, 64)
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def near(queries: np.ndarray, stored: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (query, stored) positions with at most ``radius`` differing bits, by blocks of queries.

    Counters are bit-sliced too: counter c holds bit c of 64 distances; a
    distance that passes the counters' range stays marked as over.
    """
    sliced, n = planes(stored), len(stored)
    counters, every = max(1, int(radius + 1).bit_length()), ~np.uint64(0)
    for at in range(0, len(queries), _QUERIES):
        q = queries[at:at + _QUERIES]
        lanes = [np.zeros((len(q), sliced.shape[1]), dtype=np.uint64) for _ in range(counters)]
        over = np.zeros((len(q), sliced.shape[1]), dtype=np.uint64)
        live = np.arange(len(q))
        for b in range(BITS):
            flip = np.where((q[live] >> np.uint64(b)) & np.uint64(1), every, np.uint64(0))
            carry = sliced[b] ^ flip[:, None]
            for c in range(counters):
                carry, lanes[c] = lanes[c] & carry, lanes[c] ^ carry
            over |= carry | _exceeds(lanes, radius)
            if b % 8 == 7:
                left = ~(over == every).all(axis=1)
                if not left.any():
                    live = live[:0]
                    break
                if left.sum() < 0.7 * len(left):
                    live, over = live[left], over[left]
                    lanes = [x[left] for x in lanes]
        if len(live):
            hit = np.unpackbits(np.ascontiguousarray(~over).view(np.uint8), axis=1, bitorder="little")[:, :n]
            i, j = np.nonzero(hit)
            yield live[i] + at, j


def _exceeds(lanes: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is above the radius, by comparing bit slices from the top."""
    above, equal = np.zeros_like(lanes[0]), ~np.zeros_like(lanes[0])
    for c in range(len(lanes) - 1, -1, -1):
        if radius >> c & 1:
            equal = equal & lanes[c]
        else:
            above = above | (equal & lanes[c])
            equal = equal & ~lanes[c]
    return above


def _block_keys(radius: int, fp: Column) -> list[Column]:
    """For each pair of the ``radius + 2`` blocks: the pair's number and its bits."""
    edges = [BITS * i // (radius + 2) for i in range(radius + 3)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    out = []
    for number, (a, b) in enumerate(combinations(masks, 2)):
        mask = a | b
        out.append(F.struct(F.lit(number).alias("pair"),
                            fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("bits")))
    return out


def links(fps: DataFrame, radius: int, chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b), a < b, that connect all fingerprints (column fp, distinct)
    within ``radius`` of each other."""
    keyed = fps.select("fp", F.explode(F.array(*_block_keys(radius, F.col("fp")))).alias("k")).select("fp", "k.pair", "k.bits")
    sizes = materialize(keyed.groupBy("pair", "bits").agg(F.count("*").alias("n")).where("n > 1"), "simhash-buckets")
    chunks = F.ceil(F.col("n") / chunk)
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("chunks"))
    # every unordered pair of chunks gets the two chunks' fingerprints once
    work = (keyed.join(sizes, ["pair", "bits"])
            .withColumn("chunks", chunks).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
            .select("fp", "pair", "bits", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                    (F.col("own") <= F.col("other")).alias("first"), (F.col("own") >= F.col("other")).alias("second")))
    spark = fps.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = ["pair", "bits", "low", "high"]
    sorted_work = work.repartition(parts, *key).sortWithinPartitions(*key, "fp")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            if not len(batch):
                continue
            last = batch.iloc[-1]
            open_ = np.logical_and.reduce([batch[c].to_numpy() == last[c] for c in key])
            cut = int(np.argmax(open_))
            held, done = batch.iloc[cut:], batch.iloc[:cut]
            if len(done):
                yield _group_edges(done, key, radius)
        if held is not None and len(held):
            yield _group_edges(held, key, radius)

    return sorted_work.mapInPandas(compare, "a long, b long").distinct()


def _group_edges(rows: pd.DataFrame, key: list[str], radius: int) -> pd.DataFrame:
    """Edges of all whole groups in rows sorted by key."""
    values = rows[key].to_numpy()
    starts = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]).any(axis=1)])
    ends = np.r_[starts[1:], len(rows)]
    fps = rows["fp"].to_numpy().view(np.uint64)
    first, second = rows["first"].to_numpy(bool), rows["second"].to_numpy(bool)
    out_a, out_b = [], []
    small = ends - starts == 2  # most buckets: one comparison, all of them at once
    x, y = fps[starts[small]], fps[starts[small] + 1]
    close = np.bitwise_count(x ^ y) <= radius
    out_a.append(x[close])
    out_b.append(y[close])
    for s, e in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
        group = fps[s:e]
        q, t = group[first[s:e]], group[second[s:e]]
        a, b = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        for i, j in near(q, t, radius):
            # a spanning forest instead of all pairs, block after block
            other = q[i] != t[j]
            a, b = forest(np.concatenate([a, q[i][other]]), np.concatenate([b, t[j][other]]))
        out_a.append(a)
        out_b.append(b)
    a = np.concatenate(out_a).view(np.int64)
    b = np.concatenate(out_b).view(np.int64)
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _components(fps: DataFrame, radius: int) -> DataFrame:
    """fp, least (its smallest doc_id), component of each distinct fingerprint."""
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    groups = connected(links(distinct.select("fp"), radius))  # node, component: linked fingerprints only
    return (distinct.join(groups, distinct.fp == groups.node, "left")
            .select("fp", "least", F.coalesce("component", "fp").alias("component")))


def near_duplicates(docs: DataFrame, words_each: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    fps = materialize(fingerprints(docs, words_each), "simhash")
    labelled = materialize(_components(fps, radius), "simhash-components")
    ids = materialize(labelled.groupBy("component").agg(F.min("least").alias("component_id")), "simhash-ids")
    mapping = labelled.join(ids, "component").select("fp", "component_id")
    return (fps.join(mapping, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def drop_near_duplicates(docs: DataFrame, words_each: int = 4, radius: int = 4) -> DataFrame:
    """One row of each component: that with its smallest doc_id (of several
    such rows, the one of least key).  Of a component's rows without a doc_id,
    which represent no others, one stays too.

    Rows are told apart by a key of two hashes over all their columns, written
    with the fingerprints, as one doc_id can have texts of several components.
    """
    cells = [F.to_json(c) if "map<" in kind else F.col(c) for c, kind in docs.dtypes]
    cells = [x for c in cells for x in (c.isNull(), c)]  # a hash passes over nulls
    key = [F.xxhash64(*cells).alias("key_a"), F.xxhash64(F.lit(1), *cells).alias("key_b")]
    fps = materialize(fingerprints(docs.select("doc_id", "text", *key), words_each, "key_a", "key_b"), "simhash")
    least = F.min(F.struct("doc_id", "key_a", "key_b"))
    firsts = fps.groupBy("fp", F.col("doc_id").isNull().alias("no_id")).agg(least.alias("row"))
    keep = (firsts.join(_components(fps, radius).select("fp", "component"), "fp")
            .groupBy("component", "no_id").agg(F.min("row").alias("row")).select("row.key_a", "row.key_b"))
    # equal rows have one key
    return (docs.select(F.struct(*docs.columns).alias("row"), *key).join(keep, ["key_a", "key_b"], "left_semi")
            .groupBy("key_a", "key_b").agg(F.first("row").alias("row")).select("row.*"))
