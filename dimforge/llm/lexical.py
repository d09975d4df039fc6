"""Ranked lexical search: an inverted index in shards, and Block-Max MaxScore over it.

Index.  Every task cuts its documents into shards of a bounded number of
postings.  A shard has a row with the ids and lengths of its documents, and a
row for each of its terms: postings in blocks of 128, written as
variable-length bytes, and ahead of them, for each block, its first document,
the place of its bytes and the pairs (occurrences, document length) that no
other posting of the block beats in both.  Weights come from counts of all
documents, which a task can't know; the pairs give the exact maximum of a
block for any such counts, so an index is written once and serves any search.

Search.  Terms are weighted by counts over all shards, then each shard ranks
the items by itself, in windows of documents.  The lists with the least global
bounds, whose sum stays below the score of the k-th document so far, are not
essential: only documents of the essential lists are candidates.  For those,
the non-essential lists are asked from the largest bound down; a candidate
that can't reach the k-th score with the maximum of its block is rejected
before the block is decompressed.  The best k of each shard are merged.

Scores are integers: each occurrence of a term in the item adds
``w * ((1000000000 * tf) // (1000 * tf + 8 * m))``.

Defined cases: null texts and texts without a term are no documents and find
nothing; items of equal item_id are ranked one by one; of equal scores the
smaller doc_id ranks first, a null doc_id last; rows of equal doc_id are
documents of their own; an empty index or no items give no rows; further
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.common import materialize, require

BLOCK = 128
#: Postings after which a shard is closed.
POSTINGS = 2_000_000
#: Items, and distinct terms of them, that are searched for in one job.
ITEMS, TERMS = 1000, 50_000
_FIRST_WINDOW, _LAST_WINDOW = 256, 8192
_ROWS = 50_000
#: Tasks of a search at most; a task ranks over the shards that fall to it one after another.
_TASKS = 20_000
#: The term of the row that holds a shard's documents; no term is empty.
_DOCUMENTS = ""
_INDEX = "shard string, term string, df bigint, total bigint, heads binary, data binary"
# The constants of the score.
_SCALE, _TF, _M, _B = 1_000_000_000, 1000, 8, 75


def _lowered() -> bytes:
    """Bytes of a text as bytes of its terms: separators as spaces, A-Z in lower case."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
        table[c] = c
        table[ord(chr(c).upper())] = c
    return bytes(table)


_TABLE = _lowered()


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.encode().translate(_TABLE).split() if text else []


# ------------------------------------------------------------------ compression
def pack_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bytes of each value): 7 bits a byte, low ones first, the last byte below 128."""
    sizes = np.ones(len(values), dtype=np.int64)
    for bits in (7, 14, 21, 28):
        sizes += values >= 1 << bits
    at = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), dtype=np.uint8)
    for j in range(5):
        here = sizes > j
        out[at[here] + j] = ((values[here] >> (7 * j)) & 127) | np.where(sizes[here] > j + 1, 128, 0)
    return out, sizes


def unpack_numbers(raw: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(raw < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    sizes = last - first + 1
    place = np.arange(len(raw)) - np.repeat(first, sizes)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), first)


# ------------------------------------------------------------------------ index
class _Shard:
    """Documents gathered by a task until they are written as one shard."""

    def __init__(self):
        self.ids, self.lengths = [], []
        self.numbers: dict[bytes, int] = {}
        self.terms, self.tfs, self.sizes = [], [], []
        self.postings = 0

    def add(self, doc_id: int | None, words: list[bytes]) -> None:
        counts, numbers = Counter(words), self.numbers
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.terms.append(np.array([numbers.setdefault(w, len(numbers)) for w in counts], dtype=np.int32))
        self.tfs.append(np.fromiter(counts.values(), np.int64, len(counts)))
        self.sizes.append(len(counts))
        self.postings += len(counts)

    def rows(self, name: str, block: int) -> Iterator[pa.RecordBatch]:
        ids = pa.array(self.ids, pa.int64())
        known = np.array([i is not None for i in self.ids], dtype=np.uint8)
        lengths = np.array(self.lengths, dtype=np.int64)
        yield _index_rows(name, [_DOCUMENTS], [len(lengths)], [int(lengths.sum())],
                          pa.array([lengths.tobytes()], pa.binary()),
                          pa.array([ids.fill_null(0).to_numpy().tobytes() + known.tobytes()], pa.binary()))
        of = np.concatenate(self.terms)
        order = np.argsort(of, kind="stable")
        of = of[order].astype(np.int64)
        doc = np.repeat(np.arange(len(lengths)), self.sizes)[order]
        tf = np.concatenate(self.tfs)[order]
        df = np.bincount(of, minlength=len(self.numbers))
        place = np.arange(len(of)) - np.repeat(np.cumsum(df) - df, df)
        starts = np.flatnonzero(place % block == 0)
        block_of = np.cumsum(place % block == 0) - 1
        gap = np.diff(doc, prepend=0)
        gap[starts] = 0
        raw, sizes = pack_numbers(np.stack([gap, tf - 1], axis=1).ravel())
        ends = np.cumsum(sizes)[1::2]
        n_blocks = -(-df // block)
        list_starts = np.concatenate([[0], ends])[np.cumsum(df) - df]
        list_ends = ends[np.cumsum(df) - 1]
        byte = np.concatenate([[0], ends])[starts] - np.repeat(list_starts, n_blocks)
        heads, head_ends = _heads(doc[starts], byte, of[starts], block_of, tf, lengths[doc], n_blocks)
        term = list(self.numbers)
        for a in range(0, len(term), _ROWS):
            b = min(a + _ROWS, len(term))
            yield _index_rows(name, term[a:b], df[a:b], np.zeros(b - a, dtype=np.int64),
                              _binaries(heads, head_ends, a, b), _binaries(raw, list_ends, a, b))


def _heads(first, byte, of, block_of, tf, length, n_blocks) -> tuple[np.ndarray, np.ndarray]:
    """Per term: first documents of its blocks, places of their bytes, numbers of their
    unbeaten pairs, then the pairs.  Returns the bytes and where each term's end."""
    order = np.lexsort((-tf, length, block_of))
    key = block_of[order] * (int(tf.max()) + 1) + tf[order]
    best = np.maximum.accumulate(key)
    pair = order[np.concatenate([[True], key[1:] > best[:-1]])]
    pairs_in = np.bincount(block_of[pair], minlength=len(first))
    per_term = np.bincount(of, weights=pairs_in, minlength=len(n_blocks)).astype(np.int64)
    size = 3 * n_blocks + 2 * per_term
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), dtype=np.uint32)
    within = np.arange(len(of)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    for j, values in enumerate((first, byte, pairs_in)):
        out[start[of] + j * n_blocks[of] + within] = values
    of_pair = of[block_of[pair]]
    at = start[of_pair] + 3 * n_blocks[of_pair] + 2 * (np.arange(len(pair)) - np.repeat(np.cumsum(per_term) - per_term, per_term))
    out[at], out[at + 1] = tf[pair], length[pair]
    return out.view(np.uint8), 4 * np.cumsum(size)


def _binaries(raw: np.ndarray, ends: np.ndarray, a: int, b: int) -> pa.Array:
    """Binary values a to b of those that lie one behind the other in ``raw``."""
    start = int(ends[a - 1]) if a else 0
    offsets = np.concatenate([[0], ends[a:b] - start]).astype(np.int32)
    held = np.ascontiguousarray(raw[start:int(ends[b - 1])])
    return pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets), pa.py_buffer(held)])


def _index_rows(name, term, df, total, heads, data) -> pa.RecordBatch:
    names = ["shard", "term", "df", "total", "heads", "data"]
    columns = [pa.array([name] * len(term), pa.string()), pa.array(term, pa.binary()).cast(pa.string()) if term[0] != "" else pa.array(term),
               pa.array(df, pa.int64()), pa.array(total, pa.int64()), heads, data]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _indexer(block: int, postings: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, shard = TaskContext.get().partitionId(), 0, _Shard()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = terms(text)
                if words:
                    shard.add(doc_id, words)
                if shard.postings >= postings:
                    yield from shard.rows(f"{part}-{number}", block)
                    number, shard = number + 1, _Shard()
        if shard.ids:
            yield from shard.rows(f"{part}-{number}", block)

    return run


def build_index(docs: DataFrame, block: int = BLOCK, postings: int = POSTINGS) -> DataFrame:
    """The index of rows (doc_id, text), written to the shared folder."""
    base = require(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialize(base.mapInArrow(_indexer(block, postings), _INDEX), "lexical-index")


# ----------------------------------------------------------------------- search
@dataclass(frozen=True)
class Query:
    """An item: terms with weight times occurrences in the item."""

    key: int
    item_id: int | None
    weights: dict[str, int]


class PostingList:
    """A term's postings in a shard, decompressed block by block when asked for."""

    def __init__(self, df: int, heads: bytes, data: bytes, m: np.ndarray, m_of: "Lengths", block: int):
        head = np.frombuffer(heads, dtype="<u4").astype(np.int64)
        self.n_blocks, self.df, self.block, self.m = -(-df // block), df, block, m
        k = self.n_blocks
        self.firsts, self.places, pairs = head[:k], np.append(head[k:2 * k], len(data)), head[2 * k:3 * k]
        best = impact(head[3 * k::2], m_of(head[3 * k + 1::2]))
        self.maxima = np.maximum.reduceat(best, np.cumsum(pairs) - pairs)
        self.most = int(self.maxima.max())
        self.raw = np.frombuffer(data, dtype=np.uint8)
        self.docs = self.impacts = None
        self.known = np.zeros(k, dtype=bool)

    def decompress(self, blocks: np.ndarray) -> None:
        blocks = blocks[~self.known[blocks]]
        if not len(blocks):
            return
        if self.docs is None:
            self.docs, self.impacts = np.zeros(self.df, dtype=np.int64), np.zeros(self.df, dtype=np.int64)
        self.known[blocks] = True
        for run in np.split(blocks, np.flatnonzero(np.diff(blocks) != 1) + 1):
            a, b = int(run[0]), int(run[-1]) + 1
            gap, tf = unpack_numbers(self.raw[self.places[a]:self.places[b]]).reshape(-1, 2).T
            # each block begins anew at its first document
            sums = np.cumsum(gap)
            starts = np.arange(0, len(gap), self.block)
            sizes = np.diff(np.append(starts, len(gap)))
            docs = sums + np.repeat(self.firsts[a:b] - sums[starts], sizes)
            at = a * self.block
            self.docs[at:at + len(docs)] = docs
            self.impacts[at:at + len(docs)] = impact(tf + 1, self.m[docs])

    def between(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of the postings in [lo, hi)."""
        a = max(0, int(np.searchsorted(self.firsts, lo, side="right")) - 1)
        b = int(np.searchsorted(self.firsts, hi, side="left"))
        if a >= b:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.decompress(np.arange(a, b))
        docs = self.docs[a * self.block:b * self.block]
        i, j = np.searchsorted(docs, [lo, hi])
        return docs[i:j], self.impacts[a * self.block:b * self.block][i:j]


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (_SCALE * tf) // (_TF * tf + _M * m)


class Lengths:
    """The length norm m of documents of n terms, among N documents of L terms together."""

    def __init__(self, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms

    def __call__(self, n: np.ndarray) -> np.ndarray:
        if len(n) and _B * int(n.max()) * self.n_docs >= 1 << 63:
            return np.array([100 - _B + _B * int(x) * self.n_docs // self.n_terms for x in n], dtype=np.int64)
        return 100 - _B + (_B * n * self.n_docs) // self.n_terms


class ShardSearch:
    """Ranks items over one shard."""

    def __init__(self, rows: Iterator[tuple[str, int, bytes, bytes]], lengths: Lengths, block: int):
        held = {term: (df, heads, data) for term, df, heads, data in rows}
        n, heads, data = held.pop(_DOCUMENTS)
        self.n, self.block, self.lengths = n, block, lengths
        self.ids = np.frombuffer(data, dtype="<i8", count=n)
        self.missing = np.frombuffer(data, dtype=np.uint8, offset=8 * n) == 0
        self.m = lengths(np.frombuffer(heads, dtype="<i8"))
        order = np.lexsort((self.ids, self.missing))
        self.rank = np.empty(n, dtype=np.int64)
        self.rank[order] = np.arange(n)
        self.held, self.lists = held, {}

    def posting_list(self, term: str) -> PostingList | None:
        if term not in self.lists and term in self.held:
            self.lists[term] = PostingList(*self.held[term], self.m, self.lengths, self.block)
        return self.lists.get(term)

    def top(self, weights: dict[str, int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents of the shard, scores) of the k best, in no order."""
        found = [(w * p.most, w, p) for term, w in weights.items() if w > 0 and (p := self.posting_list(term))]
        found.sort(key=lambda x: x[0])
        below = np.cumsum([bound for bound, _, _ in found])
        best_docs, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        least, lo, window = 0, 0, _FIRST_WINDOW
        while lo < self.n and found:
            hi = min(self.n, lo + window)
            spare = int(np.searchsorted(below, least, side="left"))
            if spare == len(found):
                break
            sums = np.zeros(hi - lo, dtype=np.int64)
            for _, w, p in found[spare:]:
                docs, impacts = p.between(lo, hi)
                sums[docs - lo] += w * impacts
            docs = np.flatnonzero(sums)
            scores, docs = sums[docs], docs + lo
            for i in range(spare - 1, -1, -1):
                docs, scores = self._refine(docs, scores, found[i], int(below[i - 1]) if i else 0, int(below[i]), least)
                if not len(docs):
                    break
            stay = scores >= max(least, 1)
            best_docs, best = np.append(best_docs, docs[stay]), np.append(best, scores[stay])
            if len(best) >= k:
                order = np.lexsort((self.rank[best_docs], -best))[:k]
                best_docs, best = best_docs[order], best[order]
                least = int(best[-1])
            lo, window = hi, min(2 * window, _LAST_WINDOW)
        return best_docs, best

    @staticmethod
    def _refine(docs, scores, entry, rest, bound, least):
        """Candidates with one more list, without those that can't reach ``least``."""
        _, w, p = entry
        stay = scores + bound >= least
        docs, scores = docs[stay], scores[stay]
        block = np.searchsorted(p.firsts, docs, side="right") - 1
        most = np.where(block >= 0, w * p.maxima[block], 0)
        stay = scores + most + rest >= least
        docs, scores, block = docs[stay], scores[stay], block[stay]
        inside = block >= 0
        if inside.any():
            blocks = np.unique(block[inside])
            p.decompress(blocks)
            # the blocks asked for lie one behind the other in ascending order
            at = (blocks[:, None] * p.block + np.arange(p.block)).ravel()
            at = at[at < p.df]
            here = np.searchsorted(p.docs[at], docs)
            here[here == len(at)] = 0
            hit = p.docs[at[here]] == docs
            scores = scores + np.where(hit, w * p.impacts[at[here]], 0)
        return docs, scores


def _searcher(queries: list[Query], lengths: Lengths, k: int, block: int):
    def run(table: pa.Table) -> pa.Table:
        rows = zip(*(table.column(c).to_pylist() for c in ("term", "df", "heads", "data")))
        shard = ShardSearch(rows, lengths, block)
        keys, items, docs, scores = [], [], [], []
        for q in queries:
            at, got = shard.top(q.weights, k)
            keys += [q.key] * len(at)
            items += [q.item_id] * len(at)
            docs += [None if shard.missing[d] else int(shard.ids[d]) for d in at]
            scores += got.tolist()
        return pa.table({"key": pa.array(keys, pa.int64()), "item_id": pa.array(items, pa.int64()),
                         "doc_id": pa.array(docs, pa.int64()), "score": pa.array(scores, pa.int64())})

    return run


def _blocks_of_items(items: DataFrame, most_items: int, most_terms: int) -> Iterator[list[tuple[int, int | None, Counter]]]:
    """Items in blocks, read one partition at a time."""
    block, held = [], set()
    for key, row in enumerate(items.toLocalIterator()):
        counts = Counter(w.decode() for w in terms(row["text"]))
        if block and (len(block) >= most_items or len(held | counts.keys()) > most_terms):
            yield block
            block, held = [], set()
        block.append((key, row["item_id"], counts))
        held |= counts.keys()
    if block:
        yield block


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(index: DataFrame, items: DataFrame, k: int = 10, block: int = BLOCK,
           most_items: int = ITEMS, most_terms: int = TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item (item_id, text).

    Items are searched for in blocks of at most ``most_items`` items and about
    ``most_terms`` distinct terms, one job a block.
    """
    spark = index.sparkSession
    n_docs, n_terms, n_shards = index.where(F.col("term") == _DOCUMENTS).agg(F.sum("df"), F.sum("total"), F.count("*")).first()
    items = require(items, ["item_id", "text"]).select(F.col("item_id").cast("long").alias("item_id"), "text")
    found = None
    for group in _blocks_of_items(items, most_items, most_terms) if n_docs else ():
        asked = sorted(set().union(*(c for _, _, c in group)))
        wanted = F.broadcast(spark.createDataFrame([(t,) for t in [_DOCUMENTS, *asked]], "term string"))
        lists = index.join(wanted, "term", "left_semi")
        dfs = dict(lists.where(F.col("term") != _DOCUMENTS).groupBy("term").agg(F.sum("df")).collect())
        weights = {t: weight(n_docs, df) for t, df in dfs.items()}
        queries = [Query(key, item, {t: weights[t] * times for t, times in c.items() if t in weights}) for key, item, c in group]
        # few bytes and much work a shard: as many tasks as shards, not as their bytes ask for
        dealt = lists.select("shard", "term", "df", "heads", "data").repartition(min(n_shards, _TASKS), "shard")
        hits = dealt.groupBy("shard").applyInArrow(
            _searcher(queries, Lengths(n_docs, n_terms), k, block), "key bigint, item_id bigint, doc_id bigint, score bigint")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Index of ``docs`` and the k best of them for each item."""
    return search(build_index(docs), items, k)
