"""Quality rules over documents: cross-document line frequency and counts of one text.

Each line with a word is normalised (A-Z in lower case, one space between
words) and hashed; a document holds each of its distinct lines once.  Per host
(``source``) the distinct documents of each line are counted, rows of one text
being one document.  A line of more than ``least_docs`` documents and more
than ``share`` of the host's documents is common and removed.  A document with
fewer than ``least_words`` words left, or less than ``least_left`` of its
words, is depleted and rejected.

Counting is a partial sum before the shuffle, so a line that a third of all
documents hold arrives as one row a task.  Common lines are joined back by
broadcast if their counted size fits, else by a sort-merge join whose hot keys
AQE splits.

Defined cases: a null or empty text has no words, fails the base rule and is
not kept; a null source is a host of its own; rows of equal doc_id are judged
one by one; a line is known by 64 bits of hash; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import SMALL, materialize, require
from dimforge.operators.joins import lookup_join

WINDOW = 5
#: Bytes of text whose words are numbered and compared at a time.
_CHUNK = 4 << 20
_SPACE = b"\x20\t\n\x0b\x0c\r"
_NOT_STARTS = _SPACE + bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_SMALL = SMALL
_FACTS = ("key bigint, doc_id bigint, host string, text_hash binary, n_words bigint, word_chars bigint, n_symbols bigint,"
          " n_dup_lines bigint, n_repeat_words bigint, lines array<struct<line: bigint, words: bigint>>")


@dataclass(frozen=True)
class Limits:
    """``least_words`` is asked of the whole text (base rule) and of what is left."""

    least_docs: int = 5
    share: float = 0.01
    least_words: int = 10
    least_left: float = 0.3
    #: percent of the words in repeated windows that a document may hold
    repeats: int = 20


def repeated_words(texts: list[list[bytes]]) -> np.ndarray:
    """Per text, its words that lie in a window of five words found twice or more there."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter((numbers[w] for t in texts for w in t), np.int64, int(sizes.sum()))
    of = np.repeat(np.arange(len(texts)), sizes)
    n = len(ids) - WINDOW + 1
    if n < 2:
        return np.zeros(len(texts), dtype=np.int64)
    starts = np.flatnonzero(of[:n] == of[WINDOW - 1:])
    parts = [of[starts], *(ids[starts + j] for j in range(WINDOW))]
    mixed = np.zeros(len(starts), dtype=np.uint64)
    for part in parts:
        mixed = (mixed ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed)
    same = _equal_neighbours([mixed], order)
    # windows of equal hash must be equal, else they are sorted by their words
    if not np.array_equal(same, same & _equal_neighbours(parts, order)):
        order = np.lexsort(parts)
        same = _equal_neighbours(parts, order)
    twice = np.zeros(len(starts), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), dtype=bool)
    for j in range(WINDOW):
        covered[starts[twice] + j] = True
    return np.bincount(of[covered], minlength=len(texts))


def _equal_neighbours(parts: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    out = np.ones(max(0, len(order) - 1), dtype=bool)
    for part in parts:
        ordered = part[order]
        out &= ordered[1:] == ordered[:-1]
    return out


def _line_facts(raw: bytes) -> tuple[int, Counter]:
    """(lines equal to an earlier one, words by hash of the normalised line)."""
    held = [line for line in raw.split(b"\n") if line.strip()]
    words: Counter = Counter()
    for line, times in Counter(held).items():
        split = line.split()
        words[xxhash.xxh3_64_intdigest(b" ".join(split).lower()) - (1 << 63)] += times * len(split)
    return len(held) - len(set(held)), words


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= _CHUNK):
                size += len(texts[end])
                end += 1
            yield _chunk(batch.slice(at, end - at), texts[at:end])
            at = end


def _chunk(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    words = [t.split() for t in texts]
    lines = [_line_facts(t) for t in texts]
    offsets = np.cumsum([0, *(len(held) for _, held in lines)]).astype(np.int32)
    held = pa.StructArray.from_arrays(
        [pa.array([h for _, c in lines for h in c.keys()], pa.int64()),
         pa.array([w for _, c in lines for w in c.values()], pa.int64())], names=["line", "words"])
    columns = {
        "key": batch.column("key"), "doc_id": batch.column("doc_id"), "host": batch.column("host"),
        "text_hash": batch.column("text_hash"),
        "n_words": pa.array([len(w) for w in words], pa.int64()),
        "word_chars": pa.array([len(t.translate(None, _NOT_STARTS)) for t in texts], pa.int64()),
        "n_symbols": pa.array([len(t) - len(t.translate(None, _SYMBOLS)) for t in texts], pa.int64()),
        "n_dup_lines": pa.array([twice for twice, _ in lines], pa.int64()),
        "n_repeat_words": pa.array(repeated_words(words), pa.int64()),
        "lines": pa.ListArray.from_arrays(pa.array(offsets), held),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _hosted(docs: DataFrame) -> DataFrame:
    """doc_id, text, host (the source, never null) and a hash of the text."""
    host = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    return require(docs, ["doc_id", "text", "source"]).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", host.alias("host"),
        F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).alias("text_hash"))


def line_facts(docs: DataFrame) -> DataFrame:
    """A row a document: its counts, and words by hash of each distinct line."""
    keyed = _hosted(docs).withColumn("key", F.monotonically_increasing_id())
    return materialize(keyed.mapInArrow(_facts, _FACTS), "line-facts")


def common_lines(facts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """host, line, n_docs of the lines above the limits of their host."""
    texts = facts.groupBy("host", "text_hash").agg(F.first("lines").alias("lines"))
    texts = materialize(texts.select("host", F.col("lines.line").alias("line")), "line-texts")
    counted = texts.select("host", F.explode("line").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n_docs"))
    often = materialize(counted.where(F.col("n_docs") > limits.least_docs), "often")
    hosts = materialize(texts.groupBy("host").agg(F.count("*").alias("host_docs")), "hosts")
    return materialize(
        lookup_join(often, hosts, "host", settings=_SMALL)
        .where(F.col("n_docs") > F.lit(limits.share) * F.col("host_docs"))
        .select("host", "line", "n_docs"), "common-lines")


def judged(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Counts, words left without common lines, and the verdict, a row a document."""
    return _judged(line_facts(docs), limits)


def _judged(facts: DataFrame, limits: Limits) -> DataFrame:
    common = common_lines(facts, limits)
    held = facts.select("key", "host", F.explode("lines").alias("l")).select("key", "host", "l.line", "l.words")
    removed = lookup_join(held, common.select("host", "line"), ["host", "line"], settings=_SMALL)
    lost = removed.groupBy("key").agg(F.sum("words").alias("lost_words"), F.collect_list("line").alias("removed"))
    lost = materialize(lost, "lost-words")
    left = F.col("n_words") - F.coalesce(F.col("lost_words"), F.lit(0))
    base = (F.col("n_words") < limits.least_words) | (100 * F.col("n_repeat_words") > limits.repeats * F.col("n_words"))
    depleted = (left < limits.least_words) | (left < F.lit(limits.least_left) * F.col("n_words"))
    return facts.drop("lines").join(lost, "key", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~depleted).alias("kept"),
        left.alias("words_left"), "host", "text_hash", "removed")


def verdicts(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The counts and the verdict of each document."""
    return judged(docs, limits).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                       "base_failed", "kept", "words_left")


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist()):
            if gone:
                out = set(gone)
                text = "\n".join(line for line in (text or "").split("\n") if xxhash.xxh3_64_intdigest(
                    b" ".join(line.encode().split()).lower()) - (1 << 63) not in out)
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])


def cleaned(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id and text of the kept documents, without the common lines of their host."""
    facts = judged(docs, limits)
    # rows of one text and host are judged alike
    kept = materialize(facts.where("kept").groupBy("host", "text_hash").agg(F.first("removed").alias("removed")), "kept-texts")
    return _hosted(docs).join(kept, ["host", "text_hash"]).select("doc_id", "text", "removed").mapInArrow(
        _without_lines, "doc_id bigint, text string")
