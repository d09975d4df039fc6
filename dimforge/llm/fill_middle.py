"""Fill-in-middle transformation of documents, cut at line ends.

A text of n lines (each with its line end) is cut into a prefix, a middle and
a suffix after two drawn numbers of lines.  The ends of the lines, counted in
code points, form a compressed set (:mod:`roaring`); the k-th end is looked up
by container and local select, so both cuts cost no second pass over the text.

The draws are the first four groups of 8 hex digits of SHA-256 over
``seed:doc_id``: two cut numbers, whether the document is transformed, and
whether it is written prefix-suffix-middle or suffix-prefix-middle.

Defined cases: a null text is the empty text; empty texts and texts that hold
a sentinel stay plain; a null doc_id draws as the empty text after the seed;
repeated rows are each transformed, alike; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import require
from dimforge.llm.roaring import OffsetSet

_SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


@dataclass(frozen=True)
class Shape:
    """``rate`` percent of the documents are transformed, ``spm`` percent of
    those with the suffix first.  The sentinels stand before prefix, suffix
    and middle."""

    seed: int = 7
    rate: int = 100
    spm: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = self.sentinels
        if not all(marks) or len(set(marks)) < 3:
            raise ValueError("three different sentinels are needed")
        if any(a[i:] == b[:len(a) - i] or a[i:].startswith(b) for a in marks for b in marks for i in range(1, len(a))) or any(
                a.startswith(b) for a in marks for b in marks if a != b):
            raise ValueError("sentinels that overlap can't be found again in the output")

    @property
    def sentinels(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def line_ends(text: str) -> tuple[OffsetSet, int]:
    """The end of each line in code points, and the number of lines."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    at = np.flatnonzero(raw == 10)
    if len(raw) == len(text):
        ends = at + 1
    else:
        ends = np.cumsum((raw & 0xC0) != 0x80)[at]
    if text and text[-1] != "\n":
        ends = np.append(ends, len(text))
    return OffsetSet(ends), len(ends)


def _transform(doc_id: int | None, text: str, shape: Shape) -> tuple[int, str, int | None, int | None, str]:
    ends, n = line_ends(text)
    digits = hashlib.sha256(f"{shape.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(mark in text for mark in shape.sentinels) or h3 % 100 >= shape.rate:
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends.select(u - 1) if u else 0 for u in (first, second))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < shape.spm:
        return n, "spm", a, b - a, f"{shape.suffix}{s}{shape.prefix}{p}{shape.middle}{m}"
    return n, "psm", a, b - a, f"{shape.prefix}{p}{shape.suffix}{s}{shape.middle}{m}"


def _batches(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [(i, *_transform(i, t or "", shape)) for i, t in zip(ids, batch.column(1).to_pylist())]
            columns = list(zip(*rows)) if rows else [()] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def fill_middle(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output (the text to train on)."""
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return base.mapInArrow(_batches(shape), _SCHEMA)


def restored(output: Column, form: Column, shape: Shape = Shape()) -> Column:
    """The text that ``output`` was made from, by cutting at the sentinels."""
    def between(rest: Column, mark: str) -> tuple[Column, Column]:
        """What stands before the first ``mark``, and after it."""
        head = F.substring_index(rest, mark, 1)
        return head, F.substring(rest, F.char_length(head) + F.lit(1 + len(mark)), F.char_length(rest))

    def body(mark: str) -> Column:
        return F.substring(output, F.lit(1 + len(mark)), F.char_length(output))

    p, rest = between(body(shape.prefix), shape.suffix)
    s, m = between(rest, shape.middle)
    s2, rest2 = between(body(shape.suffix), shape.prefix)
    p2, m2 = between(rest2, shape.middle)
    return F.when(form == "psm", F.concat(p, m, s)).when(form == "spm", F.concat(p2, m2, s2)).otherwise(output)


def digest(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """What :func:`fill_middle` makes, with checksums of the output and of the text restored from it."""
    made = fill_middle(require(docs, ["doc_id", "text"]), shape)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form"), shape).cast("binary"), 256).alias("restored_sha256"))
