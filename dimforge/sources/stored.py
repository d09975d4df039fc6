"""Folders of written tables: size facts, keys and marks beside the data.

A finished write may hold three small files whose names begin with ``_``, so
that no reader takes them for data:

- ``_sizes.json``: rows, and bytes of the values of each text column, counted
  while the rows were written (an observation, no further job);
- ``_snapshot.json``: what the rows were made from (:func:`snapshot_once`);
- ``_PUBLISHED``: a version that a catalog entry has named.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimforge.operators.joins import Sizes, is_text, note_sizes

SIZES, SNAPSHOT, PUBLISHED = "_sizes.json", "_snapshot.json", "_PUBLISHED"


def file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = file_system(spark, path)
    return system.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    system, at = file_system(spark, path)
    system.delete(at, True)


def children(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, time of the last change in ms) of what lies in a folder."""
    system, at = file_system(spark, folder)
    if not system.exists(at):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in system.listStatus(at)]


def put_text(spark: SparkSession, path: str, text: str) -> None:
    system, at = file_system(spark, path)
    out = system.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def get_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    system, at = file_system(spark, path)
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


@dataclass
class Written:
    """Counts of a write, filled when it has ended."""

    sizes: Sizes
    #: rows for which the condition given to :func:`write` does not hold
    strays: int = 0
    extra: dict = field(default_factory=dict)


def write(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None,
          only=None) -> Written:
    """Writes ``df`` to ``path`` (replacing what is there) and records its sizes.

    ``only``: a condition that every row should meet; the others are counted.
    """
    spark = df.sparkSession
    texts = [f.name for f in df.schema.fields if is_text(f.dataType.simpleString())]
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.sum(F.octet_length(F.col(f"`{c}`"))).alias(f"b{i}") for i, c in enumerate(texts)]
    if only is not None:
        metrics.append(F.sum(F.when(only, 0).otherwise(1)).alias("strays"))
    writer = df.observe(seen, *metrics).write.mode("overwrite").format(fmt)
    (writer.partitionBy(partition_by) if partition_by else writer).save(path)
    got = seen.get
    sizes = Sizes(int(got["rows"]), {c: int(got[f"b{i}"] or 0) for i, c in enumerate(texts)})
    put_text(spark, f"{path}/{SIZES}", json.dumps({"rows": sizes.rows, "bytes": sizes.bytes}))
    return Written(sizes, int(got.get("strays") or 0) if only is not None else 0)


def recorded(spark: SparkSession, path: str) -> Sizes | None:
    """The sizes recorded with a write, if they are there."""
    text = get_text(spark, f"{path}/{SIZES}")
    if text is None:
        return None
    held = json.loads(text)
    return Sizes(held["rows"], held["bytes"])


def with_sizes(df: DataFrame, *paths: str) -> DataFrame:
    """Notes on ``df`` the sizes recorded in the folders it reads, if all have some."""
    found = [recorded(df.sparkSession, p) for p in paths]
    if found and all(found):
        columns = {c for s in found for c in s.bytes}
        note_sizes(df, Sizes(sum(s.rows for s in found), {c: sum(s.bytes.get(c, 0) for s in found) for c in columns}))
    return df
