"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.config import Settings


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    A session without the setting gets a scratch folder of its own if its
    master is local (as in tests); on a cluster the setting is required.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="dimforge-llm-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    # with its file system, so that tasks reach the same one by URI
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found)
    whole = str(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at))
    return re.sub("^file:/+", "file:///", whole).rstrip("/")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once a Spark application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="dimforge-"), "dimforge.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    at = os.path.join(folder, name)
                    z.write(at, os.path.relpath(at, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


#: A side of a join is broadcast up to this size, which is counted first.
SMALL = Settings(broadcast_max_rows=200_000, broadcast_max_bytes=16 << 20)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/dimforge-llm/{name}-{uuid.uuid4().hex}"


_written: "weakref.WeakKeyDictionary[DataFrame, str]" = weakref.WeakKeyDictionary()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps
    before, and costly or order-dependent steps run once.  An aggregate that is
    joined back to the rows it was made of is written first too: Spark then
    shuffles both sides for the join, and AQE can split a hot key, which it
    can't where the join relies on the aggregate's own shuffle.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _written[out] = path
    return out


def discard(spark: SparkSession, *paths: str) -> None:
    """Deletes folders made by ``new_folder`` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        if "/dimforge-llm/" not in path:
            raise ValueError(f"not a folder of this package: {path}")
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def table_folder(df: DataFrame) -> str:
    """The folder of a frame that ``materialize`` returned."""
    return _written[df]


def total(df: DataFrame, *sums: str) -> tuple[int, ...]:
    """(rows, sum of each named column) in one job; an empty table gives zeros."""
    row = df.agg(F.count("*").alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(sums)]).first()
    return tuple(int(x or 0) for x in row)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns, so further columns of any name can't clash."""
    return df.select(*[df[c] for c in columns])
