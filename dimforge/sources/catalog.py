"""Raw and conformed tables by name: catalog tables or Parquet folders."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from dimforge.sources.raw_schemas import declared


def quote(identifier: str) -> str:
    """Back-quote each part of ``db.table``."""
    return ".".join(f"`{p.strip('`')}`" for p in identifier.split("."))


class RawTables(Mapping[str, DataFrame]):
    """Logical table name → ``DataFrame``.

    A location holding ``/`` is a Parquet folder (``spark.read.parquet``),
    anything else a catalog name (``spark.table``, names case-insensitive).
    Frames are created lazily, so only the tables a plan reads are scanned,
    and only the columns it uses (Parquet column pruning).  A declared raw
    table (``raw_schemas``) that lacks a column is a named error when it is
    read, or with ``missing="null"`` gets NULLs for it.
    """

    def __init__(self, spark: SparkSession, locations: Mapping[str, str], missing: str = "error"):
        self._spark = spark
        self._locations = dict(locations)
        self._missing = missing

    def __getitem__(self, name: str) -> DataFrame:
        loc = self._locations[name]
        df = self._spark.read.parquet(loc) if "/" in loc else self._spark.table(quote(loc))
        return declared(df, name, self._missing)

    def __iter__(self) -> Iterator[str]:
        return iter(self._locations)

    def __len__(self) -> int:
        return len(self._locations)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS name [LOCATION location]``.

    With a location (a folder in shared storage) the database does not
    depend on the session's warehouse folder."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(name)}{where}")


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Expose frames to SQL as temporary views (the DataFrames themselves
    are what the plans pass around, so a redefined view never changes a
    plan built earlier)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
