"""A hot key (over a third of the fact rows) on the shuffle-join fallback path:
AQE splits the skewed partition, and every row is still joined."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from dimforge.config import Settings
from dimforge.operators import Lookup, chain_lookups, merge_lookups

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextmanager
def skew_settings(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_fact(spark, n, kind="bigint"):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast(kind).alias("k"), F.col("id").alias("row"))


def test_hot_key_is_split_and_complete(spark):
    with skew_settings(spark):
        n = 30_000
        dim = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
        out = chain_lookups(hot_fact(spark, n), [Lookup(dim, "k")], Settings(broadcast_max_rows=0))
        result = out.collect()
        assert len(result) == n and sum(1 for r in result if r["k"] == 0) == n // 3
        assert all(r["v"] == r["k"] * 10 for r in result)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan


def test_hot_key_of_two_lookups_is_split_and_complete(spark):
    with skew_settings(spark):
        n = 30_000
        a = spark.range(n).select(F.col("id").cast("string").alias("k"), (F.col("id") * 10).alias("va"))
        b = spark.range(n).select(F.col("id").cast("string").alias("k"), (F.col("id") * 20).alias("vb"))
        out = chain_lookups(hot_fact(spark, n, "string"), [Lookup(merge_lookups(a, b, "k"), "k")],
                            Settings(broadcast_max_rows=0))
        result = out.collect()
        assert len(result) == n and all(r["vb"] == 2 * r["va"] == 20 * int(r["k"]) for r in result)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
