"""What lookups above the broadcast bound make the fact shuffle."""

from dataclasses import replace

from conftest import SMALL_SF, rows
from pyspark.sql import functions as F

from dimforge.audit import Audit
from dimforge.config import Settings
from dimforge.operators import Lookup, chain_lookups, origin_registry, stage
from dimforge.operators.joins import bounded_fits
from dimforge.plans import build_planning
from dimforge.queries import conformed_tables
from dimforge.sources.driver_tables import DriverTables


def test_distinct_of_few_rows_of_a_large_table_is_small(spark):
    few = stage(spark.range(5000), [(F.col("id") % 7).alias("k")])
    many = stage(spark.range(5000), [(F.col("id") % 1700).alias("k")])
    assert bounded_fits([few, many], 100, 1 << 20) == [True, False]
    # the bytes count too, and a check by rows alone
    assert bounded_fits([few], 100, 8) == [False] and bounded_fits([few], 100) == [True]
    fact = spark.range(100).select((F.col("id") % 9).alias("k"))
    out = chain_lookups(fact, [Lookup(few, "k", "left_semi")], Settings(broadcast_max_rows=100))
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == sum(i % 9 < 7 for i in range(100))


def test_columns_of_broadcast_lookups_are_not_shuffled(spark):
    fact = spark.range(2000).select(F.col("id").alias("big"), (F.col("id") % 30).alias("small"))
    big = spark.range(1500).select(F.col("id").alias("big"), F.lit("b").alias("of_big"))
    wider = spark.range(1500).select(F.col("id").alias("big"), F.lit("x").alias("w1"), F.lit("y").alias("w2"))
    small = spark.range(20).select(F.col("id").alias("small"), F.concat(F.lit("name"), "id").alias("name"), F.lit("z").alias("more"))
    lookups = [Lookup(wider, "big"), Lookup(small, "small"), Lookup(big, "big")]
    out = chain_lookups(fact, lookups, Settings(broadcast_max_rows=100))
    tree = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line for line in tree if "Join " in line]
    # from the top: the small lookup's columns, the wider one, the narrow one, the small one's keys
    assert "small" in joins[0] and "Inner" in joins[0] and "big" in joins[1] and "big" in joins[2]
    assert "LeftSemi" in joins[3] and "small" in joins[3]
    plain = chain_lookups(fact, lookups, Settings())
    assert rows(out, *sorted(out.columns)) == rows(plain, *sorted(plain.columns)) and out.count() == 1000


def test_the_fact_has_no_wide_distinct_and_the_same_rows(spark):
    raw, reg = DriverTables(spark, SMALL_SF).planning_raw(), origin_registry(spark)
    dims = conformed_tables(spark, SMALL_SF)
    # copies of conformed rows, and another name of some varieties
    dims = replace(dims, field=dims.field.unionAll(dims.field), crop=dims.crop.unionAll(dims.crop),
                   variety=dims.variety.unionAll(dims.variety.where("ID_DOMAIN % 3 = 0").withColumn("COD_VARIEDADE", F.lit("other"))))
    # plan rows that differ only in what the fact does not show
    raw = raw | {"upn3_plan": raw["upn3_plan"].unionAll(raw["upn3_plan"].withColumn("QT_PROD_ESTIM", F.col("QT_PROD_ESTIM") + 1e-9))}
    for settings in (Settings(), Settings(broadcast_max_rows=100)):
        fact = build_planning(raw, dims, reg, settings)
        tree = fact._jdf.queryExecution().optimizedPlan().toString().splitlines()
        parts = next(i for i, line in enumerate(tree) if "Union" in line)
        assert "Aggregate" not in tree[parts + 1]  # the current system's rows, of all columns
        got = rows(fact)
        assert len(got) == len(set(got)) > 0
        # an audited build joins first and drops the duplicates of the whole rows
        assert got == rows(build_planning(raw, dims, reg, replace(settings, audit=Audit())))
