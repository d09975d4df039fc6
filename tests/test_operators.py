"""DataFrame operators: staging, filters, lookup joins, union alignment, grouped sums."""

from decimal import Decimal

import pytest
from conftest import SMALL_SF, rows
from pyspark.sql import functions as F

from dimforge.config import Settings
from dimforge.operators import (
    Lookup,
    align,
    attach_origin,
    bounded_fits,
    chain_lookups,
    conform_origins,
    conform_union,
    group_sum,
    in_list,
    lookup_join,
    origin_cutover,
    origin_registry,
    semi_join,
    stage,
    starts_with,
)
from dimforge.schemas import parse_schema


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stage_filters_raw_then_projects_and_dedups(spark):
    raw = spark.createDataFrame([("1", "P-a"), ("1", "P-a"), ("2", "X-b"), ("3", None)], "id string, code string")
    out = stage(raw, [F.col("id").cast("bigint").alias("ID")], where=starts_with("code", "P"))
    assert rows(out) == [(1,)]
    assert stage(raw, ["id"], distinct=False).count() == 4


def test_prefix_filter_reaches_parquet_scan(spark):
    part = spark.read.parquet(f"{SMALL_SF}/part.parquet")
    out = stage(part, ["p_partkey"], where=starts_with("p_brand", "Brand#1"), distinct=False)
    text = plan_text(out)
    assert "StringStartsWith(p_brand,Brand#1)" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string>" in text


def test_in_list_and_cutover(spark):
    df = spark.createDataFrame([(1, 2019), (3, 2020), (4, 2021), (2, 2020)], "s int, y int")
    assert rows(df.where(in_list("s", (3, 4)))) == [(3, 2020), (4, 2021)]
    assert rows(origin_cutover(df, "y", 2020)) == [(1, 2019), (2, 2020), (3, 2020)]


def test_bounded_fits_checks_row_bound(spark):
    small, big = spark.range(5), spark.range(50)
    assert bounded_fits([small, big], 10) == [True, False]
    assert bounded_fits([small], 3) == [False]


def test_lookup_join_broadcasts_only_under_bound(spark):
    fact = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = lookup_join(fact, dim, "k")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().sparkPlan().toString()
    big = lookup_join(fact, dim, "k", settings=Settings(broadcast_max_rows=5))
    assert "SortMergeJoin" in big._jdf.queryExecution().sparkPlan().toString()
    assert rows(small) == rows(big)


def test_left_lookup_keeps_unmatched_and_inner_drops(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "a")], "k int, v string")
    assert rows(lookup_join(fact, dim, "k", "left")) == [(None, None), (1, "a"), (2, None)]
    assert rows(lookup_join(fact, dim, "k")) == [(1, "a")]


def test_semi_join_adds_no_duplicate(spark):
    fact = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    active = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(semi_join(fact, active, "k")) == [(1, "x")]


def test_chain_lookups_snowflake(spark):
    site = spark.createDataFrame([(1, 10), (2, 20)], "s int, u int")
    unit = spark.createDataFrame([(10, 100), (20, 200)], "u int, c int")
    city = spark.createDataFrame([(100, "Rio")], "c int, name string")
    out = chain_lookups(site, [Lookup(unit, "u"), Lookup(city, "c", "left")])
    assert rows(out, "s", "name") == [(1, "Rio"), (2, None)]


def test_align_is_positional_with_declared_types(spark):
    schema = parse_schema("ID bigint, AREA decimal(22,6), NAME string")
    df = spark.createDataFrame([(1, 2.5, "a")], "other int, x double, y string")
    out = align(df, schema)
    assert out.columns == ["ID", "AREA", "NAME"]
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "decimal(22,6)", "string"]
    with pytest.raises(ValueError):
        align(df.select("other"), schema)


def test_conform_union_widens_and_dedups(spark):
    schema = parse_schema("ID bigint, VAL decimal(22,6), D timestamp")
    a = spark.sql("SELECT 1 AS a, CAST(1.25 AS DECIMAL(18,2)) AS b, DATE'2020-01-02' AS c")
    b = spark.sql("SELECT 2 AS a, CAST(0.123456 AS DECIMAL(18,6)) AS b, CAST(NULL AS TIMESTAMP) AS c")
    out = conform_union([a, b, a], schema)
    assert out.count() == 2
    assert out.schema.simpleString() == "struct<ID:bigint,VAL:decimal(22,6),D:timestamp>"


def test_conform_union_missing_column(spark):
    schema = parse_schema("ID bigint, NAME string, EXTRA string")
    a = spark.createDataFrame([(1, "a")], "x int, y string")
    b = spark.createDataFrame([(2, "b", "e")], "p int, q string, r string")
    assert rows(conform_union([a, b], schema, allow_missing=True)) == [(1, "a", None), (2, "b", "e")]


def test_conform_origins_labels_and_drops_unregistered(spark):
    schema = parse_schema("ID_DOMAIN bigint, ID_ORIGEM_DB int, ORIGEM_DB string, NAME string")
    cur = spark.createDataFrame([(1, 2000, "a"), (1, 2000, "a")], "i int, o int, n string")
    leg = spark.createDataFrame([(9, 1000, "z"), (5, 3000, "ghost")], "i int, o int, n string")
    out = conform_origins([cur, leg], schema, origin_registry(spark))
    assert out.columns == ["ID_DOMAIN", "ID_ORIGEM_DB", "ORIGEM_DB", "NAME"]
    assert rows(out) == [(1, 2000, "CURRENT", "a"), (9, 1000, "LEGACY", "z")]


def test_attach_origin_with_catalog_registry_is_checked(spark):
    reg = spark.createDataFrame([(2000, "CUR")], "ID_DOMAIN int, DESC_BANCO_DADOS string")
    df = spark.createDataFrame([(1, 2000)], "x int, ID_ORIGEM_DB int")
    assert rows(attach_origin(df, reg)) == [(1, 2000, "CUR")]


def test_group_sum_casts_after_sum(spark):
    df = spark.createDataFrame([("a", 1.5), ("a", 2.25), ("b", None)], "k string, v double")
    out = group_sum(df, ["k"], "v", "TOTAL", "decimal(18,6)")
    assert out.schema["TOTAL"].dataType.simpleString() == "decimal(18,6)"
    assert rows(out) == [("a", Decimal("3.750000")), ("b", None)]


def test_broadcast_lookups_join_before_shuffle_joins(spark):
    fact = spark.range(200).select((F.col("id") % 50).alias("a"), (F.col("id") % 7).alias("b"))
    big = spark.range(50).select(F.col("id").alias("a"), F.lit("x").alias("va"))
    small = spark.createDataFrame([(1, "one"), (2, "two")], "b long, vb string")
    chain = [Lookup(big, "a", broadcast=False), Lookup(small, "b")]
    out = chain_lookups(fact, chain)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    # the filtering broadcast join sits below the sort-merge join
    assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")
    assert rows(out, "a", "b", "va", "vb") == rows(fact.join(big, "a").join(small, "b"), "a", "b", "va", "vb")


def test_join_order_respects_key_dependencies(spark):
    site = spark.createDataFrame([(1, 10)], "s int, u int")
    unit = spark.createDataFrame([(10, 100)], "u int, c int")
    city = spark.createDataFrame([(100, "Rio")], "c int, name string")
    # the city lookup needs c from the unit lookup, whatever the broadcast decisions
    out = chain_lookups(site, [Lookup(unit, "u", broadcast=False), Lookup(city, "c")])
    assert rows(out, "s", "name") == [(1, "Rio")]


def test_byte_bound_of_wide_lookup(spark):
    wide = spark.createDataFrame([(i, "x" * 1000) for i in range(3)], "k int, text string")
    assert bounded_fits([wide], 10) == [True]
    assert bounded_fits([wide], 10, 2000) == [False]
    assert bounded_fits([wide.limit(1)], 10, 2000) == [True]
    fact = spark.range(10).select(F.col("id").cast("int").alias("k"))
    out = lookup_join(fact, wide, "k", settings=Settings(broadcast_max_bytes=2000))
    assert "SortMergeJoin" in out._jdf.queryExecution().sparkPlan().toString()
    assert out.count() == 3


def test_chain_broadcast_budget_keeps_smallest(spark):
    fact = spark.range(20).select(F.col("id").cast("int").alias("k"))
    lookups = [spark.createDataFrame([(i, "x" * width) for i in range(3)], f"k int, v{n} string")
               for n, width in enumerate((300, 100, 200))]
    # each fits the per-lookup bound; together (~1.8 KB) they exceed a 1 KB budget
    out = chain_lookups(fact, [Lookup(lk, "k") for lk in lookups],
                        Settings(broadcast_max_bytes=10_000, broadcast_budget_bytes=1_000))
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1
    assert out.count() == 3


def test_two_shuffle_joins_on_one_key_shuffle_the_fact_once(spark):
    fact = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").alias("row"))
    a = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("va"))
    b = spark.range(100).select(F.col("id").alias("k"), F.lit("b").alias("vb"))
    out = chain_lookups(fact, [Lookup(a, "k"), Lookup(b, "k")], Settings(broadcast_max_rows=0))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("Exchange hashpartitioning") == 3   # fact once, each lookup once
    assert out.count() == 1000


def test_unproven_lookup_is_not_broadcast_by_session_threshold(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        fact = spark.range(100).withColumnRenamed("id", "k")
        dim = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        out = lookup_join(fact, dim, "k", settings=Settings(broadcast_max_rows=5))
        assert "SortMergeJoin" in out._jdf.queryExecution().sparkPlan().toString()
        assert out.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_file_that_passes_the_bound_is_not_counted(spark, tmp_path):
    from dimforge.operators.joins import _too_large

    path = str(tmp_path / "wide")
    spark.range(2000).selectExpr("id AS k", "sha2(CAST(id AS STRING), 512) AS v").write.parquet(path)
    df = spark.read.parquet(path)
    assert _too_large(df, 10_000) and not _too_large(df, 100_000_000)
    assert not _too_large(spark.range(5), 1) and not _too_large(df.join(df, "k"), 1)
    assert bounded_fits([df], 10_000, 10_000) == [False]


def test_a_distinct_is_counted_by_the_rows_under_it(spark):
    staged = stage(spark.range(10).selectExpr("id % 2 AS k"), ["k"])
    assert staged.count() == 2
    assert bounded_fits([staged], 5) == [False] and bounded_fits([staged], 10) == [True]


def test_disjoint_origins_have_a_distinct_each(spark):
    from dimforge.operators import conform_origins, origin_registry
    from dimforge.schemas import parse_schema

    schema = parse_schema("ID bigint, ID_ORIGEM_DB int, ORIGEM_DB string, NOME string")
    a = spark.createDataFrame([(1, 2000, "x"), (1, 2000, "x"), (2, 2000, None), (2, 2000, None)], "i int, o int, n string")
    b = spark.createDataFrame([(1, 1000, "x"), (1, 1000, "x"), (3, 1000, "y")], "i int, o int, n string")
    twice = spark.createDataFrame([(1000, "L"), (2000, "C"), (2000, "C"), (2000, "D")], "ID_DOMAIN int, DESC_BANCO_DADOS string")
    for registry in (origin_registry(spark), twice):
        apart = conform_origins([a, b], schema, registry, disjoint=True)
        assert rows(apart) == rows(conform_origins([a, b], schema, registry)) and apart.schema.names == schema.names
    repeated = origin_registry(spark, ((1000, "L"), (1000, "L"), (2000, "C")))
    assert rows(conform_origins([a, b], schema, repeated, disjoint=True)) == rows(conform_origins([a, b], schema, repeated))
    plan = apart._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan
