"""Lookups above the broadcast bound filter the fact before it is shuffled."""

from contextlib import contextmanager

from conftest import SMALL_SF, rows

from dimforge.config import Settings, runtime_filter_conf, session_conf
from dimforge.operators import Lookup, chain_lookups, origin_registry
from dimforge.plans import build_planning
from dimforge.queries import conformed_tables
from dimforge.sources.driver_tables import DriverTables


@contextmanager
def settings_of(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def depths(plan: str, word: str) -> list[int]:
    """How deep in the tree the lines with a word stand."""
    return [len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if word in line]


def test_fact_rows_without_a_match_go_before_the_shuffle(spark):
    raw, reg = DriverTables(spark, SMALL_SF).planning_raw(), origin_registry(spark)
    dims = conformed_tables(spark, SMALL_SF)
    broadcast = rows(build_planning(raw, dims, reg))
    with settings_of(spark, runtime_filter_conf(least_scan="0")):
        shuffled = build_planning(raw, dims, reg, settings=Settings(broadcast_max_rows=0))
        lines = shuffled._jdf.queryExecution().optimizedPlan().toString().splitlines()
        filters = [i for i, line in enumerate(lines) if "might_contain" in line and "l_orderkey" in line]
        total = next(i for i, line in enumerate(lines) if "Aggregate" in line and "sum(" in line)
        # between the scan and the grain sum, the first shuffle of the current system's fact
        assert filters and total < filters[0]
        assert rows(shuffled) == broadcast


def test_small_scans_get_no_filter(spark):
    assert session_conf(4)["spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"] == "10g"
    t = DriverTables(spark, SMALL_SF)
    fact = t.table("lineitem").select("l_partkey", "l_quantity")
    look = t.table("part").where("p_size > 40").selectExpr("p_partkey AS l_partkey", "p_brand")
    plain = chain_lookups(fact, [Lookup(look, "l_partkey")], Settings(broadcast_max_rows=0))
    with settings_of(spark, runtime_filter_conf()):
        assert "might_contain" not in plain.select("*")._jdf.queryExecution().optimizedPlan().toString()
    with settings_of(spark, runtime_filter_conf(least_scan="0")):
        filtered = chain_lookups(fact, [Lookup(look, "l_partkey")], Settings(broadcast_max_rows=0))
        plan = filtered._jdf.queryExecution().executedPlan().toString()
        assert min(depths(plan, "might_contain")) > min(depths(plan, "Exchange hashpartitioning"))
        assert rows(filtered) == rows(plain)
