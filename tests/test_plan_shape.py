"""Physical plan shape of the flagship build, and the shuffle-join fallback."""

from conftest import SMALL_SF

from dimforge.config import Settings
from dimforge.operators import origin_registry
from dimforge.plans import build_field, build_planning
from dimforge.queries import conformed_plan, conformed_tables
from dimforge.sources.driver_tables import DriverTables


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_lookups_are_broadcast_hash_joins(spark):
    plan = conformed_plan(spark, SMALL_SF)
    text = executed(plan)
    # the one shuffle join merges two lookups of the site key; AQE may broadcast it when it runs
    assert text.count("SortMergeJoin") == 1 and "SortMergeJoin [K_SITE" in text
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    # 8 current-system lookups, 2 semi joins and 5 legacy lookups, plus the registry
    assert text.count("BroadcastHashJoin") >= 16


def test_prefix_filter_of_legacy_fields_is_pushed(spark):
    text = build_field(DriverTables(spark, SMALL_SF).field_raw(), origin_registry(spark))._jdf \
        .queryExecution().executedPlan().toString()
    assert "StringStartsWith(p_type,P)" in text


def test_shuffle_join_fallback_gives_same_rows(spark):
    dims = conformed_tables(spark, SMALL_SF, materialize=False)
    raw = DriverTables(spark, SMALL_SF).planning_raw()
    reg = origin_registry(spark)
    broadcast = build_planning(raw, dims, reg)
    shuffled = build_planning(raw, dims, reg, settings=Settings(broadcast_max_rows=0))
    plan = shuffled._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan
    assert broadcast.exceptAll(shuffled).count() == 0 and shuffled.exceptAll(broadcast).count() == 0
    assert broadcast.count() > 0


def test_scenarios_are_filtered_below_the_grain_sum(spark):
    plan = conformed_plan(spark, SMALL_SF)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    lines = text.splitlines()
    semi = next(i for i, line in enumerate(lines) if "Join LeftSemi" in line and "K_SCENARIO" in line)
    total = next(i for i, line in enumerate(lines) if "Aggregate" in line and "sum(" in line)
    assert total < semi  # deeper in the tree


def test_legacy_lookups_read_their_origin_only(spark):
    text = executed(conformed_plan(spark, SMALL_SF))
    for key in ("ID_LAV_FISICA", "ID_VARIEDADE", "ID_SEDE"):
        assert f"StringStartsWith({key},1000)" in text
    # one join with the fact on the site key
    assert text.count("K_SITE") > 0 and "_nondeterministic" not in text


def test_no_query_shuffles_by_a_random_key(spark):
    text = build_field(DriverTables(spark, SMALL_SF).field_raw(), origin_registry(spark))._jdf \
        .queryExecution().executedPlan().toString()
    assert "_nondeterministic" not in text
