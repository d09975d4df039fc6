"""Registered queries over the test tables: name -> f(spark, sf_dir) -> DataFrame.

Every query reads whole test tables and runs the package's own functions,
operators and builds on them; ``dimforge.oracle`` holds the same results
written as DuckDB SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge import schemas
from dimforge.config import Settings
from dimforge.functions import season_key_current as season_key_current_fn
from dimforge.functions import season_key_legacy as season_key_legacy_fn
from dimforge.functions import (
    COMPACT_STAMP,
    DAY_MONTH_YEAR,
    business_key,
    first_available,
    flag_label,
    origin_key,
    positive_or_null,
    strip_separators,
    tax_id_mask,
    title_case,
    to_date,
    trimmed,
    typed,
    typed_constant,
)
from dimforge.operators import (
    Lookup,
    chain_lookups,
    conform_origins,
    conform_union,
    contains,
    group_sum,
    in_list,
    origin_cutover,
    origin_registry,
    semi_join,
    stage,
    starts_with,
)
from dimforge.plans import (
    ConformedTables,
    build_field,
    build_planning,
    build_site,
    build_site_analysis,
    build_variety,
    planning,
    site,
    variety,
)
from dimforge.schemas import parse_schema
from dimforge.sources.catalog import RawTables, register_views
from dimforge.sources.driver_tables import DriverTables
from dimforge.sources.snapshot import input_token, preview, publish, snapshot_once, snapshot_path
from dimforge.plans import loads

Query = Callable[[SparkSession, str], DataFrame]


def conformed_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physical-field table: both origins through staging, keys, registry, union.

    As in the original load, the legacy rows are written to a Parquet
    snapshot (a fresh folder under the shared folder) and read back before
    the union, which cuts their lineage.
    """
    snapshot = snapshot_path(spark, "field-legacy", uuid.uuid4().hex[:12])
    return build_field(DriverTables(spark, sf_dir).field_raw(), origin_registry(spark), Settings.from_conf(spark),
                       legacy_snapshot=snapshot)


def conformed_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site table: snowflake of five lookups (region optional) + legacy companies (region required)."""
    return build_site(DriverTables(spark, sf_dir).site_raw(), origin_registry(spark), Settings.from_conf(spark))


def conformed_site_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site analysis variant: 12-column current rows and 13-column legacy rows."""
    return build_site_analysis(DriverTables(spark, sf_dir).site_raw(), origin_registry(spark),
                               Settings.from_conf(spark))


def conformed_variety(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variety table: item, detail and group lookups with fallbacks and labels."""
    return build_variety(DriverTables(spark, sf_dir).variety_raw(), origin_registry(spark), Settings.from_conf(spark))


def conformed_tables(spark: SparkSession, sf_dir: str, materialize: bool = True) -> ConformedTables:
    """The conformed tables the planning fact reads.

    As in a real load the field, variety and site tables are built first and
    written to the shared folder (a fresh folder per call), and the fact
    reads them from there: their lineage is cut, and the broadcast checks of
    the fact count small Parquet tables instead of recomputing the builds.
    The three builds are independent, so they are written concurrently
    (one driver thread each; Spark interleaves their jobs).
    """
    t = DriverTables(spark, sf_dir)
    reg = origin_registry(spark)
    cfg = Settings.from_conf(spark)
    builds = {
        "field": lambda: build_field(t.field_raw(), reg, cfg),
        "variety": lambda: build_variety(t.variety_raw(), reg, cfg),
        "site": lambda: build_site(t.site_raw(), reg, cfg),
    }
    if materialize:
        run = uuid.uuid4().hex[:12]

        def write(name: str) -> DataFrame:
            return snapshot_once(builds[name](), snapshot_path(spark, "conformed", run, name), partition_by=loads.ORIGIN)

        with ThreadPoolExecutor(max_workers=len(builds)) as pool:
            done = dict(zip(builds, pool.map(write, builds)))
    else:
        done = {name: make() for name, make in builds.items()}
    return ConformedTables(field=done["field"], season=t.season(), variety=done["variety"], crop=t.crop(),
                           site=done["site"], farm=t.farm())


def conformed_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planning fact: grouped current rows joined to eight lookups, legacy rows
    (semi join on active simulations, cut-over year) joined on computed keys."""
    dims = conformed_tables(spark, sf_dir)
    return build_planning(DriverTables(spark, sf_dir).planning_raw(), dims, origin_registry(spark),
                          Settings.from_conf(spark))


def load_all_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole load in run order, through the catalog: the season, crop and
    farm inputs are published first, then ``loads.load_all`` publishes the
    field, site and variety tables and the planning fact built from the
    published tables (a fresh database per call); the fact is read back."""
    t = DriverTables(spark, sf_dir)
    owner = f"dimforge_load_{uuid.uuid4().hex[:10]}"
    base = snapshot_path(spark, "published")
    for table, df in ((loads.SEASON_TABLE, t.season()), (loads.CROP_TABLE, t.crop()), (loads.FARM_TABLE, t.farm())):
        publish(df, owner, table, base)
    raw = {**t.field_raw(), **t.site_raw(), **t.variety_raw(), **t.planning_raw()}
    loads.load_all(raw, origin_registry(spark), owner, base, Settings.from_conf(spark))
    return loads.published(spark, owner, loads.PLANNING_TABLE)


# ---------------------------------------------------------------- operators
def _t(spark: SparkSession, sf_dir: str) -> DriverTables:
    return DriverTables(spark, sf_dir)


def stage_cast_distinct(spark, sf_dir):
    """Typed, renamed projection with origin tag, placeholders and typed NULL, then DISTINCT."""
    customer = _t(spark, sf_dir).table("customer")
    return stage(customer, [
        typed("c_nationkey", "bigint").alias("ID_DOMAIN"),
        F.lit(schemas.CURRENT).alias("ID_ORIGEM_DB"),
        F.col("c_mktsegment").alias("SEGMENTO"),
        typed_constant("TBD", "string").alias("FORNECEDOR"),
        typed_constant(0, "decimal(18,6)").alias("PRODUCAO"),
        typed_constant(None, "timestamp").alias("DATA_INATIVACAO"),
        typed("c_nationkey", "int").alias("ID_PAIS"),
    ])


def filter_prefix(spark, sf_dir):
    """``LEFT(x, n) = p`` as a prefix test pushed to the Parquet scan."""
    part = _t(spark, sf_dir).table("part")
    return stage(part, ["p_partkey", "p_brand", "p_name"], where=starts_with("p_brand", "Brand#1"),
                 distinct=False)


def filter_in(spark, sf_dir):
    """Active simulations: ``IN (3, 4)`` filter, typed, distinct (legacy staging)."""
    return planning.stage_simulations(_t(spark, sf_dir).planning_raw()["ga_prp_simula"])


def filter_cutover(spark, sf_dir):
    """Legacy rows up to a last season year."""
    orders = _t(spark, sf_dir).table("orders")
    staged = stage(orders, [
        F.col("o_orderkey").alias("ID_DIVI4"),
        F.year("o_orderdate").alias("SAF_ANO_SAFRA"),
        typed("o_totalprice", "decimal(18,2)").alias("VALOR"),
    ], distinct=False)
    return origin_cutover(staged, "SAF_ANO_SAFRA", 1999)


def filter_contains(spark, sf_dir):
    """``LIKE '%x%'`` row filter."""
    part = _t(spark, sf_dir).table("part")
    return stage(part, ["p_partkey", "p_name"], where=contains("p_name", "red"), distinct=False)


def filter_conj(spark, sf_dir):
    """Point look at a result: conjunction of equalities."""
    customer = _t(spark, sf_dir).table("customer")
    staged = stage(customer, ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"], distinct=False)
    return preview(staged, c_mktsegment="BUILDING", c_nationkey=3)


ENTITY = parse_schema("ID_DOMAIN bigint, ID_ORIGEM_DB int, ID_ENTIDADE string, ORIGEM_DB string,"
                 " NOME string, ID_PAIS string")


def origin_key_registry(spark, sf_dir):
    """Origin-keyed entities of two systems, unioned, labelled by the registry."""
    t = _t(spark, sf_dir)
    cur = t.table("customer").select(
        F.col("c_custkey").alias("ID_DOMAIN"), F.lit(schemas.CURRENT).alias("ID_ORIGEM_DB"),
        origin_key(schemas.CURRENT, "c_custkey").alias("ID_ENTIDADE"), "c_name",
        origin_key(schemas.CURRENT, "c_nationkey").alias("ID_PAIS"))
    leg = t.table("supplier").select(
        F.col("s_suppkey").alias("ID_DOMAIN"), F.lit(schemas.LEGACY).alias("ID_ORIGEM_DB"),
        origin_key(schemas.LEGACY, "s_suppkey").alias("ID_ENTIDADE"), "s_name",
        origin_key(schemas.LEGACY, "s_nationkey").alias("ID_PAIS"))
    return conform_origins([cur, leg], ENTITY, origin_registry(spark))


def join_composite(spark, sf_dir):
    """Fact rows of two origins matched on (local id, origin id)."""
    t = _t(spark, sf_dir)
    origin = F.when(F.col("l_returnflag") == "R", F.lit(schemas.LEGACY)).otherwise(F.lit(schemas.CURRENT))
    fact = t.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("ID_DOMAIN"),
                                      origin.alias("ID_ORIGEM_DB"))
    part = t.table("part")
    dim = part.select(F.col("p_partkey").alias("ID_DOMAIN"), F.lit(schemas.CURRENT).alias("ID_ORIGEM_DB"),
                      F.col("p_brand").alias("MARCA")).unionByName(
        part.select(F.col("p_partkey").alias("ID_DOMAIN"), F.lit(schemas.LEGACY).alias("ID_ORIGEM_DB"),
                    F.col("p_type").alias("MARCA")))
    return chain_lookups(fact, [Lookup(dim, ["ID_DOMAIN", "ID_ORIGEM_DB"])])


def join_computed_key(spark, sf_dir):
    """Fact matched on a surrogate key (origin || local id) computed on the fact side
    against the lookup's key column."""
    t = _t(spark, sf_dir)
    fact = t.table("lineitem").select("l_orderkey", "l_linenumber",
                                      origin_key(schemas.LEGACY, "l_suppkey").alias("ID_SEDE"))
    dim = t.table("supplier").select(origin_key(schemas.LEGACY, "s_suppkey").alias("ID_SEDE"), "s_name")
    return chain_lookups(fact, [Lookup(dim, "ID_SEDE")])


def _region_lookup(t: DriverTables) -> DataFrame:
    return stage(t.table("nation"), ["n_nationkey", "n_name"], where=F.col("n_regionkey") < 3)


def join_left_lookup(spark, sf_dir):
    """Optional attribute: LEFT join to a filtered lookup."""
    t = _t(spark, sf_dir)
    fact = t.table("customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return chain_lookups(fact, [Lookup(_region_lookup(t), "n_nationkey", "left")])


MIXED = parse_schema("ID_DOMAIN bigint, ID_ORIGEM_DB int, NACAO string")


def join_mixed_optionality(spark, sf_dir):
    """Same lookup, LEFT for one origin and INNER for the other, then union."""
    t = _t(spark, sf_dir)
    look = _region_lookup(t)
    cur = chain_lookups(t.table("customer").select(
        F.col("c_custkey").alias("ID_DOMAIN"), F.lit(schemas.CURRENT).alias("ID_ORIGEM_DB"),
        F.col("c_nationkey").alias("n_nationkey")), [Lookup(look, "n_nationkey", "left")])
    leg = chain_lookups(t.table("supplier").select(
        F.col("s_suppkey").alias("ID_DOMAIN"), F.lit(schemas.LEGACY).alias("ID_ORIGEM_DB"),
        F.col("s_nationkey").alias("n_nationkey")), [Lookup(look, "n_nationkey", "inner")])
    return conform_union([cur.select("ID_DOMAIN", "ID_ORIGEM_DB", "n_name"),
                          leg.select("ID_DOMAIN", "ID_ORIGEM_DB", "n_name")], MIXED)


def join_snowflake(spark, sf_dir):
    """Chain supplier -> nation -> region (each key from the previous lookup)."""
    t = _t(spark, sf_dir)
    out = chain_lookups(t.table("supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey")), [
        Lookup(t.table("nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey")), "n_nationkey"),
        Lookup(t.table("region").select("r_regionkey", "r_name"), "r_regionkey"),
    ])
    return out.select("s_suppkey", "s_name", "n_name", "r_name")


def join_star(spark, sf_dir):
    """Fact joined to six lookups (two levels deep through customer -> nation -> region)."""
    t = _t(spark, sf_dir)
    fact = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    out = chain_lookups(fact, [
        Lookup(t.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus"), "l_orderkey"),
        Lookup(t.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"), "o_custkey"),
        Lookup(t.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey"),
        Lookup(t.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey"),
        Lookup(t.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"), "c_nationkey"),
        Lookup(t.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey"),
    ])
    return out.select("l_orderkey", "l_linenumber", "o_orderstatus", "c_name", "p_brand", "s_name", "n_name",
                      "r_name", typed("l_quantity", "decimal(18,2)").alias("l_quantity"))


def semi_active(spark, sf_dir):
    """Rows whose order is open or pending (semi join: no column, no duplicate added)."""
    t = _t(spark, sf_dir)
    active = stage(t.table("orders"), [F.col("o_orderkey").alias("l_orderkey")],
                   where=in_list("o_orderstatus", ["O", "P"]))
    return semi_join(t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
                     active, "l_orderkey")


def group_sum_area(spark, sf_dir):
    """Grouped sum cast to decimal(18,6)."""
    lineitem = _t(spark, sf_dir).table("lineitem")
    return group_sum(lineitem, ["l_suppkey", "l_returnflag", "l_linestatus"], "l_quantity", "QT_AREA_PROD",
                     "decimal(18,6)", value_type=planning.AREA)


def plan_staging(spark, sf_dir):
    """Planning staging: sum per raw grain, typed after the sum, DISTINCT after the types."""
    raw = _t(spark, sf_dir).planning_raw()["upn3_plan"]
    return planning.stage_plan(raw, distinct=True)


def group_then_date_distinct(spark, sf_dir):
    """Sum per raw timestamp, projected to the date, then DISTINCT (equal day rows merge)."""
    events = _t(spark, sf_dir).table("events").select(
        "user_id", "event_type", "ts", F.floor(F.col("value") / 100).alias("coarse"))
    summed = group_sum(events, ["user_id", "event_type", "ts"], "coarse", "TOTAL")
    return stage(summed, ["user_id", "event_type", to_date("ts").alias("DIA"),
                          typed("TOTAL", "decimal(18,6)").alias("TOTAL")])


WIDE = parse_schema("ID bigint, VALOR decimal(22,6), DATA timestamp")


def union_widen_distinct(spark, sf_dir):
    """Positional union of decimal(18,2)/date and decimal(18,6)/NULL timestamp, then DISTINCT."""
    t = _t(spark, sf_dir)
    a = t.table("orders").select("o_orderkey", typed("o_totalprice", "decimal(18,2)"), to_date("o_orderdate"))
    b = t.table("part").select("p_partkey", typed("p_retailprice", "decimal(18,6)"),
                               typed_constant(None, "timestamp"))
    return conform_union([a, b, a], WIDE)


MISSING = parse_schema("ID bigint, NOME string, PAIS int, SALDO decimal(18,2)")


def union_missing_column(spark, sf_dir):
    """Union of a 3-column side and a 4-column side (missing column as NULL)."""
    t = _t(spark, sf_dir)
    a = t.table("customer").select("c_custkey", "c_name", "c_nationkey")
    b = t.table("supplier").select("s_suppkey", "s_name", "s_nationkey", typed("s_acctbal", "decimal(18,2)"))
    return conform_union([a, b], MISSING, allow_missing=True)


def season_key_current(spark, sf_dir):
    """Current-system season key (ERP code, else dash part, else '-1'), via the period staging."""
    orders = _t(spark, sf_dir).table("orders")
    status = F.col("o_orderstatus")
    periods = orders.select(
        F.col("o_orderkey").alias("ID_PERIODOSAFRA"),
        F.year("o_orderdate").alias("ID_SAFRA"),
        F.when(status == "F", status).alias("CD_INT_ERP"),
        F.when(status == "P", status).otherwise(F.col("o_orderpriority")).alias("DE_PER_SAFRA"),
        F.col("o_custkey").alias("ID_OCUPACAO"),
    )
    return planning.stage_periods(periods)


def _season_codes(t: DriverTables) -> DataFrame:
    return t.table("orders").select(
        "o_orderkey",
        F.concat(F.date_format("o_orderdate", "yyyy/MM"),
                 F.when(F.col("o_orderstatus") == "F", F.lit("-2")).otherwise(F.lit(""))).alias("COD_SAFRA"))


def season_key_legacy(spark, sf_dir):
    """Legacy season key: first four characters, then the 9th or '1'; plus the stripped code."""
    codes = _season_codes(_t(spark, sf_dir))
    return codes.select("o_orderkey", "COD_SAFRA", season_key_legacy_fn("COD_SAFRA").alias("ID_SAFRA"),
                        strip_separators("COD_SAFRA").alias("COD_SAFRA_LIMPO"))


def strip_separators_query(spark, sf_dir):
    """Separators '/' and '-' removed from codes."""
    orders = _t(spark, sf_dir).table("orders")
    return orders.select("o_orderkey", strip_separators("o_orderpriority").alias("PRIORIDADE"),
                         strip_separators(F.date_format("o_orderdate", "yyyy/MM-dd")).alias("DATA_LIMPA"))


def site_code(spark, sf_dir):
    """Legacy company staging: FZ prefix filter, farm and site codes, names, tax id."""
    return site.stage_companies(_t(spark, sf_dir).site_raw()["ga_empr"])


def flags_fallbacks(spark, sf_dir):
    """Positive-or-NULL, the two systems' flag labels, and item-else-group fallback."""
    part = _t(spark, sf_dir).table("part")
    ptype = F.col("p_type")
    legacy_flag = F.when(ptype == "SMALL", F.lit(1)).when(ptype == "PROMO", F.lit(0))
    item = positive_or_null(F.col("p_size") - 25)
    return part.select(
        "p_partkey",
        item.alias("CICLO_ITEM"),
        flag_label(F.substring(ptype, 1, 1), "S", "Sim", "Não").alias("TRANSGENIA_ATUAL"),
        flag_label(legacy_flag, 1, "SIM", "NAO").alias("TRANSGENIA_LEGADO"),
        first_available(item, typed(F.substring("p_brand", 7, 2), "int")).alias("CICLO_VARIEDADE"),
    )


def business_key_query(spark, sf_dir):
    """Many-part business key and two-part surrogate key."""
    lineitem = _t(spark, sf_dir).table("lineitem")
    return lineitem.select(
        business_key(F.lit(schemas.CURRENT), "l_orderkey", "l_partkey", "l_suppkey",
                     "l_linestatus").alias("ID_PLANEJAMENTO_AGRICOLA"),
        origin_key(schemas.CURRENT, "l_orderkey").alias("ID_LAV_LOGICA"),
        "l_linenumber")


def names_trim_initcap(spark, sf_dir):
    """Title case by blank-separated words; trimmed codes."""
    part = _t(spark, sf_dir).table("part")
    return part.select("p_partkey", title_case("p_name").alias("NOME"),
                       trimmed(F.concat(F.lit("  "), F.col("p_brand"), F.lit(" "))).alias("MARCA"),
                       title_case("p_type").alias("TIPO"))


def date_formats(spark, sf_dir):
    """Dates from timestamps, from dd/MM/yyyy and yyyyMMddHHmmss text; malformed text is NULL."""
    orders = _t(spark, sf_dir).table("orders")
    return orders.select(
        "o_orderkey",
        to_date("o_orderdate").alias("DATA"),
        to_date(F.date_format("o_orderdate", "dd/MM/yyyy"), DAY_MONTH_YEAR).alias("DATA_DMY"),
        to_date(F.date_format("o_orderdate", "yyyyMMddHHmmss"), COMPACT_STAMP).alias("DATA_CARIMBO"),
        to_date("o_orderpriority", DAY_MONTH_YEAR).alias("DATA_INVALIDA"),
    )


def tax_id_mask_query(spark, sf_dir):
    """Company tax id layout; digits-only extraction; redacted form; over-long ids kept whole."""
    customer = _t(spark, sf_dir).table("customer")
    key = F.col("c_custkey").cast("string")
    return customer.select(
        "c_custkey",
        tax_id_mask(key).alias("CNPJ"),
        tax_id_mask("c_name").alias("CNPJ_NOME"),
        tax_id_mask(key, redact=True).alias("CNPJ_OCULTO"),
        tax_id_mask(F.concat(F.lpad(key, 10, "9"), F.lpad(key, 6, "0"))).alias("CNPJ_LONGO"),
    )


def site_unmatched(spark, sf_dir):
    """Sites that miss a unit, branch, town, state or region, with a flag for each."""
    return site.unmatched_sites(DriverTables(spark, sf_dir).site_raw(), Settings.from_conf(spark))


def _customer_stage(t: DriverTables) -> DataFrame:
    return stage(t.table("customer"), [
        typed("c_custkey", "bigint").alias("ID_DOMAIN"),
        F.col("c_name").alias("NOME"),
        typed("c_acctbal", "decimal(18,2)").alias("SALDO"),
    ])


def snapshot_roundtrip(spark, sf_dir):
    """Materialise once: the first call writes the snapshot, the second reads it back."""
    path = snapshot_path(spark, "snapshot", uuid.uuid4().hex[:12], "customer")
    staged = _customer_stage(_t(spark, sf_dir))
    snapshot_once(staged, path)
    return snapshot_once(staged, path)


def snapshot_stale_redone(spark, sf_dir):
    """Snapshots that are redone: of fewer columns, and of another input; then one that is not."""
    path = snapshot_path(spark, "snapshot", uuid.uuid4().hex[:12], "stale")
    customer = _t(spark, sf_dir).table("customer")
    staged = _customer_stage(_t(spark, sf_dir))
    token = input_token(customer)
    snapshot_once(staged.select("ID_DOMAIN", "NOME"), path, token)  # other columns
    snapshot_once(staged.where("ID_DOMAIN % 2 = 0"), path, "half of the rows")  # another input
    snapshot_once(staged, path, token)
    return snapshot_once(staged.where(F.lit(False)), path, token)  # fresh: read, not computed


def reload_one_origin(spark, sf_dir):
    """The site table published for both origins, its legacy rows from half of the companies;
    then the legacy origin alone is built from all of them and published again."""
    raw = DriverTables(spark, sf_dir).site_raw()
    owner, base = f"dimforge_reload_{uuid.uuid4().hex[:10]}", snapshot_path(spark, "published")
    registry, cfg = origin_registry(spark), Settings.from_conf(spark)
    old = {**raw, "ga_empr": raw["ga_empr"].where(F.col("COD_EMPR") % 2 == 0)}
    loads.load_site(old, registry, owner, base, settings=cfg)
    loads.reload_origin(raw, registry, owner, loads.SITE_TABLE, schemas.LEGACY, base, cfg)
    return loads.published(spark, owner, loads.SITE_TABLE)


def publish_roundtrip(spark, sf_dir):
    """Publish to ``owner.table`` (new version folder + catalog swap), read the table back."""
    staged = _customer_stage(_t(spark, sf_dir))
    publish(staged, "dimforge_checks", "customer_stage")
    return spark.table("`dimforge_checks`.`customer_stage`")


def lookup_number_text(spark, sf_dir):
    """A number looked up in a text column (``PRIORITY = 3`` over codes like '3', '003', '3-X')."""
    status = F.col("o_orderstatus")
    digit = F.substring("o_orderpriority", 1, 1)
    codes = stage(_t(spark, sf_dir).table("orders"), [
        "o_orderkey",
        F.when(status == "F", F.concat(F.lit("00"), digit)).when(status == "O", digit)
        .otherwise(F.col("o_orderpriority")).alias("COD_PRIORIDADE"),
    ], distinct=False)
    return preview(codes, COD_PRIORIDADE=3)


def raw_catalog_scan(spark, sf_dir):
    """The field build over raw tables read from the catalog by name, in mixed case."""
    owner = f"dimforge_raw_{uuid.uuid4().hex[:10]}"
    base = snapshot_path(spark, "raw")
    for table, df in DriverTables(spark, sf_dir).field_raw().items():
        publish(df, owner, table, base)
    raw = RawTables(spark, {"Upn3_fisico": f"{owner}.UPN3_Fisico", "ga_saf_divi3": f"{owner.upper()}.Ga_Saf_Divi3"})
    return build_field(raw, origin_registry(spark), Settings.from_conf(spark))


def _malformed(column, every: int, bad: str = "n/a"):
    """A text column in which each row whose key divides by ``every`` holds ``bad``."""
    return F.when(F.col("o_orderkey") % every == 0, F.lit(bad)).otherwise(column.cast("string"))


def text_positive_or_null(spark, sf_dir):
    """Variety details over text columns with malformed values: days over 0, else NULL."""
    orders = _t(spark, sf_dir).table("orders")
    raw = orders.select(
        F.col("o_orderkey").cast("string").alias("ID_VARIEDADE"),
        _malformed(F.col("o_custkey") - 700, 7).alias("QT_DIAS_MATUR"),
        _malformed(F.col("o_custkey"), 5, "").alias("NO_DIA_PLAN_EMER"),
        _malformed(F.col("o_totalprice").cast("decimal(12,2)"), 3).alias("QT_PROD_ESTIM"))
    return variety.stage_variety_details(raw)


def text_in_list(spark, sf_dir):
    """Active simulations where the state is text, some of it not a number."""
    orders = _t(spark, sf_dir).table("orders")
    raw = orders.select(
        F.year("o_orderdate").cast("string").alias("SAF_ANO_SAFRA"),
        _malformed(F.substring("o_orderpriority", 1, 1), 11).alias("COD_SIMULACAO"),
        _malformed(F.when(F.col("o_orderstatus") == "F", F.lit("3")).when(F.col("o_orderstatus") == "O", F.lit("04"))
                   .otherwise(F.lit("2")), 13, "A").alias("SIM_ATIVA"))
    return planning.stage_simulations(raw)


def text_group_sum(spark, sf_dir):
    """Grouped sum of a text column with malformed values, exact to the last digit."""
    orders = _t(spark, sf_dir).table("orders").select(
        "o_custkey", _malformed(F.col("o_totalprice").cast("decimal(18,4)") * F.lit(Decimal("0.333333")), 9).alias("QT_AREA_PROD"))
    return group_sum(orders, ["o_custkey"], "QT_AREA_PROD", "AREA", "decimal(18,6)", value_type=planning.AREA)


def date_plain_malformed(spark, sf_dir):
    """Plain dates from text, some of it malformed."""
    orders = _t(spark, sf_dir).table("orders")
    return orders.select("o_orderkey", to_date(_malformed(F.date_format("o_orderdate", "yyyy-MM-dd"), 4)).alias("DATA"))


def season_key_numeric_erp(spark, sf_dir):
    """Current season key where the ERP code is a number (NULL falls back to the dash part)."""
    orders = _t(spark, sf_dir).table("orders")
    return orders.select("o_orderkey", season_key_current_fn(
        schemas.CURRENT, F.year("o_orderdate"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")), "o_orderpriority").alias("ID_SAFRA"))


def sql_over_view(spark, sf_dir):
    """Ad-hoc SQL over a registered view of a conformed result."""
    register_views({"dimforge_variety": conformed_variety(spark, sf_dir)})
    return spark.sql("SELECT * FROM dimforge_variety WHERE DESC_COMPLETA_VARIEDADE LIKE '%Red%'")


QUERIES: dict[str, Query] = {
    "stage_cast_distinct": stage_cast_distinct,
    "filter_prefix": filter_prefix,
    "filter_in": filter_in,
    "filter_cutover": filter_cutover,
    "filter_contains": filter_contains,
    "filter_conj": filter_conj,
    "origin_key_registry": origin_key_registry,
    "join_composite": join_composite,
    "join_computed_key": join_computed_key,
    "join_left_lookup": join_left_lookup,
    "join_mixed_optionality": join_mixed_optionality,
    "join_snowflake": join_snowflake,
    "join_star": join_star,
    "semi_active": semi_active,
    "group_sum_area": group_sum_area,
    "plan_staging": plan_staging,
    "group_then_date_distinct": group_then_date_distinct,
    "union_widen_distinct": union_widen_distinct,
    "union_missing_column": union_missing_column,
    "season_key_current": season_key_current,
    "season_key_legacy": season_key_legacy,
    "strip_separators": strip_separators_query,
    "site_code": site_code,
    "flags_fallbacks": flags_fallbacks,
    "business_key": business_key_query,
    "names_trim_initcap": names_trim_initcap,
    "date_formats": date_formats,
    "tax_id_mask": tax_id_mask_query,
    "snapshot_roundtrip": snapshot_roundtrip,
    "snapshot_stale_redone": snapshot_stale_redone,
    "publish_roundtrip": publish_roundtrip,
    "reload_one_origin": reload_one_origin,
    "lookup_number_text": lookup_number_text,
    "raw_catalog_scan": raw_catalog_scan,
    "text_positive_or_null": text_positive_or_null,
    "text_in_list": text_in_list,
    "text_group_sum": text_group_sum,
    "date_plain_malformed": date_plain_malformed,
    "season_key_numeric_erp": season_key_numeric_erp,
    "sql_over_view": sql_over_view,
    "load_all_published": load_all_published,
    "conformed_field": conformed_field,
    "conformed_site": conformed_site,
    "conformed_site_analysis": conformed_site_analysis,
    "site_unmatched": site_unmatched,
    "conformed_variety": conformed_variety,
    "conformed_plan": conformed_plan,
}
