"""Crop-planning fact (30 columns, ``schemas.PLANNING``).

Current system: planned field rows summed per planning grain, joined to the
season period, the scenario (``PLAN`` only) and six conformed tables on the
natural key (local id + origin).  Legacy system: division rows of active
simulations (a semi join), joined to the conformed tables on the computed
surrogate key, up to the cut-over season year.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from dimforge import schemas
from dimforge.audit import audited
from dimforge.config import DEFAULT, Settings
from dimforge.functions import (
    COMPACT_STAMP,
    as_text,
    business_key,
    cast_to,
    origin_key,
    season_key_current,
    season_key_legacy,
    strip_separators,
    to_date,
    typed,
    typed_constant,
)
from dimforge.operators import (
    Lookup,
    chain_lookups,
    check_lookups,
    conform_origins,
    group_sum,
    in_list,
    merge_lookups,
    narrowed,
    origin_cutover,
    proven_small,
    stage,
    starts_with,
)
from dimforge.operators.joins import bounded_fits, distinct_lookup, fits_broadcast, note_unique

# Raw table names, the plan scenario, active simulation states
# and the last legacy season year.
RAW_PLAN = "upn3_plan"
RAW_SCENARIO = "Cenario"
RAW_PERIOD = "periodosafra"
RAW_DIVISION = "ga_prp_divi4"
RAW_SIMULATION = "ga_prp_simula"
PLAN_SCENARIO = "PLAN"
ACTIVE_SIMULATION = (3, 4)
# Areas are summed in this type: ten decimals, as many digits before as a sum needs.
AREA = "decimal(28,10)"
LEGACY_LAST_YEAR = 2020

PLAN_GRAIN = ("ID_UPN3_PLAN", "ID_PERIODOSAFRA", "ID_UPN3_FISICO", "ID_VARIEDADE", "ID_UPNIVEL2",
              "ID_CENARIO", "DT_EST_PLANT", "DT_ESTIMADA_COLH", "QT_PRODUCAO_ESTIM",
              "QT_PROD_ESTIM", "CD_UPNIVEL3")


@dataclass(frozen=True)
class ConformedTables:
    """The conformed tables the fact reads (published by earlier loads).

    field/variety/site: as built by this package; season: ``ID_SAFRA``,
    ``ID_ORIGEM_DB``, ``ANO_AGRICOLA``, ``SAFRINHA``; crop: ``ID_DOMAIN``,
    ``ID_ORIGEM_DB``, ``ID_CULTURA``, ``COD_CULTURA``, ``CULTURA``,
    ``FATOR_CONVERSAO``; farm: ``ID_FAZENDA``, ``SIGLA_FAZENDA``.
    """

    field: DataFrame
    season: DataFrame
    variety: DataFrame
    crop: DataFrame
    site: DataFrame
    farm: DataFrame


def stage_plan(raw: DataFrame, settings: Settings = DEFAULT, distinct: bool = True,
               grain: str = "raw") -> DataFrame:
    """Planned area summed per planning grain, then typed.

    ``grain="raw"`` (default) groups by the raw columns; the casts
    (timestamps to dates, amounts to decimal(18,6)) come after the sum, and
    the DISTINCT after them, so two grain rows that become equal once typed
    are one row (their areas are not added).  ``grain="date"`` groups by the
    typed dates instead, so rows of one day are summed.
    """
    s = settings.strict_casts
    if grain == "date":
        raw = raw.withColumn("DT_EST_PLANT", to_date("DT_EST_PLANT", strict=s)).withColumn(
            "DT_ESTIMADA_COLH", to_date("DT_ESTIMADA_COLH", strict=s))
    elif grain != "raw":
        raise ValueError(f"grain must be 'raw' or 'date', not {grain!r}")
    summed = group_sum(raw, PLAN_GRAIN, "QT_AREA_PROD", "QT_AREA_PROD_SUM", value_type=AREA, strict=s)
    return stage(summed, [
        typed("ID_UPN3_PLAN", "bigint", s).alias("ID_UPN3_PLAN"),
        F.lit(schemas.CURRENT).alias("ID_ORIGEM_DB"),
        typed("ID_PERIODOSAFRA", "bigint", s).alias("ID_PERIODOSAFRA"),
        typed("ID_UPN3_FISICO", "bigint", s).alias("ID_UPN3_FISICO"),
        F.col("CD_UPNIVEL3"),
        typed("ID_VARIEDADE", "bigint", s).alias("ID_VARIEDADE"),
        typed("ID_UPNIVEL2", "bigint", s).alias("ID_UPNIVEL2"),
        typed("ID_CENARIO", "bigint", s).alias("ID_CENARIO"),
        typed("QT_AREA_PROD_SUM", "decimal(18,6)", s).alias("QT_AREA_PROD"),
        to_date("DT_EST_PLANT", strict=s).alias("DT_EST_PLANT"),
        to_date("DT_ESTIMADA_COLH", strict=s).alias("DT_ESTIMADA_COLH"),
        typed("QT_PRODUCAO_ESTIM", "decimal(18,6)", s).alias("QT_PRODUCAO_ESTIM"),
        typed("QT_PROD_ESTIM", "decimal(18,6)", s).alias("QT_PROD_ESTIM"),
    ], distinct=distinct)


def stage_scenarios(raw: DataFrame, settings: Settings = DEFAULT, kind: str = PLAN_SCENARIO) -> DataFrame:
    return stage(raw, [
        typed("ID_CENARIO", "bigint", settings.strict_casts).alias("ID_CENARIO"),
        F.col("CD_CENARIO"),
    ], where=F.col("DA_CENARIO") == F.lit(kind))


def stage_periods(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    s = settings.strict_casts
    return stage(raw, [
        typed("ID_PERIODOSAFRA", "bigint", s).alias("ID_PERIODOSAFRA"),
        season_key_current(schemas.CURRENT, "ID_SAFRA", "CD_INT_ERP", "DE_PER_SAFRA").alias("ID_SAFRA"),
        typed("ID_OCUPACAO", "bigint", s).alias("ID_OCUPACAO"),
    ])


def stage_divisions(raw: DataFrame, settings: Settings = DEFAULT, distinct: bool = True,
                    last_year: int | None = None) -> DataFrame:
    """Legacy planned divisions; ``last_year`` applies the cut-over here, on
    the staged year, so it runs before any join."""
    s = settings.strict_casts
    staged = stage(raw, [
        typed("ID_DIVI4", "int", s).alias("ID_DIVI4"),
        F.col("COD_SAFRA"),
        F.lit(schemas.LEGACY).alias("ID_ORIGEM_DB"),
        typed(F.coalesce(as_text("COD_VARIE"), F.lit("0")), "int", s).alias("COD_VARIE"),
        typed("ID_DIVI3", "int", s).alias("ID_DIVI3"),
        season_key_legacy("COD_SAFRA").alias("ID_SAFRA"),
        F.col("COD_CULTURA"),
        typed("COD_EMPR", "int", s).alias("COD_EMPR"),
        typed("COD_SIMULACAO", "int", s).alias("COD_SIMULACAO"),
        typed("DV4_AREA", "decimal(18,6)", s).alias("DV4_AREA"),
        to_date("DV4_DT_PLANTIO", COMPACT_STAMP, s).alias("DV4_DT_PLANTIO"),
        to_date("DV4_DT_COLH", COMPACT_STAMP, s).alias("DV4_DT_COLH"),
        typed("DV4_PROD_EST", "decimal(18,6)", s).alias("DV4_PROD_EST"),
        typed("SAF_ANO_SAFRA", "int", s).alias("SAF_ANO_SAFRA"),
    ], distinct=False)
    if last_year is not None:
        staged = origin_cutover(staged, "SAF_ANO_SAFRA", last_year)
    return staged.distinct() if distinct else staged


def stage_simulations(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    s = settings.strict_casts
    return stage(raw, [
        typed("SAF_ANO_SAFRA", "int", s).alias("SAF_ANO_SAFRA"),
        typed("COD_SIMULACAO", "int", s).alias("COD_SIMULACAO"),
    ], where=in_list(cast_to("SIM_ATIVA", "int", s), ACTIVE_SIMULATION))


def planning_lookups(raw: Mapping[str, DataFrame], dims: ConformedTables,
                     settings: Settings = DEFAULT) -> dict[str, DataFrame]:
    """Every lookup of both origins, narrowed to the columns the fact uses,
    built once per load.

    Current system: the conformed tables are matched on (local id, origin);
    the origin is the constant 2000 there, so it becomes a filter on each
    table, pushed to its scan, and the join key is the local id alone.
    Legacy system: matched on the stored surrogate keys.  Those of the legacy
    origin begin with its id, so that prefix, or the origin itself, is a filter
    on each table, pushed to its scan too.  Site and farm share their key, so they are joined
    to each other first, unless their recorded sizes prove that both can be
    broadcast, and the fact meets that key once (a hot site can then be split,
    which a second join on the same key would forbid).  Where a table was
    written with its sizes, they bound the lookups made from it, and no check
    counts those.
    """
    current = F.col("ID_ORIGEM_DB") == F.lit(schemas.CURRENT)
    legacy = F.col("ID_ORIGEM_DB") == F.lit(schemas.LEGACY)

    def keyed(key: str) -> Column:
        return starts_with(key, str(schemas.LEGACY))

    lookups = {
        "scenarios": stage_scenarios(raw[RAW_SCENARIO], settings),
        "periods": stage_periods(raw[RAW_PERIOD], settings),
        "field": narrowed(dims.field, current, ("ID_DOMAIN", "ID_UPN3_FISICO"), "COD_LAVOURA"),
        "season": narrowed(dims.season, current, "ID_SAFRA", "ANO_AGRICOLA", "SAFRINHA"),
        "variety": narrowed(dims.variety, current, ("ID_DOMAIN", "ID_VARIEDADE"), "COD_VARIEDADE", "CICLO_VARIEDADE"),
        "crop": narrowed(dims.crop, current, ("ID_DOMAIN", "ID_OCUPACAO"), "COD_CULTURA", "CULTURA", "FATOR_CONVERSAO"),
        "site": narrowed(dims.site, current, ("ID_DOMAIN", "ID_UPNIVEL2"), "COD_SEDE", "UF", "REGIAO", "REGIONAL", "ID_FAZENDA"),
        "farm": narrowed(dims.farm, None, "ID_FAZENDA", "SIGLA_FAZENDA"),
        "active": stage_simulations(raw[RAW_SIMULATION], settings),
        # tables built here keep the origin's rows in a folder of their own, so the origin prunes more than the key's prefix
        "field_key": narrowed(dims.field, legacy & keyed("ID_LAV_FISICA"), ("ID_LAV_FISICA", "K_FIELD"), "COD_LAVOURA"),
        "variety_key": narrowed(dims.variety, legacy & keyed("ID_VARIEDADE"), ("ID_VARIEDADE", "K_VARIETY"),
                                "COD_VARIEDADE", "CICLO_VARIEDADE"),
        "crop_key": narrowed(dims.crop, keyed("ID_CULTURA"), ("ID_CULTURA", "K_CROP"), "COD_CULTURA", "CULTURA", "FATOR_CONVERSAO"),
        "season_key": narrowed(dims.season, keyed("ID_SAFRA"), ("ID_SAFRA", "K_SEASON"), "SAFRINHA"),
    }
    pair = {
        "site_key": narrowed(dims.site, legacy & keyed("ID_SEDE"), ("ID_SEDE", "K_SITE"), "COD_SEDE", "UF", "REGIAO", "REGIONAL"),
        "farm_key": narrowed(dims.farm, keyed("ID_FAZENDA"), ("ID_FAZENDA", "K_SITE"), "SIGLA_FAZENDA"),
    }
    if all(proven_small(side, settings) for side in pair.values()):
        return lookups | pair
    return lookups | {"site_farm_key": merge_lookups(*pair.values(), "K_SITE")}


def _of_scenarios(plan: DataFrame, scenarios: DataFrame, settings: Settings) -> DataFrame:
    """Raw plan rows of the wanted scenarios.  The scenario is part of the
    grain, so rows of others are dropped before the sum shuffles them."""
    small = fits_broadcast(scenarios, settings.broadcast_max_rows, settings.broadcast_max_bytes)
    keyed = plan.withColumn("K_SCENARIO", cast_to("ID_CENARIO", "bigint", settings.strict_casts))
    wanted = scenarios.select(F.col("ID_CENARIO").alias("K_SCENARIO"))
    return chain_lookups(keyed, [Lookup(wanted, "K_SCENARIO", "left_semi", small)], settings).drop("K_SCENARIO")


#: Lookups of the current system whose key is part of the planning grain.
_GRAIN_LOOKUPS = {"periods": "ID_PERIODOSAFRA", "field": "ID_UPN3_FISICO", "variety": "ID_VARIEDADE", "site": "ID_UPNIVEL2"}


def _of_matches(plan: DataFrame, lookups: Mapping[str, DataFrame], small: Mapping[str, bool], settings: Settings) -> DataFrame:
    """Raw plan rows with a match in the small lookups of the grain.  A group
    of the grain goes or stays as a whole, so the others are dropped before the
    sum shuffles them."""
    for name, column in _GRAIN_LOOKUPS.items():
        if small[name]:
            wanted = lookups[name].select(F.col(column).alias("K_MATCH"))
            keyed = plan.withColumn("K_MATCH", cast_to(column, "bigint", settings.strict_casts))
            plan = chain_lookups(keyed, [Lookup(wanted, "K_MATCH", "left_semi", True)], settings).drop("K_MATCH")
    return plan


def current_rows(raw: Mapping[str, DataFrame], dims: ConformedTables,
                 settings: Settings = DEFAULT, grain: str = "raw",
                 lookups: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Current-system fact rows (without the origin label).

    Duplicates are dropped while the rows are narrow.  Past the scenario and
    the period, a row is all that it shows of itself and the keys of the other
    lookups, which it shows too; so distinct rows joined to distinct lookup
    rows give distinct fact rows, and the 30 columns need no DISTINCT.  An
    audited build joins first, as its counts are those of the joins.
    """
    lk = lookups or planning_lookups(raw, dims, settings)
    plan, small = _of_scenarios(raw[RAW_PLAN], lk["scenarios"], settings), dict.fromkeys(_GRAIN_LOOKUPS, False)
    if not settings.audit:
        fits = bounded_fits([lk[name] for name in small], settings.broadcast_max_rows, settings.broadcast_max_bytes)
        small = dict(zip(small, fits))
        plan = _of_matches(plan, lk, small, settings)
    u = stage_plan(plan, settings, distinct=False, grain=grain)
    origin = F.col("ID_ORIGEM_DB")
    keyed = chain_lookups(u, [
        Lookup(lk["scenarios"], "ID_CENARIO", met=True),
        Lookup(lk["periods"], "ID_PERIODOSAFRA", met=small["periods"]),
    ], settings).withColumn("ID_PLANEJAMENTO_AGRICOLA", business_key(
        origin, "ID_PERIODOSAFRA", "ID_UPN3_FISICO", "ID_VARIEDADE", "CD_UPNIVEL3"))
    keyed = keyed.drop("ID_PERIODOSAFRA", "CD_UPNIVEL3", "ID_CENARIO")
    keys = {"field": "ID_UPN3_FISICO", "season": "ID_SAFRA", "variety": "ID_VARIEDADE", "crop": "ID_OCUPACAO",
            "site": "ID_UPNIVEL2", "farm": "ID_FAZENDA"}
    kinds = {f.name: f.dataType for f in [*keyed.schema, *lk["site"].schema] if f.name in keys.values()}
    # keys of other types could be unequal, yet equal to the same key of the fact
    alike = all(isinstance(kinds[k], IntegralType) and isinstance(lk[name].schema[k].dataType, IntegralType)
                or kinds[k] == lk[name].schema[k].dataType for name, k in keys.items())
    early = alike and not settings.audit
    if early:
        keyed = keyed.distinct()
    out = chain_lookups(keyed, [Lookup(_without_copies(lk[name], settings) if early else lk[name], key, met=small.get(name, False))
                                for name, key in keys.items()], settings)
    out = _shown(out)
    return note_unique(out) if early else out


def _without_copies(lookup: DataFrame, settings: Settings) -> DataFrame:
    """A lookup's distinct rows.  A large one is looked through first: as it
    stands, a plain scan, Spark can make a runtime filter of it."""
    if fits_broadcast(lookup, settings.broadcast_max_rows, settings.broadcast_max_bytes):
        return distinct_lookup(lookup)
    copies = lookup.groupBy(*lookup.columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return lookup if copies.isEmpty() else distinct_lookup(lookup)


def _shown(out: DataFrame) -> DataFrame:
    """The fact's columns of the joined current-system rows."""
    origin = F.col("ID_ORIGEM_DB")
    return out.select(
        F.col("ID_UPN3_PLAN").alias("ID_DOMAIN"), "ID_ORIGEM_DB",
        "ID_PLANEJAMENTO_AGRICOLA",
        origin_key(origin, "ID_UPN3_PLAN").alias("ID_LAV_LOGICA"),
        origin_key(origin, "ID_UPN3_FISICO").alias("ID_LAV_FISICA"),
        "COD_LAVOURA", "ID_SAFRA", "ANO_AGRICOLA", "SAFRINHA",
        origin_key(origin, "ID_VARIEDADE").alias("ID_VARIEDADE"),
        "COD_VARIEDADE", "CICLO_VARIEDADE",
        origin_key(origin, "ID_OCUPACAO").alias("ID_CULTURA"),
        "COD_CULTURA", "CULTURA", "FATOR_CONVERSAO",
        origin_key(origin, "ID_UPNIVEL2").alias("ID_SEDE"),
        "COD_SEDE", "UF", "REGIAO", "REGIONAL", "ID_FAZENDA", "SIGLA_FAZENDA",
        F.col("CD_CENARIO").alias("COD_SIMULACAO"),
        F.col("QT_AREA_PROD").alias("AREA_PLANEJADA"),
        F.col("DT_EST_PLANT").alias("DATA_PLANTIO_PLAN"),
        F.col("DT_ESTIMADA_COLH").alias("DATA_COLHEITA_PLAN"),
        F.col("QT_PRODUCAO_ESTIM").alias("PRODUCAO_KG_PLANEJADA"),
        F.col("QT_PROD_ESTIM").alias("PRODUTIVIDADE_PLANEJADA"),
    )


def legacy_rows(raw: Mapping[str, DataFrame], dims: ConformedTables, settings: Settings = DEFAULT,
                last_year: int = LEGACY_LAST_YEAR, lookups: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Legacy fact rows (without the origin label).

    Only divisions of an active simulation count (semi join: the simulation
    list adds no column and no duplicate).  The conformed tables are matched
    on the surrogate key ``origin || local id``, computed once per row.
    """
    lk = lookups or planning_lookups(raw, dims, settings)
    d4 = stage_divisions(raw[RAW_DIVISION], settings, distinct=False, last_year=last_year)
    d4 = chain_lookups(d4, [Lookup(lk["active"], ["COD_SIMULACAO", "SAF_ANO_SAFRA"], "left_semi")], settings)
    origin = F.col("ID_ORIGEM_DB")
    keyed = d4.select(
        *(c for c in d4.columns if c != "COD_CULTURA"),
        origin_key(origin, "ID_DIVI3").alias("K_FIELD"),
        origin_key(origin, "COD_VARIE").alias("K_VARIETY"),
        origin_key(origin, "COD_CULTURA").alias("K_CROP"),
        origin_key(origin, "COD_EMPR").alias("K_SITE"),
        origin_key(origin, "ID_SAFRA").alias("K_SEASON"),
    )
    out = chain_lookups(keyed, [
        Lookup(lk["field_key"], "K_FIELD"),
        Lookup(lk["variety_key"], "K_VARIETY"),
        Lookup(lk["crop_key"], "K_CROP"),
        *(Lookup(lk[name], "K_SITE") for name in ("site_key", "farm_key", "site_farm_key") if name in lk),
        Lookup(lk["season_key"], "K_SEASON"),
    ], settings)
    return out.select(
        F.col("ID_DIVI4").alias("ID_DOMAIN"), "ID_ORIGEM_DB",
        business_key(origin, strip_separators("COD_SAFRA"), "ID_DIVI4",
                     "COD_VARIE").alias("ID_PLANEJAMENTO_AGRICOLA"),
        origin_key(origin, "ID_DIVI4").alias("ID_LAV_LOGICA"),
        F.col("K_FIELD").alias("ID_LAV_FISICA"),
        "COD_LAVOURA",
        F.col("K_SEASON").alias("ID_SAFRA"),
        F.col("SAF_ANO_SAFRA").alias("ANO_AGRICOLA"),
        "SAFRINHA",
        F.col("K_VARIETY").alias("ID_VARIEDADE"),
        "COD_VARIEDADE", "CICLO_VARIEDADE",
        F.col("K_CROP").alias("ID_CULTURA"),
        "COD_CULTURA", "CULTURA", "FATOR_CONVERSAO",
        F.col("K_SITE").alias("ID_SEDE"),
        "COD_SEDE", "UF", "REGIAO", "REGIONAL",
        F.col("K_SITE").alias("ID_FAZENDA"),
        "SIGLA_FAZENDA", "COD_SIMULACAO",
        F.col("DV4_AREA").alias("AREA_PLANEJADA"),
        F.col("DV4_DT_PLANTIO").alias("DATA_PLANTIO_PLAN"),
        F.col("DV4_DT_COLH").alias("DATA_COLHEITA_PLAN"),
        typed_constant(0, "decimal(18,6)").alias("PRODUCAO_KG_PLANEJADA"),
        F.col("DV4_PROD_EST").alias("PRODUTIVIDADE_PLANEJADA"),
    )


@audited
def build_planning(raw: Mapping[str, DataFrame], dims: ConformedTables, registry: DataFrame,
                   settings: Settings = DEFAULT, last_year: int = LEGACY_LAST_YEAR,
                   grain: str = "raw") -> DataFrame:
    """The conformed planning fact: both origins, labelled, de-duplicated."""
    lk = planning_lookups(raw, dims, settings)
    check_lookups(lk.values(), settings)
    parts = [current_rows(raw, dims, settings, grain, lk), legacy_rows(raw, dims, settings, last_year, lk)]
    return conform_origins(parts, schemas.PLANNING, registry, settings=settings, disjoint=True)


@audited
def planning_of_origin(raw: Mapping[str, DataFrame], dims: ConformedTables, registry: DataFrame,
                       origin: int, settings: Settings = DEFAULT) -> DataFrame:
    """One origin's conformed rows (labelled, distinct)."""
    part = current_rows(raw, dims, settings) if origin == schemas.CURRENT else legacy_rows(raw, dims, settings)
    return conform_origins([part], schemas.PLANNING, registry, settings=settings, disjoint=True)
