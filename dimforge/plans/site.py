"""Farm-site dimension (12 columns, ``schemas.SITE``) and its analysis
variant (13 columns, ``schemas.SITE_ANALYSIS``).

Current system: a snowflake site → unit → branch → city → state, with an
optional region list.  Legacy system: the company table (``FZ`` companies
only, except in the analysis variant), with a required region.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge import schemas
from dimforge.audit import audited
from dimforge.config import DEFAULT, Settings
from dimforge.functions import farm_code, origin_key, site_code, tax_id_mask, title_case, trimmed, typed
from dimforge.operators import Lookup, chain_lookups, check_lookups, conform_origins, match_flags, stage, starts_with

# Raw table names read by this plan, and the farm prefix.
RAW_SITE = "Upnivel2"
RAW_UNIT = "Upnivel1"
RAW_STATE = "unifederacao"
RAW_CITY = "municipio"
RAW_BRANCH = "filial"
RAW_REGION = "dim_regiaofazendas"
RAW_COMPANY = "ga_empr"
FARM_PREFIX = "FZ"


def stage_sites(raw: DataFrame, settings: Settings = DEFAULT, distinct: bool = True) -> DataFrame:
    s = settings.strict_casts
    return stage(raw, [
        typed("ID_UPNIVEL2", "bigint", s).alias("ID_UPNIVEL2"),
        F.lit(schemas.CURRENT).alias("ID_ORIGEM_DB"),
        F.col("DA_UPNIVEL2").alias("COD_SEDE"),
        F.col("DE_UPNIVEL2").alias("DESC_SEDE"),
        typed("ID_UPNIVEL1", "bigint", s).alias("ID_UPNIVEL1"),
    ], distinct=distinct)


def stage_units(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    s = settings.strict_casts
    return stage(raw, [
        typed("ID_UPNIVEL1", "bigint", s).alias("ID_UPNIVEL1"),
        F.col("CD_INT_ERP").alias("COD_FAZENDA"),
        typed("ID_FILIAL", "bigint", s).alias("ID_FILIAL"),
    ])


def stage_states(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return stage(raw, [
        typed("ID_UNIFEDERACAO", "bigint", settings.strict_casts).alias("ID_UNIFEDERACAO"),
        F.col("CD_UF").alias("UF"),
    ])


def stage_cities(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    s = settings.strict_casts
    return stage(raw, [
        typed("ID_MUNICIPIO", "bigint", s).alias("ID_MUNICIPIO"),
        typed("ID_UNIFEDERACAO", "bigint", s).alias("ID_UNIFEDERACAO"),
        title_case("DE_MUNICIPIO").alias("CIDADE"),
    ])


def stage_branches(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    s = settings.strict_casts
    return stage(raw, [
        typed("ID_FILIAL", "bigint", s).alias("ID_FILIAL"),
        typed("ID_MUNICIPIO", "bigint", s).alias("ID_MUNICIPIO"),
        tax_id_mask("NO_CNPJ", redact=settings.redact_tax_ids).alias("CNPJ"),
        origin_key(schemas.CURRENT, "ID_EMPRESA").alias("ID_FAZENDA"),
    ])


def stage_regions(raw: DataFrame) -> DataFrame:
    return stage(raw, [
        F.col("TITLE").alias("COD_FAZENDA"),
        F.col("REGIAO1").alias("REGIAO"),
        F.col("REGIAO2").alias("REGIONAL"),
    ])


def stage_companies(raw: DataFrame, settings: Settings = DEFAULT, analysis: bool = False,
                    distinct: bool = True) -> DataFrame:
    """Legacy companies.  The analysis variant keeps the production company
    id and does not restrict to ``FZ`` companies."""
    s = settings.strict_casts
    cols = [typed("COD_EMPR", "bigint", s).alias("COD_EMPR")]
    if analysis:
        cols.append(typed("COD_EMPR_PROD", "bigint", s).alias("COD_EMPR_PROD"))
    cols += [
        F.lit(schemas.LEGACY).alias("ID_ORIGEM_DB"),
        farm_code("ABV_EMPR").alias("COD_FAZENDA"),
        site_code("ABV_EMPR").alias("ABV_EMPR"),
        F.col("DSC_EMPR"),
        F.col("EMP_UF"),
        title_case("EMP_CIDAD").alias("EMP_CIDAD"),
        tax_id_mask(trimmed("EMP_CGC"), redact=settings.redact_tax_ids).alias("EMP_CGC"),
    ]
    where = None if analysis else starts_with("ABV_EMPR", FARM_PREFIX)
    return stage(raw, cols, where=where, distinct=distinct)


def site_lookups(raw: Mapping[str, DataFrame], settings: Settings = DEFAULT) -> dict[str, DataFrame]:
    """The staged lookups of both origins, built once per load."""
    return {
        "units": stage_units(raw[RAW_UNIT], settings),
        "branches": stage_branches(raw[RAW_BRANCH], settings),
        "cities": stage_cities(raw[RAW_CITY], settings),
        "states": stage_states(raw[RAW_STATE], settings),
        "regions": stage_regions(raw[RAW_REGION]),
    }


def current_rows(raw: Mapping[str, DataFrame], settings: Settings = DEFAULT,
                 region_how: str = "left", lookups: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Current-system sites through the snowflake; region optional by default."""
    lk = lookups or site_lookups(raw, settings)
    sites = stage_sites(raw[RAW_SITE], settings, distinct=False)
    out = chain_lookups(sites, [
        Lookup(lk["units"], "ID_UPNIVEL1"),
        Lookup(lk["branches"], "ID_FILIAL"),
        Lookup(lk["cities"], "ID_MUNICIPIO"),
        Lookup(lk["states"], "ID_UNIFEDERACAO"),
        Lookup(lk["regions"], "COD_FAZENDA", region_how),
    ], settings)
    o = F.col("ID_ORIGEM_DB")
    return out.select(
        F.col("ID_UPNIVEL2").alias("ID_DOMAIN"), "ID_ORIGEM_DB",
        origin_key(o, "ID_UPNIVEL2").alias("ID_SEDE"),
        "COD_SEDE", "DESC_SEDE", "UF", "REGIAO", "REGIONAL", "CIDADE", "CNPJ", "ID_FAZENDA",
    )


def legacy_rows(raw: Mapping[str, DataFrame], settings: Settings = DEFAULT,
                region_how: str = "inner", analysis: bool = False,
                lookups: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Legacy sites; the region is required by default (per-origin optionality)."""
    regions = lookups["regions"] if lookups else stage_regions(raw[RAW_REGION])
    companies = stage_companies(raw[RAW_COMPANY], settings, analysis, distinct=False)
    out = chain_lookups(companies, [Lookup(regions, "COD_FAZENDA", region_how)], settings)
    o = F.col("ID_ORIGEM_DB")
    cols = [
        F.col("COD_EMPR").alias("ID_DOMAIN"), "ID_ORIGEM_DB",
        origin_key(o, "COD_EMPR").alias("ID_SEDE"),
        F.col("ABV_EMPR").alias("COD_SEDE"),
        F.col("DSC_EMPR").alias("DESC_SEDE"),
        F.col("EMP_UF").alias("UF"),
        "REGIAO", "REGIONAL",
        F.col("EMP_CIDAD").alias("CIDADE"),
        F.col("EMP_CGC").alias("CNPJ"),
        origin_key(o, "COD_EMPR").alias("ID_FAZENDA"),
    ]
    if analysis:
        cols.append(origin_key(o, "COD_EMPR_PROD").alias("ID_FAZENDA_PROD"))
    return out.select(*cols)


@audited
def build_site(raw: Mapping[str, DataFrame], registry: DataFrame, settings: Settings = DEFAULT,
               current_region_how: str = "left", legacy_region_how: str = "inner") -> DataFrame:
    """The conformed site table (12 columns)."""
    lk = site_lookups(raw, settings)
    check_lookups(lk.values(), settings)
    parts = [current_rows(raw, settings, current_region_how, lk),
             legacy_rows(raw, settings, legacy_region_how, lookups=lk)]
    return conform_origins(parts, schemas.SITE, registry, settings=settings, disjoint=True)


@audited
def build_site_analysis(raw: Mapping[str, DataFrame], registry: DataFrame,
                        settings: Settings = DEFAULT) -> DataFrame:
    """Analysis variant: all legacy companies, plus ``ID_FAZENDA_PROD``
    (NULL for the current system, which has 12 columns)."""
    lk = site_lookups(raw, settings)
    check_lookups(lk.values(), settings)
    parts = [current_rows(raw, settings, lookups=lk), legacy_rows(raw, settings, analysis=True, lookups=lk)]
    return conform_origins(parts, schemas.SITE_ANALYSIS, registry, allow_missing=True,
                           settings=settings, disjoint=True)


#: What a site may lack, with the lookup that would hold it, in the order of the joins.
MISSING_FLAGS = {"SEM_UNIDADE": "ID_UPNIVEL1", "SEM_FILIAL": "ID_FILIAL", "SEM_MUNICIPIO": "ID_MUNICIPIO",
                 "SEM_UF": "ID_UNIFEDERACAO", "SEM_REGIAO": "COD_FAZENDA"}


def unmatched_sites(raw: Mapping[str, DataFrame], settings: Settings = DEFAULT) -> DataFrame:
    """Sites of both origins (all legacy companies, as in the analysis) that miss
    a lookup, with a flag for each: the rows that the inner joins drop, or that
    are published without a region.

    One pass over the sites: every lookup is joined with a match flag.  A flag
    is NULL where the origin has no such lookup.
    """
    lk = site_lookups(raw, settings)
    check_lookups(lk.values(), settings)
    frames = dict(zip(MISSING_FLAGS, (lk["units"], lk["branches"], lk["cities"], lk["states"], lk["regions"])))
    sites = stage_sites(raw[RAW_SITE], settings, distinct=False)
    current = match_flags(sites, [(flag, Lookup(frames[flag], key)) for flag, key in MISSING_FLAGS.items()], settings)
    companies = stage_companies(raw[RAW_COMPANY], settings, analysis=True, distinct=False)
    legacy = match_flags(companies, [("SEM_REGIAO", Lookup(lk["regions"], "COD_FAZENDA"))], settings)

    def report(df: DataFrame, key: str, code: str) -> DataFrame:
        flags = [(~F.col(f)).alias(f) if f in df.columns else F.lit(None).cast("boolean").alias(f) for f in MISSING_FLAGS]
        return df.select("ID_ORIGEM_DB", F.col(key).alias("ID_DOMAIN"), F.col(code).alias("COD_SEDE"), *flags)

    both = report(current, "ID_UPNIVEL2", "COD_SEDE").unionByName(report(legacy, "COD_EMPR", "ABV_EMPR"))
    return both.where(" OR ".join(MISSING_FLAGS)).distinct()


@audited
def site_of_origin(raw: Mapping[str, DataFrame], registry: DataFrame, origin: int,
                   settings: Settings = DEFAULT, analysis: bool = False) -> DataFrame:
    """One origin's conformed rows (labelled, distinct); ``analysis`` gives
    the 13-column variant."""
    schema = schemas.SITE_ANALYSIS if analysis else schemas.SITE
    part = (current_rows(raw, settings) if origin == schemas.CURRENT
            else legacy_rows(raw, settings, analysis=analysis))
    return conform_origins([part], schema, registry, allow_missing=analysis, settings=settings, disjoint=True)
