"""Seed-variety dimension (17 columns, ``schemas.VARIETY``)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge import schemas
from dimforge.audit import audited
from dimforge.config import DEFAULT, Settings
from dimforge.functions import (
    first_available,
    flag_label,
    origin_key,
    positive_or_null,
    title_case,
    typed,
    typed_constant,
    zero_if_null,
)
from dimforge.operators import Lookup, chain_lookups, check_lookups, conform_origins, stage

# Raw table names, flag codes and labels of each system.
RAW_VARIETY = "variedade"
RAW_VARIETY_EP = "Variedade_ep"
RAW_MATURITY = "Grpmaturacao"
RAW_GROUP = "Grpvariedade"
RAW_LEGACY_VARIETY = "GA_SAF_VARIEDADE"
RAW_LEGACY_GROUP = "GA_SAF_GRUPO_VARIE"
CURRENT_GM_FLAG, CURRENT_YES, CURRENT_NO = "S", "Sim", "Não"
LEGACY_GM_FLAG, LEGACY_YES, LEGACY_NO = 1, "SIM", "NAO"
PLACEHOLDER = "TBD"


def stage_varieties(raw: DataFrame, settings: Settings = DEFAULT, distinct: bool = True) -> DataFrame:
    s = settings.strict_casts
    return stage(raw, [
        typed("ID_VARIEDADE", "bigint", s).alias("ID_VARIEDADE"),
        F.lit(schemas.CURRENT).alias("ID_ORIGEM_DB"),
        F.col("CD_VARIEDADE").alias("COD_VARIEDADE"),
        F.col("DA_VARIEDADE").alias("TIPO_VARIEDADE"),
        title_case("DE_VARIEDADE").alias("DESC_COMPLETA_VARIEDADE"),
        F.col("ID_OCUPACAO").alias("ID_CULTURA"),
        flag_label("FG_TRANSGENIA", CURRENT_GM_FLAG, CURRENT_YES, CURRENT_NO).alias("TRANSGENIA"),
        typed("ID_GRPMATURACAO", "bigint", s).alias("ID_GRPMATURACAO"),
        typed("ID_GRPVARIEDADE", "bigint", s).alias("ID_GRPVARIEDADE"),
    ], distinct=distinct)


def stage_variety_details(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    s = settings.strict_casts
    return stage(raw, [
        typed("ID_VARIEDADE", "bigint", s).alias("ID_VARIEDADE"),
        positive_or_null("QT_DIAS_MATUR", "int", s).alias("QT_DIAS_MATUR"),
        zero_if_null(typed("NO_DIA_PLAN_EMER", "int", s)).alias("DIAS_PARA_EMERGERGENCIA"),
        typed("QT_PROD_ESTIM", "decimal(10,2)", s).alias("PRODUTIVIDADE_PADRAO"),
    ])


def stage_maturity_groups(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    s = settings.strict_casts
    return stage(raw, [
        typed("ID_GRPMATURACAO", "bigint", s).alias("ID_GRPMATURACAO"),
        zero_if_null(typed("QT_DIAS_MATUR", "int", s)).alias("GRP_DIAS_MATUR"),
    ])


def stage_variety_groups(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return stage(raw, [
        typed("ID_GRPVARIEDADE", "bigint", settings.strict_casts).alias("ID_GRPVARIEDADE"),
        F.col("DA_GRP_VARIEDADE").alias("DESC_GRUPO_VARIEDADE"),
        title_case("DE_GRP_VARIEDADE").alias("DESC_COMPLETA_GRUPO_VARIEDADE"),
    ])


def stage_legacy_varieties(raw: DataFrame, settings: Settings = DEFAULT, distinct: bool = True) -> DataFrame:
    s = settings.strict_casts
    return stage(raw, [
        typed("COD_VARIE", "int", s).alias("COD_VARIE"),
        F.lit(schemas.LEGACY).alias("ID_ORIGEM_DB"),
        F.col("DSC_VARIE"),
        zero_if_null(typed("VAR_TRANSGENICO", "int", s)).alias("VAR_TRANSGENICO"),
        F.col("COD_CULTURA"),
        typed("COD_GRUPO_VARIE", "int", s).alias("COD_GRUPO_VARIE"),
        F.col("COD_FABRICANTE"),
    ], distinct=distinct)


def stage_legacy_groups(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return stage(raw, [
        typed("COD_GRUPO_VARIE", "int", settings.strict_casts).alias("COD_GRUPO_VARIE"),
        title_case("DSC_GRUPO_VARIE").alias("DSC_GRUPO_VARIE"),
        F.col("ABV_GRUPO_VARIE"),
    ])


def variety_lookups(raw: Mapping[str, DataFrame], settings: Settings = DEFAULT) -> dict[str, DataFrame]:
    """The staged lookups of both origins, built once per load."""
    return {
        "details": stage_variety_details(raw[RAW_VARIETY_EP], settings),
        "maturity": stage_maturity_groups(raw[RAW_MATURITY], settings),
        "groups": stage_variety_groups(raw[RAW_GROUP], settings),
        "legacy_groups": stage_legacy_groups(raw[RAW_LEGACY_GROUP], settings),
    }


def current_rows(raw: Mapping[str, DataFrame], settings: Settings = DEFAULT,
                 lookups: Mapping[str, DataFrame] | None = None) -> DataFrame:
    lk = lookups or variety_lookups(raw, settings)
    v = stage_varieties(raw[RAW_VARIETY], settings, distinct=False)
    out = chain_lookups(v, [
        Lookup(lk["details"], "ID_VARIEDADE"),
        Lookup(lk["maturity"], "ID_GRPMATURACAO"),
        Lookup(lk["groups"], "ID_GRPVARIEDADE"),
    ], settings)
    o = F.col("ID_ORIGEM_DB")
    return out.select(
        F.col("ID_VARIEDADE").alias("ID_DOMAIN"), "ID_ORIGEM_DB",
        origin_key(o, "ID_VARIEDADE").alias("ID_VARIEDADE"),
        "COD_VARIEDADE", "TIPO_VARIEDADE", "DESC_COMPLETA_VARIEDADE",
        origin_key(o, "ID_CULTURA").alias("ID_CULTURA"),
        "TRANSGENIA",
        first_available("QT_DIAS_MATUR", "GRP_DIAS_MATUR").alias("CICLO_VARIEDADE"),
        "DIAS_PARA_EMERGERGENCIA", "DESC_GRUPO_VARIEDADE", "DESC_COMPLETA_GRUPO_VARIEDADE",
        "PRODUTIVIDADE_PADRAO",
        F.lit(PLACEHOLDER).alias("FORNECEDOR"),
        F.lit(0).alias("PRODUTIVIDADE_HISTORICA_MEDIA"),
        F.lit(0).alias("ESPACAMENTO_SEMENTES"),
    )


def legacy_rows(raw: Mapping[str, DataFrame], settings: Settings = DEFAULT,
                normalise_labels: bool = False, lookups: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Legacy varieties.  Their flag labels are ``SIM``/``NAO``; with
    ``normalise_labels`` they use the current system's ``Sim``/``Não``."""
    yes, no = (CURRENT_YES, CURRENT_NO) if normalise_labels else (LEGACY_YES, LEGACY_NO)
    groups = lookups["legacy_groups"] if lookups else stage_legacy_groups(raw[RAW_LEGACY_GROUP], settings)
    v = stage_legacy_varieties(raw[RAW_LEGACY_VARIETY], settings, distinct=False)
    out = chain_lookups(v, [Lookup(groups, "COD_GRUPO_VARIE")], settings)
    o = F.col("ID_ORIGEM_DB")
    return out.select(
        F.col("COD_VARIE").alias("ID_DOMAIN"), "ID_ORIGEM_DB",
        origin_key(o, "COD_VARIE").alias("ID_VARIEDADE"),
        "COD_VARIE",
        F.lit(PLACEHOLDER).alias("TIPO_VARIEDADE"),
        "DSC_VARIE",
        origin_key(o, "COD_CULTURA").alias("ID_CULTURA"),
        flag_label("VAR_TRANSGENICO", LEGACY_GM_FLAG, yes, no).alias("TRANSGENIA"),
        F.lit(0).alias("CICLO_VARIEDADE"),
        F.lit(0).alias("DIAS_PARA_EMERGERGENCIA"),
        "ABV_GRUPO_VARIE", "DSC_GRUPO_VARIE",
        typed_constant(0, "int").alias("PRODUTIVIDADE_PADRAO"),
        F.col("COD_FABRICANTE").alias("FORNECEDOR"),
        F.lit(0).alias("PRODUTIVIDADE_HISTORICA_MEDIA"),
        F.lit(0).alias("ESPACAMENTO_SEMENTES"),
    )


@audited
def build_variety(raw: Mapping[str, DataFrame], registry: DataFrame, settings: Settings = DEFAULT,
                  normalise_labels: bool = False) -> DataFrame:
    """The conformed variety table: both origins, labelled, de-duplicated."""
    lk = variety_lookups(raw, settings)
    check_lookups(lk.values(), settings)
    return conform_origins([current_rows(raw, settings, lk), legacy_rows(raw, settings, normalise_labels, lk)],
                           schemas.VARIETY, registry, settings=settings, disjoint=True)


@audited
def variety_of_origin(raw: Mapping[str, DataFrame], registry: DataFrame, origin: int,
                      settings: Settings = DEFAULT) -> DataFrame:
    """One origin's conformed rows (labelled, distinct)."""
    part = current_rows(raw, settings) if origin == schemas.CURRENT else legacy_rows(raw, settings)
    return conform_origins([part], schemas.VARIETY, registry, settings=settings, disjoint=True)
