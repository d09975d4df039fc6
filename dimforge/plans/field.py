"""Physical-field dimension (9 columns, ``schemas.FIELD``).

Current system: ``Upn3_fisico``.  Legacy system: ``ga_saf_divi3`` rows whose
level-1 division code starts with ``P``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge import schemas
from dimforge.audit import audited
from dimforge.config import DEFAULT, Settings
from dimforge.functions import DAY_MONTH_YEAR, origin_key, to_date, typed, typed_constant
from dimforge.operators import conform_origins, stage, starts_with
from dimforge.sources.snapshot import snapshot_once

# Raw table names read by this plan.
RAW_CURRENT = "Upn3_fisico"
RAW_LEGACY = "ga_saf_divi3"
LEGACY_DIVISION_PREFIX = "P"


def stage_current(raw: DataFrame, settings: Settings = DEFAULT, distinct: bool = True) -> DataFrame:
    s = settings.strict_casts
    return stage(raw, [
        typed("ID_UPN3_FISICO", "bigint", s).alias("ID_DOMAIN"),
        F.lit(schemas.CURRENT).alias("ID_ORIGEM_DB"),
        F.col("CD_UPN3_FISICO").alias("COD_LAVOURA"),
        F.col("DE_UPN3_FISICO").alias("DESC_LAVOURA"),
        typed("QT_AREA_PROD", "decimal(18,2)", s).alias("AREA_FISICA"),
        to_date("DT_INATIVACAO", DAY_MONTH_YEAR, s).alias("DATA_INATIVACAO"),
        typed("ID_UPNIVEL2", "int", s).alias("ID_SEDE"),
    ], distinct=distinct)


def stage_legacy(raw: DataFrame, settings: Settings = DEFAULT, distinct: bool = True) -> DataFrame:
    s = settings.strict_casts
    return stage(raw, [
        typed("ID_DIVI3", "bigint", s).alias("ID_DIVI3"),
        F.lit(schemas.LEGACY).alias("ID_ORIGEM_DB"),
        F.col("COD_DIVI3"),
        F.col("DSC_DIVI3"),
        typed("DV3_AREA_LIQ", "decimal(18,6)", s).alias("DV3_AREA_LIQ"),
        typed("COD_EMPR", "int", s).alias("COD_EMPR"),
    ], where=starts_with("COD_DIVI1", LEGACY_DIVISION_PREFIX), distinct=distinct)


def current_rows(staged: DataFrame) -> DataFrame:
    """Output columns of the current system, without the origin label."""
    o = F.col("ID_ORIGEM_DB")
    return staged.select(
        "ID_DOMAIN", "ID_ORIGEM_DB",
        origin_key(o, "ID_DOMAIN").alias("ID_LAV_FISICA"),
        "COD_LAVOURA", "DESC_LAVOURA", "AREA_FISICA", "DATA_INATIVACAO",
        origin_key(o, "ID_SEDE").alias("ID_SEDE"),
    )


def legacy_rows(staged: DataFrame) -> DataFrame:
    o = F.col("ID_ORIGEM_DB")
    return staged.select(
        F.col("ID_DIVI3").alias("ID_DOMAIN"), "ID_ORIGEM_DB",
        origin_key(o, "ID_DIVI3").alias("ID_LAV_FISICA"),
        F.col("COD_DIVI3").alias("COD_LAVOURA"),
        F.col("DSC_DIVI3").alias("DESC_LAVOURA"),
        F.col("DV3_AREA_LIQ").alias("AREA_FISICA"),
        typed_constant(None, "timestamp").alias("DATA_INATIVACAO"),
        origin_key(o, "COD_EMPR").alias("ID_SEDE"),
    )


@audited
def build_field(raw: Mapping[str, DataFrame], registry: DataFrame, settings: Settings = DEFAULT,
                legacy_snapshot: str | None = None, legacy_token: str | None = None) -> DataFrame:
    """The conformed field table: both origins, labelled, de-duplicated.

    ``legacy_snapshot``: a folder in the shared storage; the legacy rows are
    computed and written there once and read back afterwards, which also
    cuts their lineage.  ``legacy_token`` names what they are made from; a
    snapshot made from something else is redone (see :func:`snapshot_once`).
    """
    fields = raw[RAW_CURRENT]
    current = current_rows(stage_current(fields, settings, distinct=False))
    legacy = legacy_rows(stage_legacy(raw[RAW_LEGACY], settings, distinct=False))
    if legacy_snapshot:
        legacy = snapshot_once(legacy.distinct(), legacy_snapshot, legacy_token)
    return conform_origins([current, legacy], schemas.FIELD, registry, settings=settings, disjoint=True)


@audited
def field_of_origin(raw: Mapping[str, DataFrame], registry: DataFrame, origin: int,
                    settings: Settings = DEFAULT) -> DataFrame:
    """One origin's conformed rows (labelled, distinct)."""
    if origin == schemas.CURRENT:
        part = current_rows(stage_current(raw[RAW_CURRENT], settings, distinct=False))
    else:
        part = legacy_rows(stage_legacy(raw[RAW_LEGACY], settings, distinct=False))
    return conform_origins([part], schemas.FIELD, registry, settings=settings, disjoint=True)
