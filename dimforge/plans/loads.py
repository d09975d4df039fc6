"""Loads: build a conformed table and publish it, in dependency order.

The fact reads the conformed tables from the catalog (``owner.table``), as
published by the earlier loads, so a load can also run on its own against
tables published before.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from dimforge.config import DEFAULT, Settings
from dimforge.plans.field import RAW_LEGACY, build_field, field_of_origin
from dimforge.plans.planning import ConformedTables, build_planning, planning_of_origin
from dimforge.plans.site import build_site, build_site_analysis, site_of_origin
from dimforge.plans.variety import build_variety, variety_of_origin
from dimforge.sources.catalog import quote
from dimforge.sources.snapshot import input_token, publish, publish_part, published_sizes

# Published table names, and the conformed tables the fact reads.
FIELD_TABLE = "LAVOURA_FISICA"
SITE_TABLE = "SEDE"
VARIETY_TABLE = "VARIEDADE"
PLANNING_TABLE = "PLANEJAMENTO"
SEASON_TABLE = "safra"
CROP_TABLE = "cultura"
FARM_TABLE = "fazenda"


#: The conformed tables lie in a folder for each origin.
ORIGIN = "ID_ORIGEM_DB"


def published(spark: SparkSession, owner: str, table: str) -> DataFrame:
    """A published table, by name (case-insensitive), with its recorded sizes noted."""
    return published_sizes(spark.table(f"{quote(owner)}.{quote(table)}"), owner, table)


def _publish(df: DataFrame, owner: str, table: str, base_path: str | None, retries: int, keep_versions: int | None) -> bool:
    return publish(df, owner, table, base_path, retries, keep_versions=keep_versions, partition_by=ORIGIN)


def load_field(raw: Mapping[str, DataFrame], registry: DataFrame, owner: str, base_path: str | None = None,
               legacy_snapshot: str | None = None, settings: Settings = DEFAULT, retries: int = 10,
               keep_versions: int | None = None) -> bool:
    """The field table.  A legacy snapshot is redone when the files of its raw table are others."""
    token = input_token(raw[RAW_LEGACY]) if legacy_snapshot else None
    return _publish(build_field(raw, registry, settings, legacy_snapshot, token), owner, FIELD_TABLE, base_path, retries, keep_versions)


def load_site(raw: Mapping[str, DataFrame], registry: DataFrame, owner: str, base_path: str | None = None,
              analysis: bool = False, settings: Settings = DEFAULT, retries: int = 10,
              keep_versions: int | None = None) -> bool:
    """The site table; ``analysis`` publishes the 13-column variant under the same name."""
    df = build_site_analysis(raw, registry, settings) if analysis else build_site(raw, registry, settings)
    return _publish(df, owner, SITE_TABLE, base_path, retries, keep_versions)


def load_variety(raw: Mapping[str, DataFrame], registry: DataFrame, owner: str, base_path: str | None = None,
                 settings: Settings = DEFAULT, retries: int = 10, keep_versions: int | None = None) -> bool:
    return _publish(build_variety(raw, registry, settings), owner, VARIETY_TABLE, base_path, retries, keep_versions)


def published_conformed(spark: SparkSession, owner: str) -> ConformedTables:
    """The conformed tables the fact reads, from the catalog."""
    return ConformedTables(
        field=published(spark, owner, FIELD_TABLE), season=published(spark, owner, SEASON_TABLE),
        variety=published(spark, owner, VARIETY_TABLE), crop=published(spark, owner, CROP_TABLE),
        site=published(spark, owner, SITE_TABLE), farm=published(spark, owner, FARM_TABLE))


def load_planning(raw: Mapping[str, DataFrame], registry: DataFrame, owner: str, base_path: str | None = None,
                  settings: Settings = DEFAULT, retries: int = 10, keep_versions: int | None = None) -> bool:
    dims = published_conformed(registry.sparkSession, owner)
    return _publish(build_planning(raw, dims, registry, settings), owner, PLANNING_TABLE, base_path, retries, keep_versions)


def reload_origin(raw: Mapping[str, DataFrame], registry: DataFrame, owner: str, table: str, origin: int,
                  base_path: str | None = None, settings: Settings = DEFAULT, retries: int = 10,
                  keep_versions: int | None = None) -> bool:
    """One origin's rows of a published table, built and published anew; the
    other origin's raw tables are not read and its files stay as they are."""
    builds = {
        FIELD_TABLE: lambda: field_of_origin(raw, registry, origin, settings),
        SITE_TABLE: lambda: site_of_origin(raw, registry, origin, settings,
                                           analysis="ID_FAZENDA_PROD" in published(registry.sparkSession, owner, table).columns),
        VARIETY_TABLE: lambda: variety_of_origin(raw, registry, origin, settings),
        PLANNING_TABLE: lambda: planning_of_origin(raw, published_conformed(registry.sparkSession, owner), registry, origin, settings),
    }
    return publish_part(builds[table](), owner, table, ORIGIN, origin, base_path, retries, keep_versions=keep_versions)


def load_all(raw: Mapping[str, DataFrame], registry: DataFrame, owner: str, base_path: str | None = None,
             settings: Settings = DEFAULT, retries: int = 10, keep_versions: int | None = None) -> dict[str, bool]:
    """Field, site and variety (independent: published concurrently), then
    the planning fact from the published tables.  Returns, per table,
    whether it was published (an empty result is not).  If one of the three
    was not, the fact is not built: it would read an older version of it."""
    how = {"settings": settings, "retries": retries, "keep_versions": keep_versions}
    dims = {
        FIELD_TABLE: lambda: load_field(raw, registry, owner, base_path, **how),
        SITE_TABLE: lambda: load_site(raw, registry, owner, base_path, **how),
        VARIETY_TABLE: lambda: load_variety(raw, registry, owner, base_path, **how),
    }
    with ThreadPoolExecutor(max_workers=len(dims)) as pool:
        done = dict(zip(dims, pool.map(lambda name: dims[name](), dims)))
    done[PLANNING_TABLE] = all(done.values()) and load_planning(raw, registry, owner, base_path, **how)
    return done
