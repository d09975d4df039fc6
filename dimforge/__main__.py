"""Run a load as a job: ``python -m dimforge <load> --tables tables.json --owner OWNER``.

``tables.json`` maps each raw table name the load reads (for example
``"Upn3_fisico"``) to a catalog name (``"db.table"``) or a Parquet folder.
The optional entry ``"tb_banco_dados"`` names the origin registry table;
without it the two registered source systems are used.  The planning load
reads the conformed tables from ``OWNER``.  The session is the one the job
is launched with (``spark-submit`` settings); prints one JSON line with the
tables published.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from dimforge.audit import Audit
from dimforge.config import Settings
from dimforge.operators import origin_registry
from dimforge.plans import loads
from dimforge.sources.catalog import RawTables

REGISTRY_TABLE = "tb_banco_dados"


def main(argv: list[str] | None = None) -> dict[str, bool]:
    parser = argparse.ArgumentParser(prog="python -m dimforge", description=__doc__.splitlines()[0])
    parser.add_argument("load", choices=["field", "site", "site-analysis", "variety", "planning", "all"])
    parser.add_argument("--tables", required=True, help="JSON file: raw table name -> catalog name or folder")
    parser.add_argument("--owner", required=True, help="database the tables are published to")
    parser.add_argument("--base-path", default=None, help="shared folder for the published versions")
    parser.add_argument("--legacy-snapshot", default=None, help="field load: snapshot folder of the legacy rows")
    parser.add_argument("--keep-versions", type=int, default=None, help="published versions to keep (default: all)")
    parser.add_argument("--origin", type=int, default=None, help="reload only this origin's rows of the table (not with 'all')")
    parser.add_argument("--missing-columns", choices=["error", "null"], default="error",
                        help="raw columns that a table lacks: an error, or NULLs")
    parser.add_argument("--audit", action="store_true", help="count values that were none of their type and rows without a match")
    args = parser.parse_args(argv)
    if args.origin is not None and (args.load == "all" or args.legacy_snapshot):
        parser.error("--origin reloads one table, from its raw tables")

    spark = SparkSession.builder.getOrCreate()
    with open(args.tables) as f:
        locations = json.load(f)
    raw = RawTables(spark, locations, args.missing_columns)
    registry = raw[REGISTRY_TABLE] if REGISTRY_TABLE in locations else origin_registry(spark)
    audit = Audit() if args.audit else None
    settings = replace(Settings.from_conf(spark), audit=audit)
    common = dict(base_path=args.base_path, settings=settings, keep_versions=args.keep_versions)
    tables = {"field": loads.FIELD_TABLE, "site": loads.SITE_TABLE, "site-analysis": loads.SITE_TABLE,
              "variety": loads.VARIETY_TABLE, "planning": loads.PLANNING_TABLE}
    if args.origin is not None:
        table = tables[args.load]
        done = {table: loads.reload_origin(raw, registry, args.owner, table, args.origin, **common)}
    elif args.load == "field":
        done = {loads.FIELD_TABLE: loads.load_field(raw, registry, args.owner,
                                                    legacy_snapshot=args.legacy_snapshot, **common)}
    elif args.load in ("site", "site-analysis"):
        done = {loads.SITE_TABLE: loads.load_site(raw, registry, args.owner,
                                                  analysis=args.load == "site-analysis", **common)}
    elif args.load == "variety":
        done = {loads.VARIETY_TABLE: loads.load_variety(raw, registry, args.owner, **common)}
    elif args.load == "planning":
        done = {loads.PLANNING_TABLE: loads.load_planning(raw, registry, args.owner, **common)}
    else:
        done = loads.load_all(raw, registry, args.owner, **common)
    report = {"owner": args.owner, "published": done}
    print(json.dumps(report | ({"lost": audit.counts()} if audit else {})))
    return done


if __name__ == "__main__":
    result = main()
    sys.exit(0 if all(result.values()) else 1)
