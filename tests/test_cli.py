"""The load command line on raw tables stored as Parquet folders."""

import json
import os
import uuid

from conftest import SMALL_SF

from dimforge.__main__ import main
from dimforge.plans.loads import FIELD_TABLE, published
from dimforge.sources.driver_tables import DriverTables
from dimforge.sources.snapshot import snapshot_path


def test_field_load_from_parquet_folders(spark, tmp_path):
    base = snapshot_path(spark, "tests", uuid.uuid4().hex)
    locations = {}
    for name, df in DriverTables(spark, SMALL_SF).field_raw().items():
        folder = f"{base}/raw/{name}"
        df.write.parquet(folder)
        locations[name] = folder
    registry = f"{base}/raw/registry"
    spark.createDataFrame([(1000, "L"), (2000, "C")], "ID_DOMAIN int, DESC_BANCO_DADOS string").write.parquet(registry)
    locations["tb_banco_dados"] = registry
    tables = os.path.join(tmp_path, "tables.json")
    with open(tables, "w") as f:
        json.dump(locations, f)
    owner = f"dimforge_cli_{uuid.uuid4().hex[:8]}"
    assert main(["field", "--tables", tables, "--owner", owner, "--base-path", base]) == {FIELD_TABLE: True}
    out = published(spark, owner, FIELD_TABLE)
    assert out.count() > 0
    assert {r[0] for r in out.select("ORIGEM_DB").distinct().collect()} == {"L", "C"}
