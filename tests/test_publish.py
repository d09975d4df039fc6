"""The publish protocol, snapshots by key, recorded sizes, tables in folders by origin."""

import os
import threading
import uuid

import pytest
from conftest import SMALL_SF, rows
from pyspark.sql import functions as F

from dimforge import schemas
from dimforge.config import DEFAULT
from dimforge.operators import bounded_fits, narrowed, origin_registry, sizes_of
from dimforge.plans import loads
from dimforge.sources import (
    PublishConflict,
    PublishUnknown,
    input_token,
    publish,
    publish_part,
    published_parts,
    remove_orphans,
    snapshot,
    snapshot_once,
    snapshot_path,
)
from dimforge.sources.driver_tables import DriverTables

OWNER = "dimforge_protocol"


@pytest.fixture
def place(spark):
    """(table, base folder) of their own."""
    return f"t_{uuid.uuid4().hex[:8]}", snapshot_path(spark, "tests", uuid.uuid4().hex)


def folders(base, table):
    path = f"{base}/{OWNER}/{table}".replace("file:", "")
    return sorted(os.listdir(path)) if os.path.isdir(path) else []


def count(spark, table):
    return spark.table(f"{OWNER}.{table}").count()


# ------------------------------------------------------------------ outcomes
def test_update_that_fails_after_it_took_effect_counts_as_published(spark, place, monkeypatch):
    table, base = place
    publish(spark.range(3), OWNER, table, base)
    real, calls = snapshot._point, []

    def told_late(*args):
        real(*args)
        calls.append(1)
        raise OSError("connection reset")

    monkeypatch.setattr(snapshot, "_point", told_late)
    assert publish(spark.range(7), OWNER, table, base, pause=0)
    assert len(calls) == 1 and count(spark, table) == 7 and len(folders(base, table)) == 2


def test_update_that_fails_before_it_is_tried_again_with_the_same_version(spark, place, monkeypatch):
    table, base = place
    real, calls = snapshot._point, []

    def flaky(*args):
        calls.append(args[3])
        if len(calls) < 3:
            raise OSError("no answer")
        real(*args)

    monkeypatch.setattr(snapshot, "_point", flaky)
    assert publish(spark.range(4), OWNER, table, base, pause=0)
    assert len(set(calls)) == 1 and len(calls) == 3 and len(folders(base, table)) == 1


def test_unknown_outcome_keeps_the_folder_until_it_is_an_old_orphan(spark, place, monkeypatch):
    table, base = place
    publish(spark.range(2), OWNER, table, base)
    parts, down = snapshot.published_parts, []
    monkeypatch.setattr(snapshot, "_point", lambda *a: (down.append(1), (_ for _ in ()).throw(ValueError("odd answer")))[1])
    monkeypatch.setattr(snapshot, "published_parts", lambda *a: (_ for _ in ()).throw(OSError("down")) if down else parts(*a))
    with pytest.raises(PublishUnknown):
        publish(spark.range(5), OWNER, table, base, pause=0)
    monkeypatch.setattr(snapshot, "published_parts", parts)
    assert len(folders(base, table)) == 2
    assert remove_orphans(spark, OWNER, table, base) == []
    assert len(remove_orphans(spark, OWNER, table, base, older_than_hours=0)) == 1
    assert len(folders(base, table)) == 1 and count(spark, table) == 2


def test_a_refused_update_leaves_no_folder(spark, place, monkeypatch):
    table, base = place
    monkeypatch.setattr(snapshot, "_point", lambda *a: (_ for _ in ()).throw(ValueError("not allowed")))
    with pytest.raises(ValueError):
        publish(spark.range(5), OWNER, table, base)
    assert folders(base, table) == []


def test_tries_pause_longer_each_time(spark, place, monkeypatch):
    table, base = place
    slept = []
    monkeypatch.setattr(snapshot, "_wait", slept.append)
    monkeypatch.setattr(snapshot, "_point", lambda *a: (_ for _ in ()).throw(OSError("down")))
    with pytest.raises(RuntimeError):
        publish(spark.range(1), OWNER, table, base, retries=5, pause=1.0)
    assert slept == [1.0, 2.0, 4.0, 8.0]


# ---------------------------------------------------------------- publishers
def test_publishers_at_the_same_time_leave_one_readable_version(spark, place):
    table, base = place
    failed = []

    def run(n):
        try:
            for _ in range(3):
                publish(spark.range(n), OWNER, table, base, keep_versions=1)
        except Exception as err:  # noqa: BLE001 - told below
            failed.append(err)

    threads = [threading.Thread(target=run, args=(n,)) for n in (3, 5, 8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and count(spark, table) in (3, 5, 8)
    (part,) = published_parts(spark, OWNER, table)
    assert part.path.rpartition("/")[2] in folders(base, table)


def test_a_publisher_that_wants_no_other_gives_up(spark, place, monkeypatch):
    table, base = place
    publish(spark.range(1), OWNER, table, base)
    real = snapshot.stored.write

    def overtaken(df, path, *args):
        out = real(df, path, *args)
        monkeypatch.setattr(snapshot.stored, "write", real)
        publish(spark.range(9), OWNER, table, base)
        return out

    monkeypatch.setattr(snapshot.stored, "write", overtaken)
    with pytest.raises(PublishConflict):
        publish(spark.range(2), OWNER, table, base, if_unchanged=True)
    assert count(spark, table) == 9 and len(folders(base, table)) == 2


def test_the_version_in_use_outlives_a_clock_that_went_back(spark, place, monkeypatch):
    table, base = place
    for n in (1, 2):
        publish(spark.range(n), OWNER, table, base)
    monkeypatch.setattr(snapshot, "_stamp", lambda: "19990101000000")
    for n in (3, 4):
        publish(spark.range(n), OWNER, table, base, keep_versions=1)
        assert count(spark, table) == n
    assert len(folders(base, table)) == 1


def test_a_real_table_is_renamed_only_when_asked(spark, place):
    table, base = place
    publish(spark.range(1), OWNER, f"{table}_x", base)  # makes the database
    spark.range(6).write.saveAsTable(f"{OWNER}.{table}")
    with pytest.raises(ValueError, match="replace_table"):
        publish(spark.range(2), OWNER, table, base)
    assert count(spark, table) == 6 and folders(base, table) == []
    assert publish(spark.range(2), OWNER, table, base, replace_table=True)
    aside = [t.name for t in spark.catalog.listTables(OWNER) if t.name.startswith(f"{table}_replaced_")]
    assert count(spark, table) == 2 and [count(spark, a) for a in aside] == [6]


# ------------------------------------------------------------------ snapshots
def test_snapshot_is_redone_for_other_columns_or_another_input(spark):
    path = snapshot_path(spark, "tests", uuid.uuid4().hex, "keyed")
    assert snapshot_once(spark.range(3), path, "a").count() == 3
    assert snapshot_once(spark.range(9), path, "a").count() == 3
    assert snapshot_once(spark.range(9), path).count() == 3
    assert snapshot_once(spark.range(4), path, "b").count() == 4
    wider = spark.range(2).selectExpr("id", "'x' AS s")
    assert rows(snapshot_once(wider, path, "b")) == [(0, "x"), (1, "x")]
    assert snapshot_once(spark.range(5).selectExpr("CAST(id AS INT) AS id"), path).dtypes == [("id", "int")]


def test_snapshot_written_by_other_means(spark):
    path = snapshot_path(spark, "tests", uuid.uuid4().hex, "foreign")
    spark.range(3).write.parquet(path)
    assert snapshot_once(spark.range(8), path).count() == 3
    assert snapshot_once(spark.range(8), path, "token").count() == 8


def test_a_write_that_dies_before_its_key_is_stale(spark, monkeypatch):
    path = snapshot_path(spark, "tests", uuid.uuid4().hex, "died")
    snapshot_once(spark.range(3), path, "a")
    monkeypatch.setattr(snapshot.stored, "put_text", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        snapshot_once(spark.range(5), path, "b")
    monkeypatch.undo()
    assert snapshot_once(spark.range(6), path, "a").count() == 6


def test_input_token_follows_the_files(spark):
    path = snapshot_path(spark, "tests", uuid.uuid4().hex, "input")
    spark.range(3).write.parquet(path)
    first = input_token(spark.read.parquet(path))
    assert first == input_token(spark.read.parquet(path).where("id > 1").select("id"))
    spark.range(3).write.mode("append").parquet(path)
    assert first != input_token(spark.read.parquet(path))
    with pytest.raises(ValueError):
        input_token(spark.range(3))


def test_field_load_redoes_the_legacy_snapshot_of_another_input(spark, place):
    _, base = place
    t = DriverTables(spark, SMALL_SF)
    copy = f"{base}/raw/ga_saf_divi3"
    raw = t.field_raw()
    raw["ga_saf_divi3"].write.parquet(copy)
    owner, snap, reg = f"dimforge_f_{uuid.uuid4().hex[:8]}", f"{base}/snap", origin_registry(spark)

    def legacy():
        loads.load_field({**raw, "ga_saf_divi3": spark.read.parquet(copy)}, reg, owner, base, legacy_snapshot=snap)
        return loads.published(spark, owner, loads.FIELD_TABLE).where("ID_ORIGEM_DB = 1000").count()

    before = legacy()
    raw["ga_saf_divi3"].limit(20).selectExpr("ID_DIVI3 + 900000 AS ID_DIVI3", "'P9' AS COD_DIVI1", "COD_DIVI3", "DSC_DIVI3",
                                             "DV3_AREA_LIQ", "COD_EMPR").write.mode("append").parquet(copy)
    assert legacy() == before + 20


# --------------------------------------------------------------------- sizes
def no_jobs(spark, work):
    """The result of ``work``, which may run no Spark job."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = work()
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        return out
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_recorded_sizes_spare_the_count(spark, place):
    table, base = place
    df = spark.range(100).selectExpr("id", "repeat('é', CAST(id % 5 AS INT)) AS name", "CAST(id AS DECIMAL(10,2)) AS d",
                                     "IF(id % 2 = 0, NULL, 'x') AS half")
    publish(df, OWNER, table, base)
    held = loads.published(spark, OWNER, table)
    assert sizes_of(held).rows == 100 and dict(sizes_of(held).bytes) == {"name": 400, "half": 50}
    small = narrowed(held, F.col("id") > 3, ("id", "key"), "name")
    assert rows(small) == rows(held.where("id > 3").select(F.col("id").alias("key"), "name"))
    wide = narrowed(held, None, "id", "d")
    assert no_jobs(spark, lambda: bounded_fits([small, wide], 100, 2400)) == [True, True]
    # beyond the bound by what was recorded: counted, as a filter may leave fewer rows
    assert bounded_fits([narrowed(held, F.col("id") > 97, "id")], 2) == [True]
    assert bounded_fits([narrowed(held, None, "id")], 99) == [False]
    plain = df.select("id")
    assert sizes_of(narrowed(plain, None, "id")) is None and bounded_fits([plain], 100) == [True]


def test_snapshots_note_their_sizes_too(spark):
    path = snapshot_path(spark, "tests", uuid.uuid4().hex, "sized")
    first = snapshot_once(spark.range(10).selectExpr("id", "'abc' AS s"), path)
    for df in (first, snapshot_once(spark.range(10).selectExpr("id", "'abc' AS s"), path)):
        assert sizes_of(df).rows == 10 and sizes_of(df).bytes == {"s": 30}


# ------------------------------------------------------- folders by origin
def two_origins(spark):
    return spark.range(40).selectExpr("id", "CAST(IF(id % 4 = 0, 1000, 2000) AS INT) AS ID_ORIGEM_DB", "concat('n', id) AS name")


def test_partitioned_table_keeps_its_columns_and_prunes(spark, place):
    table, base = place
    df = two_origins(spark)
    assert publish(df, OWNER, table, base, partition_by="ID_ORIGEM_DB")
    got = spark.table(f"{OWNER}.{table}")
    assert got.dtypes == df.dtypes and rows(got) == rows(df)
    plan = got.where("ID_ORIGEM_DB = 1000")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ID_ORIGEM_DB" in plan and "1000" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert publish(df.limit(0), OWNER, table, base, partition_by="ID_ORIGEM_DB", require_rows=False)
    assert spark.table(f"{OWNER}.{table}").dtypes == df.dtypes and count(spark, table) == 0


def test_one_origin_is_renewed_and_the_others_files_stay(spark, place):
    table, base = place
    df = two_origins(spark)
    publish(df, OWNER, table, base, partition_by="ID_ORIGEM_DB")
    read = lambda: spark.table(f"{OWNER}.{table}")
    old = set(read().where("ID_ORIGEM_DB = 2000").inputFiles())
    for k in (1, 2):
        part = df.where("ID_ORIGEM_DB = 1000").withColumn("name", F.concat("name", F.lit(f" new {k}")))
        assert publish_part(part, OWNER, table, "ID_ORIGEM_DB", 1000, base, keep_versions=1)
        assert rows(read()) == rows(df.where("ID_ORIGEM_DB = 2000").unionByName(part))
        assert set(read().where("ID_ORIGEM_DB = 2000").inputFiles()) >= old
        assert len(folders(base, table)) == 2  # both are named, so both stay
    assert publish_part(df.where("ID_ORIGEM_DB = 2000").limit(3), OWNER, table, "ID_ORIGEM_DB", 2000, base, keep_versions=1)
    assert read().where("ID_ORIGEM_DB = 2000").count() == 3 and read().where("ID_ORIGEM_DB = 1000").count() == 10
    assert publish_part(df.limit(0).selectExpr("id", "ID_ORIGEM_DB", "name"), OWNER, table, "ID_ORIGEM_DB", 1000, base, require_rows=False)
    assert count(spark, table) == 3


def test_a_part_that_does_not_belong_is_refused(spark, place):
    table, base = place
    df = two_origins(spark)
    with pytest.raises(ValueError, match="not published"):
        publish_part(df, OWNER, table, "ID_ORIGEM_DB", 1000, base)
    publish(df, OWNER, table, base)
    with pytest.raises(ValueError, match="partition_by"):
        publish_part(df.where("ID_ORIGEM_DB = 1000"), OWNER, table, "ID_ORIGEM_DB", 1000, base)
    publish(df, OWNER, table, base, partition_by="ID_ORIGEM_DB")
    with pytest.raises(ValueError, match="rows are not of"):
        publish_part(df, OWNER, table, "ID_ORIGEM_DB", 1000, base)
    with pytest.raises(ValueError, match="columns differ"):
        publish_part(df.drop("name"), OWNER, table, "ID_ORIGEM_DB", 1000, base)
    assert not publish_part(df.limit(0), OWNER, table, "ID_ORIGEM_DB", 1000, base)
    assert rows(spark.table(f"{OWNER}.{table}")) == rows(df)


def test_reload_of_one_origin_leaves_the_other_alone(spark, place):
    _, base = place
    owner, reg = f"dimforge_o_{uuid.uuid4().hex[:8]}", origin_registry(spark)
    raw = DriverTables(spark, SMALL_SF).site_raw()
    loads.load_site(raw, reg, owner, base, analysis=True, keep_versions=2)
    read = lambda origin: loads.published(spark, owner, loads.SITE_TABLE).where(F.col("ID_ORIGEM_DB") == origin)
    current, files = rows(read(schemas.CURRENT)), set(read(schemas.CURRENT).inputFiles())
    half = {**raw, "ga_empr": raw["ga_empr"].where("COD_EMPR % 2 = 0"), "Upnivel2": raw["Upnivel2"].limit(0)}
    before = read(schemas.LEGACY).count()
    assert loads.reload_origin(half, reg, owner, loads.SITE_TABLE, schemas.LEGACY, base, DEFAULT)
    assert 0 < read(schemas.LEGACY).count() < before
    assert rows(read(schemas.CURRENT)) == current and set(read(schemas.CURRENT).inputFiles()) >= files
    assert "ID_FAZENDA_PROD" in read(schemas.LEGACY).columns


def test_the_fact_reads_the_folders_of_an_origin_and_counts_no_stored_lookup(spark, place):
    from dimforge.operators import check_lookups, proven_small
    from dimforge.plans.planning import build_planning, planning_lookups

    _, base = place
    owner, reg, t = f"dimforge_p_{uuid.uuid4().hex[:8]}", origin_registry(spark), DriverTables(spark, SMALL_SF)
    for table, df in ((loads.SEASON_TABLE, t.season()), (loads.CROP_TABLE, t.crop()), (loads.FARM_TABLE, t.farm())):
        publish(df, owner, table, base)
    loads.load_field(t.field_raw(), reg, owner, base)
    loads.load_site(t.site_raw(), reg, owner, base)
    loads.load_variety(t.variety_raw(), reg, owner, base)
    dims, raw = loads.published_conformed(spark, owner), t.planning_raw()
    stored = {k: v for k, v in planning_lookups(raw, dims).items() if k not in ("scenarios", "periods", "active")}
    assert len(stored) == 12 and all(proven_small(df) for df in stored.values()) and "site_farm_key" not in stored
    no_jobs(spark, lambda: check_lookups(stored.values()))
    fact = build_planning(raw, dims, reg)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    for origin in (schemas.CURRENT, schemas.LEGACY):
        assert plan.count(f"PartitionFilters: [isnotnull(ID_ORIGEM_DB") >= 6 and f"= {origin})]" in plan
    assert "SortMergeJoin" not in plan
    plain = loads.ConformedTables(**{k: getattr(dims, k).select("*") for k in ("field", "season", "variety", "crop", "site", "farm")})
    assert rows(build_planning(raw, plain, reg)) == rows(fact)
