"""Catalog access, snapshots, publishing and previews."""

import os
import threading
import uuid

import pytest
from conftest import SMALL_SF, rows
from pyspark.errors import AnalysisException, PySparkException

from dimforge.config import shared_dir
from dimforge.sources import RawTables, ensure_database, is_complete, preview, publish, register_views, snapshot_once
from dimforge.sources.snapshot import is_io_failure, snapshot_path


def test_shared_dir_comes_from_session(spark):
    d = shared_dir(spark)
    assert d and d == shared_dir(spark)


def test_raw_tables_by_path_and_catalog(spark):
    ensure_database(spark, "dimforge_raw")
    spark.read.parquet(f"{SMALL_SF}/region.parquet").createOrReplaceTempView("region_view")
    tables = RawTables(spark, {"regiao": f"{SMALL_SF}/region.parquet", "view": "region_view"})
    assert sorted(tables) == ["regiao", "view"] and len(tables) == 2
    assert tables["regiao"].count() == tables["view"].count() == 5
    assert spark.catalog.databaseExists("dimforge_raw")


def test_snapshot_once_writes_then_reads(spark):
    path = snapshot_path(spark, "tests", uuid.uuid4().hex, "snap")
    df = spark.range(3)
    assert not is_complete(spark, path)
    assert rows(snapshot_once(df, path)) == [(0,), (1,), (2,)]
    assert is_complete(spark, path)
    # existing snapshot is read, not recomputed from the new frame
    assert snapshot_once(spark.range(10), path).count() == 3


def test_snapshot_redone_when_incomplete(spark):
    path = snapshot_path(spark, "tests", uuid.uuid4().hex, "partial")
    spark.range(2).write.parquet(path)
    os.remove(os.path.join(path.replace("file:", ""), "_SUCCESS"))
    assert snapshot_once(spark.range(4), path).count() == 4


def test_publish_swaps_versions_and_refuses_empty(spark):
    owner, table = "dimforge_pub", f"t_{uuid.uuid4().hex[:8]}"
    base = snapshot_path(spark, "tests", uuid.uuid4().hex)
    assert publish(spark.range(3), owner, table, base)
    assert spark.table(f"{owner}.{table}").count() == 3
    assert publish(spark.range(5), owner, table, base)
    assert spark.table(f"{owner}.{table}").count() == 5
    assert not publish(spark.range(0), owner, table, base)
    assert spark.table(f"{owner}.{table}").count() == 5
    # a new schema replaces the table definition
    assert publish(spark.range(2).selectExpr("id", "'x' AS s"), owner, table, base)
    assert spark.table(f"{owner}.{table}").columns == ["id", "s"]


def _folders(base, owner, table):
    path = f"{base}/{owner}/{table}".replace("file:", "")
    return sorted(os.listdir(path)) if os.path.isdir(path) else []


def test_publish_tries_a_data_error_once_and_leaves_no_folder(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    owner, table = "dimforge_pub", f"t_{uuid.uuid4().hex[:8]}"
    base = snapshot_path(spark, "tests", uuid.uuid4().hex)
    saves, save = [], DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a, **k: (saves.append(a), save(self, *a, **k))[1])
    with pytest.raises(PySparkException):
        publish(spark.range(3).selectExpr("CAST('x' || id AS INT) AS n"), owner, table, base)
    assert len(saves) == 1 and _folders(base, owner, table) == []
    assert not spark.catalog.tableExists(f"{owner}.{table}")


def test_publish_tries_io_failures_again(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    owner, table = "dimforge_pub", f"t_{uuid.uuid4().hex[:8]}"
    base = snapshot_path(spark, "tests", uuid.uuid4().hex)
    saves, save = [], DataFrameWriter.save

    def flaky(self, *a, **k):
        saves.append(a)
        if len(saves) < 3:
            raise OSError("store is busy")
        return save(self, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "save", flaky)
    assert publish(spark.range(3), owner, table, base)
    assert len(saves) == 3 and len(_folders(base, owner, table)) == 1
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a, **k: (_ for _ in ()).throw(OSError("down")))
    with pytest.raises(RuntimeError):
        publish(spark.range(3), owner, table, base, retries=2)


def test_io_failure_is_told_from_a_data_error(spark):
    jvm = spark.sparkContext._jvm

    class Told(Exception):
        def __init__(self, cause):
            self._origin = cause

    assert is_io_failure(Told(jvm.java.lang.RuntimeException(jvm.java.io.FileNotFoundException("gone"))))
    assert not is_io_failure(Told(jvm.java.lang.NumberFormatException("bad")))
    assert is_io_failure(OSError()) and not is_io_failure(ValueError())


def test_readers_always_find_a_table_when_columns_change(spark):
    owner, table = "dimforge_pub", f"t_{uuid.uuid4().hex[:8]}"
    base = snapshot_path(spark, "tests", uuid.uuid4().hex)
    publish(spark.range(3), owner, table, base)
    stop, missing = threading.Event(), []

    def read():
        while not stop.is_set():
            if not spark.catalog.tableExists(f"{owner}.{table}"):
                missing.append(1)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(6):
            publish(spark.range(2).selectExpr("id", f"'x' AS s{k}"), owner, table, base)
    finally:
        stop.set()
        reader.join()
    assert not missing and spark.table(f"{owner}.{table}").columns == ["id", "s5"]


def test_publish_keeps_as_many_versions_as_asked(spark):
    owner, table = "dimforge_pub", f"t_{uuid.uuid4().hex[:8]}"
    base = snapshot_path(spark, "tests", uuid.uuid4().hex)
    for n in (1, 2, 3, 4):
        publish(spark.range(n), owner, table, base, keep_versions=2)
    assert len(_folders(base, owner, table)) == 2 and spark.table(f"{owner}.{table}").count() == 4
    assert not publish(spark.range(0), owner, table, base)
    assert len(_folders(base, owner, table)) == 2
    with pytest.raises(ValueError):
        publish(spark.range(1), owner, table, base, keep_versions=0)


def test_only_a_missing_path_counts_as_no_snapshot(spark):
    class Denied:
        class read:
            @staticmethod
            def text(path):
                raise AnalysisException("denied", errorClass="INSUFFICIENT_PERMISSIONS", messageParameters={})

    with pytest.raises(AnalysisException):
        is_complete(Denied(), "/denied")


def test_shared_dir_is_required():
    class Context:
        master = "local[2]"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        shared_dir(Session)


def test_preview_and_views(spark):
    df = spark.createDataFrame([(1, "PZ", 2021), (2, "PZ", 2020), (3, "AB", 2021)], "id int, farm string, y int")
    assert rows(preview(df, farm="PZ", y=2021)) == [(1, "PZ", 2021)]
    register_views({"dimforge_preview": df})
    assert spark.sql("SELECT id FROM dimforge_preview WHERE farm = 'AB'").first()[0] == 3


def test_preview_number_against_text_column(spark):
    df = spark.createDataFrame([("100035", 1), ("10003A", 2)], "ID_SEDE string, n int")
    assert rows(preview(df, ID_SEDE=100035)) == [("100035", 1)]
    codes = spark.createDataFrame([("0429",), ("429",), ("429.0",), ("42A",), (None,)], "c string")
    assert rows(preview(codes, c=429)) == [("0429",), ("429",), ("429.0",)]
    assert rows(preview(codes, c="429")) == [("429",)]
    assert rows(preview(codes, c=None)) == [(None,)]


def test_settings_from_session_conf(spark):
    from dimforge.config import Settings

    keys = {"spark.dimforge.broadcastMaxRows": "10", "spark.dimforge.broadcastMaxBytes": "2048",
            "spark.dimforge.broadcastBudgetBytes": "4096", "spark.dimforge.strictCasts": "true",
            "spark.dimforge.redactTaxIds": "true"}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        assert Settings.from_conf(spark) == Settings(10, 2048, 4096, True, True)
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert Settings.from_conf(spark) == Settings()
