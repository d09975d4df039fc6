"""Counts of malformed values and of rows without a match; the report of unmatched sites; declared raw columns."""

import json
import os
import uuid
from dataclasses import replace

import pytest
from conftest import SMALL_SF, rows
from pyspark.sql import functions as F

from dimforge import schemas
from dimforge.__main__ import main
from dimforge.audit import Audit
from dimforge.config import DEFAULT
from dimforge.operators import Lookup, match_flags, origin_registry
from dimforge.plans import build_field, build_planning, build_site, build_variety
from dimforge.plans.site import MISSING_FLAGS, unmatched_sites
from dimforge.queries import conformed_tables
from dimforge.sources import RAW_COLUMNS, RawColumnsMissing, RawTables, declared, snapshot_path
from dimforge.sources.driver_tables import DriverTables


def audited():
    audit = Audit()
    return audit, replace(DEFAULT, audit=audit)


def test_field_counts_values_that_are_none_of_their_type(spark):
    raw = DriverTables(spark, SMALL_SF).field_raw()
    audit, settings = audited()
    got = build_field(raw, origin_registry(spark), settings)
    assert rows(got) == rows(build_field(raw, origin_registry(spark)))
    counts = audit.counts()
    assert counts["QT_AREA_PROD"] == {"not_typed": raw["Upn3_fisico"].where("QT_AREA_PROD = 'n/a'").count()}
    assert counts["QT_AREA_PROD"]["not_typed"] > 0 and counts["ID_UPN3_FISICO"] == {"not_typed": 0}


def site_fixture(spark):
    text = lambda cols, data: spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols.split()))
    return {
        "Upnivel2": text("ID_UPNIVEL2 DA_UPNIVEL2 DE_UPNIVEL2 ID_UPNIVEL1", [
            ("1", "S1", "whole", "10"), ("2", "S2", "no unit", "99"), ("3", "S3", "key n/a", "n/a"), ("4", "S4", "no branch", "11"),
            ("5", "S5", "no town", "12"), ("6", "S6", "no state", "13"), ("7", "S7", "no region", "14"), ("2", "S2", "no unit", "99")]),
        "Upnivel1": text("ID_UPNIVEL1 CD_INT_ERP ID_FILIAL", [
            ("10", "F1", "20"), ("11", "F1", "98"), ("12", "F1", "21"), ("13", "F1", "22"), ("14", "F9", "20")]),
        "filial": text("ID_FILIAL ID_MUNICIPIO NO_CNPJ ID_EMPRESA", [("20", "30", "1", "1"), ("21", "97", "1", "1"), ("22", "31", "1", "1")]),
        "municipio": text("ID_MUNICIPIO ID_UNIFEDERACAO DE_MUNICIPIO", [("30", "40", "town"), ("31", "96", "town")]),
        "unifederacao": text("ID_UNIFEDERACAO CD_UF", [("40", "MT")]),
        "dim_regiaofazendas": text("TITLE REGIAO1 REGIAO2", [("F1", "R", "A"), ("F1", "R2", "A"), ("PZ", "R", "B")]),
        "ga_empr": text("COD_EMPR COD_EMPR_PROD ABV_EMPR DSC_EMPR EMP_UF EMP_CIDAD EMP_CGC", [
            ("100", "1", "FZPZ", "a", "MT", "b", "1"), ("101", "1", "FZXX", "a", "MT", "b", "1")]),
    }


def test_site_counts_rows_that_its_inner_joins_lose(spark):
    raw = site_fixture(spark)
    raw["dim_regiaofazendas"] = raw["dim_regiaofazendas"].limit(1).unionByName(raw["dim_regiaofazendas"].where("TITLE = 'PZ'"))
    audit, settings = audited()
    got = build_site(raw, origin_registry(spark), settings)
    assert rows(got) == rows(build_site(raw, origin_registry(spark)))
    counts = audit.counts()
    assert counts["join on ID_UPNIVEL1"] == {"rows": 8, "lost": 3}
    assert counts["join on ID_FILIAL"] == {"rows": 5, "lost": 1}
    assert counts["join on ID_MUNICIPIO"] == {"rows": 4, "lost": 1}
    assert counts["join on ID_UNIFEDERACAO"] == {"rows": 3, "lost": 1}
    assert counts["ID_UPNIVEL1"]["not_typed"] == 1 and counts["ID_UPNIVEL2"]["not_typed"] == 0


def test_planning_and_variety_are_the_same_when_audited(spark):
    t, reg = DriverTables(spark, SMALL_SF), origin_registry(spark)
    audit, settings = audited()
    assert rows(build_variety(t.variety_raw(), reg, settings)) == rows(build_variety(t.variety_raw(), reg))
    assert audit.counts()["QT_DIAS_MATUR"]["not_typed"] == t.table("part").where("p_partkey % 97 = 0").count()
    dims = conformed_tables(spark, SMALL_SF)
    raw = t.planning_raw()
    raw["upn3_plan"] = raw["upn3_plan"].withColumn(
        "QT_AREA_PROD", F.when(F.col("ID_UPN3_PLAN") % 50 == 0, F.lit("n/a")).otherwise(F.col("QT_AREA_PROD").cast("string")))
    audit, settings = audited()
    assert rows(build_planning(raw, dims, reg, settings)) == rows(build_planning(raw, dims, reg))
    counts = audit.counts()
    wanted = raw["Cenario"].where("DA_CENARIO = 'PLAN'").select("ID_CENARIO")
    bad = raw["upn3_plan"].join(wanted, "ID_CENARIO", "left_semi").where("QT_AREA_PROD = 'n/a'").count()
    assert counts["QT_AREA_PROD"]["not_typed"] == bad > 0
    # every period has its season, one supplier in 19 no period; fields are the divisions whose code begins with P
    assert counts["join on ID_PERIODOSAFRA"]["lost"] > 0 and counts["join on ID_SAFRA"]["lost"] == 0
    assert 0 < counts["join on K_FIELD"]["lost"] < counts["join on K_FIELD"]["rows"]


def test_a_part_that_never_ran_is_left_out(spark):
    audit, settings = audited()
    build_field(DriverTables(spark, SMALL_SF).field_raw(), origin_registry(spark), settings)
    assert audit.counts(wait=0.2) == {}


def test_command_line_prints_what_was_lost(spark, tmp_path, capsys):
    base = snapshot_path(spark, "tests", uuid.uuid4().hex)
    locations = {}
    for name, df in DriverTables(spark, SMALL_SF).field_raw().items():
        locations[name] = f"{base}/raw/{name}"
        (df.drop("DT_INATIVACAO") if name == "Upn3_fisico" else df).write.parquet(locations[name])
    tables = os.path.join(tmp_path, "tables.json")
    with open(tables, "w") as f:
        json.dump(locations, f)
    args = ["field", "--tables", tables, "--owner", f"dimforge_cli_{uuid.uuid4().hex[:8]}", "--base-path", base, "--keep-versions", "2"]
    with pytest.raises(RawColumnsMissing, match="Upn3_fisico lacks DT_INATIVACAO"):
        main(args)
    main([*args, "--missing-columns", "null", "--audit"])
    told = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert told["lost"]["QT_AREA_PROD"]["not_typed"] > 0
    assert main([*args, "--missing-columns", "null", "--origin", "1000"]) == {"LAVOURA_FISICA": True}
    with pytest.raises(SystemExit):
        main(["all", *args[1:], "--origin", "1000"])


# ------------------------------------------------------------ unmatched sites
def test_unmatched_sites_tell_each_missing_lookup(spark):
    got = {r[:3]: r[3:] for r in rows(unmatched_sites(site_fixture(spark)))}
    flags = lambda s: tuple({"y": True, "n": False, "-": None}[c] for c in s)
    assert got == {
        (2000, 2, "S2"): flags("yyyyy"), (2000, 3, "S3"): flags("yyyyy"), (2000, 4, "S4"): flags("nyyyn"),
        (2000, 5, "S5"): flags("nnyyn"), (2000, 6, "S6"): flags("nnnyn"), (2000, 7, "S7"): flags("nnnny"),
        (1000, 101, "XX01"): flags("----y")}
    assert list(MISSING_FLAGS)[0] == "SEM_UNIDADE"


def test_unmatched_sites_read_the_sites_once(spark):
    raw = DriverTables(spark, SMALL_SF).site_raw()
    plan = unmatched_sites(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("c_custkey#") and plan.count("Relation [c_custkey") == 1 and "LeftAnti" not in plan


@pytest.mark.parametrize("most", [0, 1000])
def test_match_flags_with_and_without_broadcast(spark, most):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, s string")
    look = spark.createDataFrame([("a", 10), ("a", 11), ("c", 12)], "s string, v int")
    settings = replace(DEFAULT, broadcast_max_rows=most)
    got = match_flags(left, [("has", Lookup(look, "s"))], settings).select("k", "v", "has")
    assert rows(got) == rows(spark.createDataFrame([(1, 10, True), (1, 11, True), (2, None, False), (3, None, False)], "k int, v int, has boolean"))


# --------------------------------------------------------------- raw columns
@pytest.mark.parametrize("table", sorted(RAW_COLUMNS))
def test_each_raw_table_names_a_missing_column(spark, table):
    columns = RAW_COLUMNS[table]
    whole = spark.range(1).select(*[F.lit("7").alias(c.lower()) for c in columns], F.lit(1).alias("more"))
    assert declared(whole, table.upper()).columns == list(columns)
    for gone in columns:
        short = whole.drop(gone.lower())
        if (table, gone) == ("ga_empr", "COD_EMPR_PROD"):
            assert declared(short, table).columns == [c for c in columns if c != gone]
        else:
            with pytest.raises(RawColumnsMissing, match=f"{table} lacks {gone};"):
                declared(short, table)
        filled = declared(short, table, "null")
        assert filled.columns == list(columns) and filled.first()[gone] is None and dict(filled.dtypes)[gone] == "string"


def test_stand_ins_hold_the_declared_columns(spark):
    t = DriverTables(spark, SMALL_SF)
    for raw in (t.field_raw(), t.site_raw(), t.variety_raw(), t.planning_raw()):
        for name, df in raw.items():
            assert set(declared(df, name).columns) == set(df.columns) == set(RAW_COLUMNS[name])


def test_raw_tables_check_what_they_read(spark):
    base = snapshot_path(spark, "tests", uuid.uuid4().hex)
    spark.range(2).selectExpr("id AS id_unifederacao", "'x' AS extra").write.parquet(f"{base}/uf")
    with pytest.raises(RawColumnsMissing):
        RawTables(spark, {"unifederacao": f"{base}/uf"})["unifederacao"]
    assert RawTables(spark, {"unifederacao": f"{base}/uf"}, "null")["unifederacao"].columns == ["ID_UNIFEDERACAO", "CD_UF"]
    assert RawTables(spark, {"other": f"{base}/uf"})["other"].columns == ["id_unifederacao", "extra"]
    with pytest.raises(ValueError):
        RawTables(spark, {"unifederacao": f"{base}/uf"}, "skip")["unifederacao"]
    assert schemas.LEGACY == 1000
