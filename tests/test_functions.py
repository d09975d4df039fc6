"""Column functions on literal rows, including NULL, blank and malformed input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimforge.functions import (
    COMPACT_STAMP,
    DAY_MONTH_YEAR,
    business_key,
    farm_code,
    first_available,
    flag_label,
    origin_key,
    positive_or_null,
    season_key_current,
    season_key_legacy,
    site_code,
    strip_separators,
    tax_id_mask,
    title_case,
    to_date,
    trimmed,
    typed,
    typed_constant,
    zero_if_null,
)


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_origin_key_concatenates_and_propagates_null(spark):
    df = spark.createDataFrame([(15, "07"), (None, "1"), (3, None)], "a bigint, b string")
    got = [r[0] for r in df.select(origin_key(2000, "a", "b")).collect()]
    assert got == ["20001507", None, None]


def test_origin_key_from_column(spark):
    df = spark.createDataFrame([(1000, 42)], "o int, k int")
    assert df.select(origin_key(F.col("o"), "k")).first()[0] == "100042"


def test_business_key_collision_is_kept(spark):
    # documented: separator-less keys of different split collide
    df = spark.createDataFrame([(1, 23), (12, 3)], "a int, b int")
    got = [r[0] for r in df.select(business_key(F.lit(2000), "a", "b")).collect()]
    assert got == ["2000123", "2000123"]


def test_strip_separators(spark):
    assert one_col(spark, ["2019/20-2", "2019/20", None, ""], strip_separators) == ["2019202", "201920", None, ""]


def test_season_key_current_branches(spark):
    df = spark.createDataFrame([
        (5, "ERP7", "Safra 2019/20-2"),   # ERP code wins: last char '7'
        (5, None, "Safra 2019/20-2"),     # dash part '-2' -> '2'
        (5, None, "Safra 2019/20"),       # no dash -> '-1' -> '1'
        (5, None, None),                  # all missing -> '1'
        (None, "X", "a-b"),               # season id missing -> NULL
        (5, "", "a-b"),                   # blank ERP code is a value: no suffix
    ], "sid int, erp string, descr string")
    got = [r[0] for r in df.select(season_key_current(2000, "sid", "erp", "descr")).collect()]
    assert got == ["200057", "200052", "200051", "200051", None, "20005"]


def test_season_key_legacy(spark):
    got = one_col(spark, ["2019/20", "2019/20-2", "2021/22-3", None, "", "20"], season_key_legacy)
    assert got == ["20191", "20192", "20213", None, "1", "201"]


def test_site_and_farm_codes(spark):
    values = ["FZPZ", "FZPZII", "FZPZIII", "FZAB-I", None]
    assert one_col(spark, values, site_code) == ["PZ01", "PZ02", "PZ03", "AB01", None]
    assert one_col(spark, values, farm_code) == ["PZ", "PZ", "PZ", "AB", None]


def test_positive_or_null(spark):
    assert one_col(spark, [5, 0, -3, None], positive_or_null, "int") == [5, None, None, None]


def test_flag_labels_per_system(spark):
    assert one_col(spark, ["S", "N", None, "s"], lambda c: flag_label(c, "S", "Sim", "Não")) == \
        ["Sim", "Não", "Não", "Não"]
    assert one_col(spark, [1, 0, None], lambda c: flag_label(c, 1, "SIM", "NAO"), "int") == ["SIM", "NAO", "NAO"]


def test_first_available_and_zero(spark):
    df = spark.createDataFrame([(None, 7), (3, 7), (None, None)], "item int, grp int")
    assert [r[0] for r in df.select(first_available("item", "grp")).collect()] == [7, 3, None]
    assert [r[0] for r in df.select(zero_if_null("item")).collect()] == [0, 3, 0]


def test_title_case_splits_on_blanks_only(spark):
    got = one_col(spark, ["rio-preto", "SÃO PAULO", "  dois  espaços", None], title_case)
    assert got == ["Rio-preto", "São Paulo", "  Dois  Espaços", None]


def test_trimmed(spark):
    assert one_col(spark, ["  12 ", None], trimmed) == ["12", None]


@pytest.mark.parametrize("raw,masked", [
    ("12345678000195", "12.345.678/0001-95"),
    ("12.345.678/0001-95", "12.345.678/0001-95"),
    ("123", "00.000.000/0001-23"),
    ("", None),
    ("abc", None),
    (None, None),
    ("1234567890123456", "1234567890123456"),
])
def test_tax_id_mask(spark, raw, masked):
    assert one_col(spark, [raw], tax_id_mask) == [masked]


def test_tax_id_mask_redacted(spark):
    assert one_col(spark, ["12345678000195"], lambda c: tax_id_mask(c, redact=True)) == ["12.***.***/0001-95"]


def test_to_date_patterns(spark):
    assert one_col(spark, ["31/12/2020", "2020-12-31", None], lambda c: to_date(c, DAY_MONTH_YEAR)) == \
        [dt.date(2020, 12, 31), None, None]
    # 24-hour clock: hours 00 and 14 parse (a 12-hour pattern would reject them)
    stamps = ["20200115000000", "20200115143000", "2020011514", None]
    assert one_col(spark, stamps, lambda c: to_date(c, COMPACT_STAMP)) == \
        [dt.date(2020, 1, 15), dt.date(2020, 1, 15), None, None]


def test_to_date_of_timestamp_ignores_pattern(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 3, 4, 13, 0),)], "x timestamp")
    assert df.select(to_date("x", DAY_MONTH_YEAR), to_date("x")).first() == (dt.date(2021, 3, 4),) * 2


def test_to_date_strict_raises(spark):
    df = spark.createDataFrame([("bad",)], "x string")
    with pytest.raises(Exception):
        df.select(to_date("x", DAY_MONTH_YEAR, strict=True)).collect()


def test_typed_try_and_strict(spark):
    df = spark.createDataFrame([("12",), ("12x",), (None,)], "x string")
    assert [r[0] for r in df.select(typed("x", "int")).collect()] == [12, None, None]
    with pytest.raises(Exception):
        df.select(typed("x", "int", strict=True)).collect()


def test_typed_constants(spark):
    df = spark.range(1)
    row = df.select(typed_constant(None, "timestamp").alias("t"), typed_constant(0, "decimal(18,6)").alias("d"))
    assert [f.dataType.simpleString() for f in row.schema.fields] == ["timestamp", "decimal(18,6)"]
    assert tuple(row.first()) == (None, 0)
