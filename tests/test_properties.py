"""Property tests: the column functions against small Python models of their rules,
on random text (one Spark job per generated batch)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from dimforge.functions import (
    season_key_current,
    season_key_legacy,
    site_code,
    strip_separators,
    tax_id_mask,
    title_case,
)

TEXT = st.text(alphabet="0123456789/-IZFabc ", max_size=14)
BATCH = st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=30)
RUNS = settings(max_examples=15, deadline=None)


def spark_values(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn("x")).collect()]


def model_legacy(code):
    if code is None:
        return None
    ninth = code[8:9]
    return code[:4] + (ninth if ninth else "1")


def model_site(abv):
    if abv is None:
        return None
    ordinal = "3" if "III" in abv else "2" if "II" in abv else "1"
    return abv[2:4] + "0" + ordinal


def model_strip(code):
    return None if code is None else code.replace("/", "").replace("-", "")


def model_title(s):
    return None if s is None else " ".join(w[:1].upper() + w[1:] for w in s.lower().split(" "))


def model_mask(s):
    if s is None:
        return None
    digits = re.sub(r"[^0-9]", "", s)
    if not digits:
        return None
    if len(digits) > 14:
        return digits
    d = digits.rjust(14, "0")
    return f"{d[:2]}.{d[2:5]}.{d[5:8]}/{d[8:12]}-{d[12:]}"


def model_current(sid, erp, desc):
    if sid is None:
        return None
    picked = erp
    if picked is None and desc is not None and "-" in desc:
        i = desc.index("-")
        picked = desc[i:i + 2]
    if picked is None:
        picked = "-1"
    return "2000" + str(sid) + picked[-1:]


@RUNS
@given(BATCH)
def test_season_key_legacy_model(spark, values):
    assert spark_values(spark, values, season_key_legacy) == [model_legacy(v) for v in values]


@RUNS
@given(BATCH)
def test_site_code_model(spark, values):
    assert spark_values(spark, values, site_code) == [model_site(v) for v in values]


@RUNS
@given(BATCH)
def test_strip_separators_model(spark, values):
    assert spark_values(spark, values, strip_separators) == [model_strip(v) for v in values]


@RUNS
@given(BATCH)
def test_title_case_model(spark, values):
    assert spark_values(spark, values, title_case) == [model_title(v) for v in values]


@RUNS
@given(BATCH)
def test_tax_id_mask_model(spark, values):
    assert spark_values(spark, values, tax_id_mask) == [model_mask(v) for v in values]


@RUNS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 999)), st.one_of(st.none(), TEXT),
                          st.one_of(st.none(), TEXT)), min_size=1, max_size=30))
def test_season_key_current_model(spark, rows):
    df = spark.createDataFrame(rows, "sid int, erp string, descr string")
    got = [r[0] for r in df.select(season_key_current(2000, "sid", "erp", "descr")).collect()]
    assert got == [model_current(*r) for r in rows]
