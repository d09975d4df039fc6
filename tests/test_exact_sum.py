"""Sums in longs equal sums of decimals, digit for digit."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from dimforge.operators import group_sum
from dimforge.operators.aggregate import exact_sum
from dimforge.plans.planning import AREA

INF, NAN = float("inf"), float("nan")


def values(seed):
    rng = random.Random(seed)
    made = [rng.choice([round(rng.uniform(-1e5, 1e5), rng.randint(0, 9)), float(rng.randint(-50, 50)), rng.uniform(-1, 1) * 10 ** rng.randint(-8, 15),
                        rng.choice([0.1, 0.3, -0.0, 1e-12, 0.00005, 109951162.7776, -109951162.7775, 2.0**40, NAN, INF, None])]) for _ in range(3000)]
    return [(rng.randrange(9), v) for v in made] + [(20, None), (20, None), (21, NAN), (22, 12345678901.12345), (22, 0.5)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_doubles(spark, seed):
    df = spark.createDataFrame(values(seed), "k int, v double").repartition(3)
    plain = df.groupBy("k").agg(F.sum(F.col("v").try_cast(AREA)).alias("s"))
    got = group_sum(df, ["k"], "v", "s", value_type=AREA)
    assert dict(got.collect()) == dict(plain.collect()) and got.dtypes == plain.dtypes
    assert dict(got.collect())[20] is None and dict(got.collect())[21] is None


@pytest.mark.parametrize("kind", ["tinyint", "int", "bigint"])
def test_whole_numbers(spark, kind):
    top = {"tinyint": 127, "int": 2**31 - 1, "bigint": 10**17}[kind]
    rng = random.Random(4)
    rows = [(i % 3, rng.choice([None, top, -top, rng.randint(-top, top), rng.randint(-9, 9)])) for i in range(900)]
    df = spark.createDataFrame(rows, f"k int, v {kind}")
    got = dict(group_sum(df, ["k"], "v", "s", value_type=AREA).collect())
    assert got == {k: Decimal(sum(v for j, v in rows if j == k and v is not None)) for k in range(3)}


def test_strict_sums_raise_and_lenient_ones_do_not(spark):
    df = spark.createDataFrame([(1, 1e30), (1, 2.5)], "k int, v double")
    assert dict(group_sum(df, ["k"], "v", "s", value_type=AREA).collect()) == {1: Decimal("2.5")}
    with pytest.raises(Exception, match="OUT_OF_RANGE"):
        group_sum(df, ["k"], "v", "s", value_type=AREA, strict=True).collect()


def test_doubles_with_few_decimals_make_no_decimal_objects(spark):
    df = spark.createDataFrame([(1, 2.5)], "k int, v double")
    text = str(exact_sum(F.col("v"), df.schema["v"].dataType, AREA))
    assert "shiftright" in text.lower()
    narrow = exact_sum(F.col("v"), df.schema["v"].dataType, "decimal(12,2)")
    assert "shiftright" not in str(narrow).lower()
    for kind in ("string", "decimal(18,6)", "float"):
        assert "shiftright" not in str(exact_sum(F.col("v"), DataType.fromDDL(kind), AREA)).lower()
