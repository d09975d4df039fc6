"""Grouped sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, IntegralType

from dimforge.audit import watched
from dimforge.functions._cols import ColumnLike, col
from dimforge.functions.casts import cast_to

# A value of up to so many decimals and bits is summed as two long parts.
_DECIMALS = 4
_BITS, _LOW_BITS = 40, 20
_SCALED = "__scaled"


def group_sum(df: DataFrame, keys: Sequence[str], value: ColumnLike, alias: str,
              to_type: str | None = None, value_type: str | None = None, strict: bool = False) -> DataFrame:
    """``SELECT keys, CAST(SUM(value) AS to_type) AS alias GROUP BY keys``.

    With ``value_type``, a decimal, each value is cast before the sum: a
    decimal sum is exact, so it does not depend on the order of the tasks, and
    malformed text counts as NULL (or raises when ``strict``).  Numbers are
    summed in longs where that gives the same sum (:func:`exact_sum`).  Spark
    aggregates partially on the map side, so a hot group is reduced to one row
    per task before the shuffle.
    """
    if not value_type:
        total = F.sum(col(value))
    else:
        df = watched(df, value, col(value), cast_to(value, value_type, strict))
        kind = df.select(col(value)).schema[0].dataType
        scaled = in_longs(col(value), kind, value_type)
        # a column of its own, so that it is computed once for its three sums
        df = df if scaled is None else df.withColumn(_SCALED, scaled)
        total = exact_sum(col(value), kind, value_type, strict, None if scaled is None else F.col(_SCALED))
    if to_type:
        total = total.cast(to_type)
    return df.groupBy(*keys).agg(total.alias(alias))


def _decimals(kind: DataType) -> int | None:
    """Decimals of a value of this type that is a long once scaled; None if there are no such values."""
    return 0 if isinstance(kind, IntegralType) else _DECIMALS if isinstance(kind, DoubleType) else None


def in_longs(value: Column, kind: DataType, value_type: str) -> Column | None:
    """A value times ten to the power of its type's decimals, if that is whole
    and of up to 40 bits, else NULL; None if there are none of this type."""
    wide, decimals = DataType.fromDDL(value_type), _decimals(kind)
    if decimals is None or not isinstance(wide, DecimalType) or wide.scale < decimals or wide.precision - wide.scale < 13:
        return None
    if not decimals:
        return F.when(F.abs(value.cast("double")) < float(1 << _BITS), value.cast("bigint"))
    shifted = F.rint(value * F.lit(10.0 ** decimals))
    # a double equal to so short a decimal prints as it, so the cast gives that decimal too
    whole = (F.abs(shifted) < float(1 << _BITS)) & (shifted / F.lit(10.0 ** decimals) == value)
    return F.when(whole, shifted.try_cast("bigint"))


def exact_sum(value: Column, kind: DataType, value_type: str, strict: bool = False, scaled: Column | None = None) -> Column:
    """The sum of ``CAST(value AS value_type)``, a decimal type, of a column of type ``kind``.

    Decimals of more than 18 digits, which such a sum needs, are objects, one
    for each row.  A whole number, or a double with up to four decimals, is a
    long once scaled; its high and low bits are summed apart as longs, which
    no number of rows up to 2^43 overflows, and put together once a group.
    The other values (more decimals, very large ones, not a number) and the
    other types are cast and summed as decimals.
    """
    wide, decimals = DataType.fromDDL(value_type), _decimals(kind)
    scaled = in_longs(value, kind, value_type) if scaled is None else scaled
    if scaled is None:
        return F.sum(cast_to(value, value_type, strict))
    high = F.sum(F.shiftright(scaled, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(scaled.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(20,0)")
    # one digit less than the result, so that the sum of both terms keeps its scale
    digits, result = f"decimal(37,{wide.scale})", f"decimal({min(38, wide.precision + 10)},{wide.scale})"
    longs = high * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low
    if decimals:
        longs = longs * F.lit(f"0.{'0' * (decimals - 1)}1").cast(f"decimal({decimals + 1},{decimals})")
    rest = F.sum(F.when(scaled.isNull(), cast_to(value, value_type, strict)))
    # no value of a kind is no term; no value at all is NULL, as in any sum
    longs, rest = longs.cast(digits), rest.cast(digits)
    return F.when(longs.isNull(), rest).when(rest.isNull(), longs).otherwise(longs + rest).cast(result)
