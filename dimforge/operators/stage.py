"""Staging: filter raw rows, project them typed and renamed, drop duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.audit import observed
from dimforge.functions._cols import ColumnLike, col
from dimforge.operators.joins import note_superset


def stage(df: DataFrame, columns: Sequence[ColumnLike], where: Column | None = None,
          distinct: bool = True) -> DataFrame:
    """``SELECT [DISTINCT] columns FROM df [WHERE where]``.

    The filter is applied to the raw columns before the projection, so a
    predicate on an untouched raw column reaches the Parquet scan.  Pass
    ``distinct=False`` when a later DISTINCT over the same rows makes this one
    redundant (joins and projections only in between): it saves a shuffle of
    the staged table and gives the same result.  In an audited build the
    values that the projection makes NULL are counted, in the rows that pass
    the filter.
    """
    if where is not None:
        df = df.where(where)
    out = observed(df, [col(c) for c in columns])
    return note_superset(out.distinct(), out) if distinct else out


def starts_with(c: ColumnLike, prefix: str) -> Column:
    """``LEFT(c, n) = prefix`` written so that it is pushed to the scan."""
    return col(c).startswith(prefix)


def contains(c: ColumnLike, fragment: str) -> Column:
    """``c LIKE '%fragment%'`` (pushed to the scan as StringContains)."""
    return col(c).contains(fragment)


def in_list(c: ColumnLike, values: Sequence) -> Column:
    return col(c).isin(list(values))


def all_equal(**equals) -> Column:
    """Conjunction of ``column = value`` tests."""
    cond = F.lit(True)
    for name, value in equals.items():
        cond = cond & (F.col(name) == F.lit(value))
    return cond


def origin_cutover(df: DataFrame, column: ColumnLike, last: int) -> DataFrame:
    """Keep the rows of an origin up to its last period (``column <= last``)."""
    return df.where(col(column) <= F.lit(last))
