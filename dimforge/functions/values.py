"""Conditional values: thresholds, labels, fallbacks and typed constants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimforge.functions._cols import ColumnLike, col
from dimforge.functions.casts import cast_to, typed


def positive_or_null(c: ColumnLike, to_type: str = "int", strict: bool = False) -> Column:
    """The value as ``to_type`` when it is greater than zero, else NULL.

    The test compares numbers, also for a text column; malformed text is
    NULL, or raises when ``strict``.
    """
    return F.when(cast_to(c, "double", strict) > 0, typed(c, to_type, strict))


def flag_label(c: ColumnLike, true_value, yes: str, no: str) -> Column:
    """``yes`` when the flag equals ``true_value``; ``no`` otherwise, NULL included."""
    return F.when(col(c) == F.lit(true_value), F.lit(yes)).otherwise(F.lit(no))


def first_available(*cols: ColumnLike) -> Column:
    """First non-null value (item value, else its group's value, ...)."""
    return F.coalesce(*(col(c) for c in cols))


def zero_if_null(c: ColumnLike) -> Column:
    return F.coalesce(col(c), F.lit(0))


def typed_constant(value, to_type: str) -> Column:
    """A placeholder literal (or typed NULL) in the target type."""
    return F.lit(value).cast(to_type)
