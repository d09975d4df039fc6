"""Typed projection of raw columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql.types import DataType

from dimforge.audit import note_cast
from dimforge.functions._cols import ColumnLike, col


def cast_to(c: ColumnLike, to_type: str | DataType, strict: bool = False) -> Column:
    """``try_cast`` (a value that is none of the type becomes NULL), or the raising ``cast`` if ``strict``."""
    v = col(c)
    return v.cast(to_type) if strict else v.try_cast(to_type)


def typed(c: ColumnLike, to_type: str | DataType, strict: bool = False) -> Column:
    """Cast a raw column to ``to_type`` in a staging projection.

    Spark 4 runs with ANSI casts, so one malformed raw value would fail the
    whole load; by default the staging cast is ``try_cast`` (malformed becomes
    NULL, and is counted where the build is audited).  ``strict=True`` keeps
    the raising ``cast``.
    """
    return note_cast(c, col(c), cast_to(c, to_type, strict))
