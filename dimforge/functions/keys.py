"""Surrogate and business keys built by concatenation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimforge.functions._cols import ColumnLike, col


def as_text(c: ColumnLike) -> Column:
    """String form of a value as a key part (numbers as their decimal digits)."""
    return col(c).cast("string")


def origin_key(origin: ColumnLike | int, *parts: ColumnLike) -> Column:
    """Origin id followed by the local id(s), without separator.

    NULL when any part is NULL (plain ``concat``).  Keys of different arity
    can collide (``2000|1|23`` equals ``2000|12|3``); the natural columns
    (``ID_DOMAIN``, ``ID_ORIGEM_DB``) stay the safe join key.
    """
    head = F.lit(str(origin)) if isinstance(origin, int) else as_text(origin)
    return F.concat(head, *(as_text(p) for p in parts))


def business_key(*parts: ColumnLike) -> Column:
    """Many-part key: every part as text, concatenated, NULL-propagating."""
    return F.concat(*(as_text(p) for p in parts))


def strip_separators(c: ColumnLike, separators: str = "/-") -> Column:
    """Remove every separator character (season codes such as ``2019/20-2``)."""
    return F.translate(col(c), separators, "")
