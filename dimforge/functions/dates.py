"""Date parsing for raw date strings and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimforge.audit import note_cast
from dimforge.functions._cols import ColumnLike, col

# The raw layouts of the two systems, written with the pattern
# letters that mean what was intended (day of month, 24-hour clock).
DAY_MONTH_YEAR = "dd/MM/yyyy"
COMPACT_STAMP = "yyyyMMddHHmmss"


def to_date(c: ColumnLike, fmt: str | None = None, strict: bool = False) -> Column:
    """Date of a timestamp, date or string.

    Unparseable text becomes NULL unless ``strict``; a timestamp input
    ignores the format.
    """
    v = col(c)
    parse = F.to_date if strict else F.try_to_date
    return note_cast(c, v, parse(v) if fmt is None else parse(v, fmt))
