"""Name clean-up and the company tax-id mask."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimforge.functions._cols import ColumnLike, col

# Fixed values of the tax-id layout: 14 digits shown as 00.000.000/0000-00.
TAX_ID_DIGITS = 14
TAX_ID_PATTERN = r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$"
TAX_ID_LAYOUT = "$1.$2.$3/$4-$5"
TAX_ID_REDACTED = "$1.***.***/$4-$5"


def title_case(c: ColumnLike) -> Column:
    """First letter of each blank-separated word upper case, the rest lower."""
    return F.initcap(col(c))


def trimmed(c: ColumnLike) -> Column:
    return F.trim(col(c))


def tax_id_mask(c: ColumnLike, redact: bool = False) -> Column:
    """Company tax id as ``00.000.000/0000-00``.

    Non-digits are dropped and the digits left-padded to 14.  A value with
    more than 14 digits is returned as its digits (never cut); a value with
    no digit becomes NULL.  ``redact=True`` hides the middle six digits.
    """
    digits = F.regexp_replace(col(c), r"[^0-9]", "")
    n = F.length(digits)
    padded = F.lpad(digits, TAX_ID_DIGITS, "0")
    layout = TAX_ID_REDACTED if redact else TAX_ID_LAYOUT
    return (F.when(n == 0, F.lit(None).cast("string"))
            .when(n <= TAX_ID_DIGITS, F.regexp_replace(padded, TAX_ID_PATTERN, layout))
            .otherwise(digits))
