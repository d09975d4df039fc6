"""Season and site codes derived from raw operational codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimforge.functions._cols import ColumnLike, col
from dimforge.functions.keys import as_text

# Fixed values of the code rules.
NO_SUFFIX = "-1"          # fallback when neither ERP code nor dash part exists
DEFAULT_SEASON_DIGIT = "1"  # legacy code without a 9th character
ROMAN_THREE = "III"
ROMAN_TWO = "II"


def season_key_current(origin: int, season_id: ColumnLike, erp_code: ColumnLike,
                       period_desc: ColumnLike) -> Column:
    """Season key of the current system.

    origin, season id, then the last character of the first non-null of:
    the ERP code; the two characters starting at the first dash of the
    period description (when it has a dash); ``'-1'``.
    """
    desc = as_text(period_desc)
    dash = F.instr(desc, "-")
    from_dash = F.when(dash > 0, desc.substr(dash, F.lit(2)))
    picked = F.coalesce(as_text(erp_code), from_dash, F.lit(NO_SUFFIX))
    return F.concat(F.lit(str(origin)), as_text(season_id), F.right(picked, F.lit(1)))


def season_key_legacy(season_code: ColumnLike) -> Column:
    """Season key of the legacy system: the first four characters of the
    season code, then its 9th character, or ``'1'`` when it has none."""
    code = col(season_code)
    ninth = F.nullif(F.substring(code, 9, 1), F.lit(""))
    return F.concat(F.substring(code, 1, 4), F.coalesce(ninth, F.lit(DEFAULT_SEASON_DIGIT)))


def farm_code(abbreviation: ColumnLike) -> Column:
    """Two-character farm code: characters 3-4 of the company abbreviation."""
    return F.substring(col(abbreviation), 3, 2)


def site_code(abbreviation: ColumnLike) -> Column:
    """Farm code, ``0``, then the site ordinal: 3 when the abbreviation holds
    ``III``, 2 when it holds ``II``, else 1 (checked in that order)."""
    abv = col(abbreviation)
    ordinal = (F.when(abv.contains(ROMAN_THREE), F.lit("3"))
               .when(abv.contains(ROMAN_TWO), F.lit("2"))
               .otherwise(F.lit("1")))
    return F.concat(farm_code(abv), F.lit("0"), ordinal)
