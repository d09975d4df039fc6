"""Column functions: every one returns a native Spark ``Column`` expression
(no Python UDF), so it runs inside whole-stage code generation."""

from dimforge.functions.casts import cast_to, typed
from dimforge.functions.codes import farm_code, season_key_current, season_key_legacy, site_code
from dimforge.functions.dates import COMPACT_STAMP, DAY_MONTH_YEAR, to_date
from dimforge.functions.keys import as_text, business_key, origin_key, strip_separators
from dimforge.functions.text import tax_id_mask, title_case, trimmed
from dimforge.functions.values import (
    first_available,
    flag_label,
    positive_or_null,
    typed_constant,
    zero_if_null,
)

__all__ = [
    "COMPACT_STAMP", "DAY_MONTH_YEAR", "as_text", "business_key", "cast_to", "farm_code",
    "first_available", "flag_label", "origin_key", "positive_or_null",
    "season_key_current", "season_key_legacy", "site_code", "strip_separators",
    "tax_id_mask", "title_case", "to_date", "trimmed", "typed", "typed_constant",
    "zero_if_null",
]
