from churnlens.functions.columns import (
    row_sum, presence_flag, try_int, narrow_bigints, log1p_scaled, day_diff, frac_days,
    to_central, month_of, json_field, strip_spaces, vector_element, verdict, parse_ts,
    strip_zone_suffix,
)
from churnlens.functions.special import lgamma, digamma

__all__ = [
    "row_sum", "presence_flag", "try_int", "narrow_bigints", "log1p_scaled", "day_diff",
    "frac_days", "to_central", "month_of", "json_field", "strip_spaces", "vector_element",
    "verdict", "parse_ts", "strip_zone_suffix", "lgamma", "digamma",
]
