"""Column-level functions: cleaning rules and exact gold arithmetic."""

from bankmart.functions.cleaning import (
    is_missing,
    not_in_keep_null,
    null_if_greater,
    null_if_negative,
    null_outside,
    null_tokens,
    round_half_even,
    standardise,
    strip_ws,
    to_bool,
    to_date,
    to_number,
)
from bankmart.functions.numeric import (
    div_half_up,
    exact_units,
    mean_round,
    money_sum,
    not_finite,
    ratio_pct,
    round_half_up,
    rest_units,
    rounded_mean,
    rounded_total,
)

__all__ = [
    "div_half_up", "exact_units", "is_missing", "mean_round", "money_sum", "not_finite", "not_in_keep_null",
    "null_if_greater", "null_if_negative", "null_outside", "null_tokens",
    "ratio_pct", "round_half_even", "round_half_up", "rest_units", "rounded_mean", "rounded_total", "standardise",
    "strip_ws", "to_bool", "to_date", "to_number",
]
