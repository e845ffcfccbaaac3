"""DataFrame -> DataFrame operators (use with ``df.transform``)."""

from bankmart.operators.dedupe import dedupe_keep_first
from bankmart.operators.filters import drop_missing, reject_values
from bankmart.operators.impute import exact_median, fill_median
from bankmart.operators.profile import (
    count_where,
    frequency_profile,
    null_profile,
    row_count,
    sample_rows,
    value_counts,
)

__all__ = [
    "count_where", "dedupe_keep_first", "drop_missing", "exact_median", "fill_median", "frequency_profile",
    "null_profile", "reject_values", "row_count", "sample_rows", "value_counts",
]
