"""Row filters with the source pipeline's null semantics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from bankmart.functions.cleaning import not_in_keep_null


def reject_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Drop rows whose ``column`` is in ``values``; null values are kept.

    pandas ``df[~df[c].isin(values)]`` keeps nulls while SQL ``NOT IN`` drops
    them.  The predicate is row-local and is pushed into the scan stage.
    """
    return df.where(not_in_keep_null(column, values))


def drop_missing(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``columns`` (pandas ``dropna(subset=...)``)."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    return df.dropna(subset=cols)
