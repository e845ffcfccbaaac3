"""Data-profile operators used by the bronze and silver checks.

All are one aggregation pass; several measures on one table fold into one
``agg`` so the table is scanned once.  Group-by profiles are partial
aggregates (map-side combine), so a value that covers a third of the table
costs one row per map task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """``select count(*) as name``."""
    return df.agg(F.count(F.lit(1)).alias(name))


def value_counts(
    df: DataFrame,
    column: str,
    count_name: str = "count",
    where: Column | str | None = None,
    limit: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Frequency of each value of ``column`` (null is a value), most frequent first.

    Ties are broken by the value so a top-``limit`` report is deterministic;
    with ``limit`` Spark plans a ``TakeOrderedAndProject`` (per-task top-k,
    then a merge of k rows per task).
    """
    src = df if where is None else df.where(where)
    out = src.groupBy(column).agg(F.count(F.lit(1)).alias(count_name))
    if ordered or limit is not None:
        out = out.orderBy(F.col(count_name).desc(), F.col(column).asc_nulls_last())
    if limit is not None:
        out = out.limit(limit)
    return out


def frequency_profile(df: DataFrame, columns: Sequence[str], count_name: str = "n_rows") -> DataFrame:
    """Frequency of every value of several columns: ``(column, value, count)``, null a value.

    One scan: each row becomes a (column, value) pair per column, which are
    counted before the shuffle, so that carries a row per value and task."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    long = df.select(*columns).select(F.expr(f"stack({len(columns)}, {pairs}) as (column, value)"))
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias(count_name))


def null_profile(df: DataFrame, columns: Sequence[str], total_name: str = "total_rows") -> DataFrame:
    """Total rows plus the null count of each column, in one pass."""
    aggs = [F.count(F.lit(1)).alias(total_name)]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    return df.agg(*aggs)


def count_where(df: DataFrame, condition: Column | str, name: str) -> DataFrame:
    """Number of rows meeting ``condition``."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return df.agg(F.count_if(cond).alias(name))


def sample_rows(df: DataFrame, n: int, where: Column | str | None = None) -> DataFrame:
    """Spot-check: up to ``n`` rows (``select ... limit n``); the limit is the feature."""
    src = df if where is None else df.where(where)
    return src.limit(n)
