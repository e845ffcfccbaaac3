"""Exact global median and median fill (pandas ``s.fillna(s.median())``).

``F.median`` merges a value->count map of every distinct value into one task:
unbounded for a continuous column at scale.  Here a mergeable quantile sketch
(``percentile_approx``) brackets the middle ranks in one pass over the column,
and one more pass counts what lies below the bracket and the values in it: a
bracket holds about ``5 * ERROR`` of the rows, and at most about ``PICKED`` counts reach the
driver.  A larger bracket is sketched again first, so the passes
grow with the logarithm of the rows.  The counts prove the pick.  Where a sketch
does not narrow the range (a few values hold most of a very large bracket) or
were to miss its rank, the value is found over a histogram (``middle``).
There is no approximation in the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.session import staged

BINS = 4096
#: Rank error of a sketch, as a share of the rows, and counts that may reach the driver.
ERROR, PICKED = 1e-4, 1 << 16


def middle(hist: DataFrame) -> float | None:
    """Median of a staged histogram (v, n) without nulls and NaN.

    The middle ranks are found by narrowing a range: each step counts the
    histogram in ``BINS`` equal parts of it and goes on with the parts that
    hold the ranks; ``BINS + 1`` rows reach the driver at most."""
    finite = F.abs("v") < float("inf")
    whole = hist.agg(F.sum("n").alias("n"), F.min(F.when(finite, F.col("v"))).alias("lo"), F.max(F.when(finite, F.col("v"))).alias("hi"),
                     F.sum(F.when(F.col("v") == float("-inf"), F.col("n"))).alias("below")).first()
    if not whole.n:
        return None
    ranks = [(whole.n + 1) // 2, whole.n // 2 + 1]
    below, lo, hi = whole.below or 0, whole.lo, whole.hi
    found: list[float] = []
    for rank in ranks:
        if rank <= (whole.below or 0):
            found.append(float("-inf"))
    if lo is not None:
        part = hist.where(finite)
        while True:
            at = F.floor(F.least((F.col("v") - lo) / F.lit((hi / BINS - lo / BINS) or 1.0), F.lit(BINS - 1.0)))
            # the least value has a part of its own, so every step narrows the range
            bins = (part.groupBy(F.when(F.col("v") == lo, -1).otherwise(at).alias("b"))
                    .agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("b").collect())
            held, at_rank = below, []
            for b in bins:
                at_rank += [(rank, b, held) for rank in ranks if held < rank <= held + b.n]
                held += b.n
            if all(b.lo == b.hi for _, b, _ in at_rank) or not at_rank:
                found += [b.lo for _, b, _ in at_rank]
                break
            below = at_rank[0][2]
            lo, hi = at_rank[0][1].lo, at_rank[-1][1].hi
            part = part.where(F.col("v").between(lo, hi))
            ranks = [rank for rank, _, _ in at_rank]
    found += [float("inf")] * (2 - len(found))
    return (found[0] + found[1]) / 2


def _picked(v: DataFrame) -> float | None:
    """Median of a column (v) without nulls and NaN, by sketches and counts."""
    part, below, ranks, at = v, 0, None, (0.5, 0.5)
    while True:
        ends = F.array(F.lit(max(0.0, at[0] - 2 * ERROR)), F.lit(min(1.0, at[1] + 2 * ERROR)))
        got = part.agg(F.count("v").alias("n"), F.percentile_approx("v", ends, round(1 / ERROR)).alias("q")).first()
        if not got.n:
            return None
        ranks = ranks or [(got.n + 1) // 2, got.n // 2 + 1]
        lo, hi = got.q
        if got.n * 5 * ERROR <= PICKED:
            counts = part.where(F.col("v") <= hi).groupBy(F.when(F.col("v") >= lo, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()
            held = below + sum(r.n for r in counts if r.v is None)
            found = []
            for value, n in sorted((r.v, r.n) for r in counts if r.v is not None):
                found += [value for rank in ranks if held < rank <= held + n]
                held += n
            if len(found) == 2:
                return (found[0] + found[1]) / 2
        else:
            inside = F.col("v").between(lo, hi)
            c = part.agg(F.count_if(F.col("v") < lo).alias("below"), F.count_if(inside).alias("n")).first()
            below += c.below
            if below < ranks[0] and ranks[1] <= below + c.n and c.n < got.n:
                part, at = part.where(inside), tuple((rank - below) / c.n for rank in ranks)
                continue
        return middle(staged(v.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "histogram"))


def exact_median(df: DataFrame, column: str, alias: str = "median") -> DataFrame:
    """One-row DataFrame ``[alias]`` with the exact median of a numeric column.

    Nulls and NaN are ignored; no values give a null median; with infinities
    in the middle it is the mean that floating point gives.
    """
    v = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    return df.sparkSession.range(1).select(F.lit(_picked(v)).cast("double").alias(alias))


def fill_median(df: DataFrame, column: str, population: DataFrame | None = None) -> DataFrame:
    """Fill nulls of ``column`` with the exact median of ``population`` (default ``df``)."""
    pop = df if population is None else population
    value = exact_median(pop, column).first()[0]
    dtype = dict(df.dtypes)[column]
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value).cast(dtype)))
