"""Keep-first deduplication (pandas ``drop_duplicates(subset=keys)``).

pandas keeps the first row of each key in file order and treats null keys
as one key.  ``DataFrame.dropDuplicates`` keeps an arbitrary row, so we rank
rows of a key by their arrival order and keep rank 1:

    row_number() OVER (PARTITION BY keys ORDER BY arrival) = 1

Spark plans the ``= 1`` filter as a *partial* ``WindowGroupLimit`` before the
shuffle and a final one after it, so every map task already reduces a key to
one row: a hot key (even a third of the table, or the null key) reaches its
reducer as at most one row per map task, never as a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankmart.schemas import ARRIVAL

_RANK = "__keep_first_rank"


def dedupe_keep_first(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Column | Sequence[str | Column] = ARRIVAL,
) -> DataFrame:
    """One row per key: the first by ``order`` (file arrival by default)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order])
    return df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1).drop(_RANK)
