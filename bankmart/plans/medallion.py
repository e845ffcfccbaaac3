"""Layer-by-layer runs over a lake: raw CSV -> bronze -> silver -> gold.

Each layer is written as Parquet tables and read back by the next one, so
every layer is a lineage cut: a lost executor only re-runs work of the
layer being built, and each layer can be re-run on its own.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.plans import analytics, gold
from bankmart.plans.silver import SILVER_JOBS
from bankmart.schemas import ENTITIES
from bankmart.sources.bronze import CORRUPT, bronze_view, read_csv_text, short_arrival
from bankmart.sources.lake import Lake

MART_TABLES = {
    "branch_performance": lambda s: gold.branch_performance(s["transactions"], s["branches"]),
    "customer_segments": lambda s: gold.customer_segments(s["customers"]),
    "loan_performance": lambda s: gold.loan_performance(s["loans"]),
}


MALFORMED = "_malformed"


def land_bronze(lake: Lake, entities: Iterable[str] = ENTITIES) -> dict[str, int]:
    """``raw/<entity>`` CSV files -> ``bronze/<entity>`` Parquet, untouched; good rows landed.

    All cells stay the text they were, missing-value spellings included;
    ``_arrival`` (file, split, position) keeps the file order for the silver
    dedupe.  One job writes good rows and malformed ones to partitions of their
    own and counts both; malformed rows keep their raw text in ``_corrupt``.
    """
    landed = {}
    for e in entities:
        text = read_csv_text(lake.spark, lake.path("raw", e), e)
        text = text.withColumn(MALFORMED, F.col(CORRUPT).isNotNull())
        rows = lake.write(text, "bronze", e, [MALFORMED], {"malformed": F.count_if(MALFORMED)})
        landed[e] = rows - quarantined(lake, e)
    return landed


def quarantined(lake: Lake, entity: str) -> int:
    """Malformed rows that the last landing set aside."""
    return lake.version("bronze", entity).counts["malformed"]


def quarantine(lake: Lake, entity: str) -> DataFrame:
    """The malformed rows of ``bronze/<entity>``: cells as far as they go, raw text."""
    return lake.table("bronze", entity).where(F.col(MALFORMED)).drop(MALFORMED)


def bronze_rows(lake: Lake, entity: str) -> DataFrame:
    """The good rows of ``bronze/<entity>`` with missing-value spellings as null."""
    return bronze_view(short_arrival(lake.table("bronze", entity).where(~F.col(MALFORMED)).drop(CORRUPT)), entity)


def build_silver(lake: Lake, bronze: dict[str, DataFrame] | None = None,
                 entities: Iterable[str] = ENTITIES) -> dict[str, int]:
    """Silver jobs over the bronze tables (or the given feeds); rows written."""
    counts = {}
    for e in entities:
        src = bronze[e] if bronze is not None else bronze_rows(lake, e)
        counts[e] = lake.write(SILVER_JOBS[e](src), "silver", e)
    return counts


def silver_tables(lake: Lake) -> dict[str, DataFrame]:
    return {e: lake.table("silver", e) for e in ENTITIES}


def build_gold(lake: Lake) -> dict[str, int]:
    """The three marts, from silver Parquet; rows written."""
    s = silver_tables(lake)
    return {name: lake.write(build(s), "gold", name) for name, build in MART_TABLES.items()}


def business_queries(lake: Lake) -> dict[str, DataFrame]:
    """The six business queries over the written silver tables (lazy)."""
    s = silver_tables(lake)
    return {name: q(s) for name, q in analytics.QUERIES.items()}


def export_marts(lake: Lake) -> dict[str, str]:
    """Header CSV exports of the marts for dashboards, a file per partition."""
    return {name: lake.export_csv(lake.table("gold", name), name) for name in MART_TABLES}
