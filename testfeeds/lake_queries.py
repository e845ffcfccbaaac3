"""Queries that take the feeds through raw CSV files and a lake in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.plans import incremental, medallion
from bankmart.schemas import BRONZE_COLUMNS, ENTITIES
from bankmart.session import ensure_checkpoint_dir
from bankmart.sources.bronze import CORRUPT, corrupt_counts, read_bronze, read_csv_text
from bankmart.sources.lake import Lake
from bankmart.sources.snapshots import Folder, freed, narrow_splits
from testfeeds.tpch_feed import raw_feed, table_of

#: Rows of the source table to a raw file: some 40 MB of text.
FILE_ROWS = 250_000
#: Files that arrive one after the other in ``grown_*``.
INCREMENTS = 3


def new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex}")


def write_raw(spark: SparkSession, sf_dir: str, entity: str, lake: Lake, least: int = 1, compression: str = "none") -> str:
    """The untouched feed as CSV files in arrival order, malformed rows between; the
    columns stand in the reverse of the usual order, as the reader goes by name.
    The files, ``least`` or more, grow in number with the table and not in size."""
    path = lake.path("raw", entity)
    names = list(reversed(BRONZE_COLUMNS[entity]))
    files = max(least, -(-table_of(spark, sf_dir, entity).count() // FILE_ROWS))
    ordered = raw_feed(spark, sf_dir, entity, damaged=True, parts=files)

    def line(*cells) -> F.Column:
        return F.to_csv(F.struct(*cells), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})

    damaged = F.when(F.col("_cut"), line(*names[:3])).otherwise(line(*names, F.lit("surplus").alias("_surplus")))
    lines = F.when(F.col("_damaged"), F.array(damaged, line(*names))).otherwise(F.array(line(*names)))
    # a partition is a file, and starts with the header
    first = F.monotonically_increasing_id() % (1 << 33) == 0
    lines = F.when(first, F.concat(F.array(F.lit(",".join(names))), lines)).otherwise(lines)
    with freed(spark), narrow_splits(spark):
        ordered.select(F.explode(lines).alias("value")).write.option("lineSep", "\n").option("compression", compression).text(path)
    return path


def _csv_bronze(entity: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = write_raw(spark, sf_dir, entity, new_lake(spark))
        return read_bronze(spark, path, entity).select(*BRONZE_COLUMNS[entity])

    return run


def _landed(spark: SparkSession, sf_dir: str, entities: tuple[str, ...]) -> Lake:
    """A lake with silver built from raw CSV by way of untouched bronze."""
    lake = new_lake(spark)
    for e in entities:
        write_raw(spark, sf_dir, e, lake, compression="lz4")
    medallion.land_bronze(lake, entities)
    medallion.build_silver(lake, entities=entities)
    return lake


def _lake_silver(entity: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _landed(spark, sf_dir, (entity,)).table("silver", entity)


def csv_corrupt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and malformed rows of every feed, as its reader counts them."""
    lake = new_lake(spark)
    return corrupt_counts({e: read_csv_text(spark, write_raw(spark, sf_dir, e, lake), e) for e in ENTITIES})


def lake_quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and malformed rows as the landing counted them, beside the rows found in bronze."""
    lake = new_lake(spark)
    for e in ENTITIES:
        write_raw(spark, sf_dir, e, lake)
    landed = medallion.land_bronze(lake)
    out = None
    for e in ENTITIES:
        one = lake.table("bronze", e).groupBy(medallion.MALFORMED).agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum(F.when(~F.col(medallion.MALFORMED), F.col("n"))), F.lit(0)).alias("good_rows"),
            F.coalesce(F.sum(F.when(F.col(medallion.MALFORMED), F.col("n"))), F.lit(0)).alias("malformed_rows"))
        one = one.select(F.lit(e).alias("entity"), F.lit(landed[e]).cast("long").alias("landed"),
                         F.lit(medallion.quarantined(lake, e)).cast("long").alias("set_aside"), "good_rows", "malformed_rows")
        out = one if out is None else out.unionByName(one)
    return out


def lake_quarantine_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw text of the malformed loan rows."""
    lake = new_lake(spark)
    write_raw(spark, sf_dir, "loans", lake)
    medallion.land_bronze(lake, ("loans",))
    return medallion.quarantine(lake, "loans").select(F.replace(CORRUPT, F.lit("\n"), F.lit(" ")).alias("raw_text"))


def lake_after_broken_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver loans of a lake in which a second write broke off half way."""
    lake = _landed(spark, sf_dir, ("loans",))
    silver = lake.table("silver", "loans")
    last = silver.agg(F.max("loan_id")).first()[0]
    breaking = F.when(F.col("loan_id") == last, F.raise_error(F.lit("the write breaks off"))).otherwise(F.col("loan_id"))
    try:
        lake.write(silver.withColumn("loan_id", breaking.cast("string")), "silver", "loans")
    except Exception as broken:
        if "the write breaks off" not in str(broken):
            raise
    else:
        raise AssertionError("the second write was to break off")
    return lake.table("silver", "loans")


def lake_earlier_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of both versions of the loan table: all loans, then the defaulted ones."""
    lake = _landed(spark, sf_dir, ("loans",))
    lake.write(lake.table("silver", "loans").where("default_flag"), "silver", "loans")
    parts = [lake.table("silver", "loans", v).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(v).cast("long").alias("version"), "n_rows") for v in (1, 2)]
    return parts[0].unionByName(parts[1])


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans by catalog name over untouched bronze and over silver: rows per status."""
    lake = _landed(spark, sf_dir, ("loans",))
    of = uuid.uuid4().hex
    raw, = lake.register_catalog("bronze", ["loans"], f"bronze_{of}")
    silver, = lake.register_catalog("silver", ["loans"], f"silver_{of}")
    return spark.sql(f"""
        select 'bronze' as layer, nullif(trim(loan_status), '') as loan_status, count(*) as n_rows from {raw} where not _malformed group by all
        union all select 'silver', loan_status, count(*) from {silver} group by all""")


def lake_rows_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the silver writes report, beside the rows found in the registered views."""
    lake = new_lake(spark)
    for e in ENTITIES:
        write_raw(spark, sf_dir, e, lake, compression="lz4")
    medallion.land_bronze(lake)
    reported = medallion.build_silver(lake)
    views = lake.register("silver", list(ENTITIES))
    parts = [f"select '{e}' as entity, {reported[e]}L as rows_written, count(*) as rows_found from {v}"
             for e, v in zip(ENTITIES, views, strict=True)]
    return spark.sql(" union all ".join(parts))


def lake_branch_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written branch mart of a layered run, read from the lake."""
    lake = _landed(spark, sf_dir, ENTITIES)
    medallion.build_gold(lake)
    return lake.table("gold", "branch_performance")


def lake_export_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV export of the written loan mart, read back."""
    lake = _landed(spark, sf_dir, ("loans",))
    mart = medallion.MART_TABLES["loan_performance"](dict(loans=lake.table("silver", "loans")))
    lake.write(mart, "gold", "loan_performance")
    written = lake.table("gold", "loan_performance")
    path = lake.export_csv(written, "loan_performance")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return back.select(*[F.col(f.name).cast(f.dataType) for f in written.schema])


def deliveries(names: list[str]) -> list[list[str]]:
    """The files in their order, as a first delivery and the increments after it."""
    ends = [len(names) * n // INCREMENTS for n in range(INCREMENTS + 1)]
    return [names[lo:hi] for lo, hi in zip(ends[:-1], ends[1:], strict=True) if hi > lo]


def _grown(spark: SparkSession, sf_dir: str, entities: tuple[str, ...]) -> Lake:
    """A lake that took each feed as a first delivery and two increments, the marts
    followed after the first delivery and after the last."""
    lake = new_lake(spark)
    follow = {"loans": incremental.loan_performance, "customers": incremental.customer_segments, "transactions": incremental.follow_branch_customers}
    for e in entities:
        path = write_raw(spark, sf_dir, e, lake, INCREMENTS, "gzip")
        names = [f for f in Folder(spark, path).names("") if f.startswith("part-")]
        for n, delivered in enumerate(deliveries(names)):
            incremental.take(lake, e, [f"{path}/{name}" for name in delivered])
            if n == 0 and e in follow:
                follow[e](lake)
    return lake


def _grown_silver(entity: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: incremental.current(_grown(spark, sf_dir, (entity,)), entity)


def grown_loan_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.loan_performance(_grown(spark, sf_dir, ("loans",)))


def grown_customer_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.customer_segments(_grown(spark, sf_dir, ("customers",)))


def grown_branch_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.branch_performance(_grown(spark, sf_dir, ("branches", "transactions")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{f"csv_bronze_{e}": _csv_bronze(e) for e in ENTITIES},
    **{f"lake_silver_{e}": _lake_silver(e) for e in ENTITIES},
    **{f"grown_silver_{e}": _grown_silver(e) for e in ENTITIES},
    "grown_loan_mart": grown_loan_mart,
    "grown_customer_mart": grown_customer_mart,
    "grown_branch_mart": grown_branch_mart,
    "csv_corrupt_rows": csv_corrupt_rows,
    "lake_quarantine_counts": lake_quarantine_counts,
    "lake_quarantine_loans": lake_quarantine_loans,
    "lake_after_broken_write": lake_after_broken_write,
    "lake_earlier_version": lake_earlier_version,
    "catalog_tables": catalog_tables,
    "lake_rows_written": lake_rows_written,
    "lake_branch_mart": lake_branch_mart,
    "lake_export_loans": lake_export_loans,
}
