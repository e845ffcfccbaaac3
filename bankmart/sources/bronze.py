"""Bronze: raw CSV feeds read losslessly as text.

* Every column is STRING: a typed CSV read turns a
  bad cell into null silently, and ``cast`` under ANSI mode throws on it.
  Typing is a silver rule (``try_cast`` behind a numeric gate).
* ``read_csv_text`` leaves cells untouched and is what lands in bronze; the
  missing-value spellings of the source pipeline's reader (``NA``, ``N/A``,
  ``null``, ``NaN``, empty, ...) become null in ``bronze_view``, for every
  column.
* ``_arrival`` records the feed order - (file path, split start, position) -
  so the silver keep-first dedupe keeps the first copy *in file order*,
  whatever the partitioning.  ``monotonically_increasing_id`` alone is not
  file order across files; within one split it is the row order, and it is
  the same on a re-run of a lost task.
* Columns are found by the header's names, in any order; a missing column or
  a file whose header differs from the first one's fails the read.
* A row with more or fewer cells than the header is kept, parsed as far as it
  goes, with its raw text in ``_corrupt``.  ``bronze_view`` leaves such rows
  out, so that no half row becomes a silver row; ``corrupt_counts`` counts them.
* Feeds are read split by split (``maxPartitionBytes``), the distributed
  replacement of the source pipeline's 50,000-row chunks, also where quoted
  fields hold line breaks (see ``quoted_lines``).  ``splittable=False`` reads
  whole files with Spark's own reader, for feeds with stray quotes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bankmart import vocab
from bankmart.functions.cleaning import null_tokens
from bankmart.schemas import ARRIVAL, BRONZE_COLUMNS
from bankmart.sources.quoted_lines import records

CORRUPT = "_corrupt"

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',  # RFC 4180 doubled quotes, as written by pandas
    "mode": "PERMISSIVE",
    "encoding": "UTF-8",
    "multiLine": "true",  # quoted newlines parse as in the source reader
    "enforceSchema": "false",  # every file's header must be the first one's
    "columnNameOfCorruptRecord": CORRUPT,
    "columnPruning": "false",  # cells of every row are counted, whatever a query reads
}


def read_csv_text(
    spark: SparkSession,
    paths: str | list[str],
    entity: str,
    options: dict[str, str] | None = None,
    splittable: bool = True,
) -> DataFrame:
    """The raw CSV of ``entity``, untouched: all-STRING columns, ``_arrival``, ``_corrupt``."""
    opts = CSV_OPTIONS | (options or {})
    header = spark.read.options(**opts | {"enforceSchema": "true", "multiLine": "false"}).csv(paths).columns
    missing = [c for c in BRONZE_COLUMNS[entity] if c not in header]
    if missing:
        raise ValueError(f"{entity}: the header lacks {', '.join(missing)}")
    schema = StructType([StructField(c, StringType()) for c in [*header, CORRUPT]])
    if splittable:
        found = records(spark, paths, header, opts.get("sep", opts.get("delimiter", ",")))
        arrival = F.struct("file", "block", "pos")
        cells = F.from_csv("value", F.lit(schema.toDDL()), opts)
        raw = found.select(cells.alias("cells"), arrival.alias(ARRIVAL)).select("cells.*", ARRIVAL)
    else:
        arrival = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                           F.monotonically_increasing_id().alias("pos"))
        raw = spark.read.schema(schema).options(**opts).csv(paths).select("*", arrival.alias(ARRIVAL))
    return raw.select(*BRONZE_COLUMNS[entity], ARRIVAL, CORRUPT)


def bronze_view(text: DataFrame, entity: str, missing_tokens: list[str] | None = None) -> DataFrame:
    """Untouched text with missing-value spellings as null, and ``_arrival``;
    malformed rows stay behind."""
    if CORRUPT in text.columns:
        # Spark's own reader refuses a filter on the corrupt column alone
        text = text.where(F.col(CORRUPT).isNull())
    tokens = vocab.NULL_TOKENS if missing_tokens is None else missing_tokens
    return text.select(*[null_tokens(c, tokens).alias(c) for c in BRONZE_COLUMNS[entity]], ARRIVAL)


def short_arrival(text: DataFrame) -> DataFrame:
    """``_arrival`` with the file's number in the order of all files in place of its path,
    which sorts alike: a path in every row is most of what a dedupe sorts and shuffles.
    The files' names are a scan of one column, so ``text`` is best a written table."""
    names = text.select(F.col(ARRIVAL)["file"].alias("_file")).distinct()
    # a row per file, as the driver holds when it lists them
    numbers = names.withColumn("_number", F.row_number().over(Window.orderBy("_file")))
    found = text.join(F.broadcast(numbers), F.col(ARRIVAL)["file"] == F.col("_file"), "left")
    short = F.struct(F.col("_number").alias("file"), F.col(ARRIVAL)["block"].alias("block"), F.col(ARRIVAL)["pos"].alias("pos"))
    return found.withColumn(ARRIVAL, short).drop("_file", "_number")


def corrupt_counts(text: dict[str, DataFrame]) -> DataFrame:
    """Rows, and rows with more or fewer cells than their header, per feed."""
    out = None
    for entity, df in text.items():
        # Spark refuses to read the corrupt column alone, so a cell goes with it
        raw = F.concat(CORRUPT, F.coalesce(df.columns[0], F.lit("")))
        one = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count(raw).alias("corrupt_rows"))
        one = one.select(F.lit(entity).alias("entity"), "total_rows", "corrupt_rows")
        out = one if out is None else out.unionByName(one)
    return out


def read_bronze(
    spark: SparkSession,
    paths: str | list[str],
    entity: str,
    options: dict[str, str] | None = None,
    missing_tokens: list[str] | None = None,
    splittable: bool = True,
) -> DataFrame:
    """Read a raw feed: all-STRING, missing-value spellings as null, ``_arrival``."""
    return bronze_view(read_csv_text(spark, paths, entity, options, splittable), entity, missing_tokens)
