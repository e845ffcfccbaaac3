"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that
its predecessor kept; all but the last return the columns of ``docs``.  What
a stage returns is written as Parquet to the shared folder and read again as
the next one's documents.  No stage relies on document ids being unique or
present.  Null and empty texts pass every filter and are packed as their end id;
very long texts are worked on whole; of repeated passages the first by document
id (null last), then by row, stays, of near copies and repeated rows the first
row; columns of any name pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.llm.common import table, written
from bankmart.llm.decontaminate import without_leaks
from bankmart.llm.line_dedup import drop_repeated_lines
from bankmart.llm.ngram_join import jaccard_components
from bankmart.llm.queries import held_out, pack_pieces
from bankmart.llm.toxicity import without_toxic

#: SQL can't express the learnt and the approximate stages.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"), train_on=lambda c: ~held_out(c))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of passages go, and documents of which they leave nothing."""
    cut = drop_repeated_lines(docs).where((F.col("n_deleted_") == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("n_deleted_") > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles at 0.8 the first row stays."""
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "near-docs")
    kept = jaccard_components(rows, id_col="_row").where("id = component_id").select(F.col("id").alias("_row"))
    return rows.join(kept, "_row", "left_semi").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return pack_pieces(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
