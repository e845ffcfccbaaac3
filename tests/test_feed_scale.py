"""Raw files, landings and dedupes whose tasks stay small as the tables grow."""

from __future__ import annotations

import os

from conftest import rows

from pyspark.sql import functions as F

from bankmart.operators.dedupe import dedupe_keep_first
from bankmart.schemas import ARRIVAL, BRONZE_COLUMNS
from bankmart.sources.bronze import read_bronze, short_arrival
from bankmart.sources.lake import Lake
from bankmart.sources.snapshots import WRITERS
from testfeeds import lake_queries
from testfeeds.tpch_feed import feeds


def orders(spark, folder: str, n: int) -> str:
    spark.range(n).selectExpr(
        "id * 7 % 5000 as o_orderkey", "id % 90 as o_custkey", "if(id % 2 = 0, 'F', 'O') as o_orderstatus", "1000.5 + id as o_totalprice",
        "timestamp '2020-01-01' as o_orderdate", "if(id % 4 = 0, '1-URGENT', '5-LOW') as o_orderpriority").write.parquet(f"{folder}/orders.parquet")
    return folder


def shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.length()))


def test_raw_files_grow_in_number_with_the_table(spark, scratch, monkeypatch):
    monkeypatch.setattr(lake_queries, "FILE_ROWS", 100)
    sf = orders(spark, os.path.join(scratch, "sf"), 2000)
    path = lake_queries.write_raw(spark, sf, "loans", Lake(spark, os.path.join(scratch, "lake")), lake_queries.INCREMENTS)
    per_file = [r.n for r in spark.read.text(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count("*").alias("n")).collect()]
    assert len(per_file) >= 15 and max(per_file) < 500
    names = BRONZE_COLUMNS["loans"]
    read = read_bronze(spark, path, "loans")
    assert rows(read, *names) == rows(feeds(spark, sf)["loans"], *names)


def test_deliveries_hold_all_files_in_order():
    for n in (0, 1, 2, 3, 4, 100):
        names = [f"part-{i:05d}" for i in range(n)]
        found = lake_queries.deliveries(names)
        assert [x for d in found for x in d] == names and len(found) == min(n, 3)


def test_few_partitions_are_written_without_a_sort(spark, scratch):
    from bankmart.sources.snapshots import MOST_WRITERS, writers

    df = spark.range(3000).selectExpr("id", "id % 20 as part")
    with writers(spark, MOST_WRITERS):
        assert spark.conf.get(WRITERS) == str(MOST_WRITERS)
    lake, before = Lake(spark, scratch), spark.conf.get(WRITERS, None)
    assert lake.write(df, "bronze", "t", ["part"]) == 3000  # more than are kept open
    found = lake.table("bronze", "t")
    assert (found.agg(F.sum("id")).first()[0], found.select("part").distinct().count()) == (2999 * 1500, 20)
    assert spark.conf.get(WRITERS, None) == before


def test_a_write_frees_its_shuffle_and_puts_settings_back(spark, scratch):
    from bankmart.sources.snapshots import FREED, MOST_SPLIT, SPLIT, narrow_splits

    before = spark.conf.get(FREED, None), spark.conf.get(SPLIT, None)
    with narrow_splits(spark):
        assert int(spark.conf.get(SPLIT)) == MOST_SPLIT
    spark.conf.set(SPLIT, "1m")
    with narrow_splits(spark):
        assert int(spark.conf.get(SPLIT)) == 1 << 20
    spark.conf.unset(SPLIT)
    held = shuffle_files(spark)
    df = spark.range(3000).selectExpr("id", "id % 20 as part").repartition(7, "part")
    assert Lake(spark, scratch).write(df, "bronze", "t") == 3000
    assert shuffle_files(spark) <= held
    assert (spark.conf.get(FREED, None), spark.conf.get(SPLIT, None)) == before


def test_short_arrival_sorts_like_the_path(spark):
    df = spark.range(300).selectExpr("id % 40 as k", "id", "struct(concat('file:///long/', id * 7 % 12) as file, id % 3 as block, id as pos) as _arrival")
    df = df.unionByName(spark.sql("select 1L as k, -1L as id, struct(cast(null as string) as file, 0L as block, 0L as pos) as _arrival"))
    short = short_arrival(df)
    assert dict(short.select(f"{ARRIVAL}.file").dtypes) == {"file": "int"}
    assert rows(dedupe_keep_first(short, "k").select("k", "id")) == rows(dedupe_keep_first(df, "k").select("k", "id"))
