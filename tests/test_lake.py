"""CSV source, lake sinks and layered runs; results do not depend on partitioning."""

from __future__ import annotations

import os

import pytest
from conftest import rows, sf_dir, write_csv

from pyspark.sql import functions as F

from bankmart.plans import gold
from bankmart.plans.silver import SILVER_JOBS, silver_transactions
from bankmart.schemas import ARRIVAL, BRONZE_COLUMNS, silver_columns
from bankmart.sources.bronze import corrupt_counts, read_bronze, read_csv_text
from bankmart.sources.lake import Lake
from testfeeds.tpch_feed import feed, feeds


def _export_feed_csv(spark, entity, folder, files):
    """Write a derived feed as raw CSV files in arrival order (one per part)."""
    df = feed(spark, sf_dir("0.001"), entity).orderBy(ARRIVAL).drop(ARRIVAL)
    data = [[r[c] for c in BRONZE_COLUMNS[entity]] for r in df.collect()]
    step = (len(data) + files - 1) // files
    for i in range(files):
        path = write_csv(folder, f"part-{i:03d}.csv", BRONZE_COLUMNS[entity], data[i * step:(i + 1) * step])
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))  # landed in name order
    return folder


def test_columns_are_found_by_name(spark, scratch):
    path = os.path.join(scratch, "loans")
    names = list(reversed(BRONZE_COLUMNS["loans"]))
    write_csv(path, "a.csv", [*names, "extra"], [[f"{c}-1" for c in names] + ["x"]])
    row = read_bronze(spark, path, "loans").first()
    assert all(row[c] == f"{c}-1" for c in names)
    write_csv(path, "b.csv", BRONZE_COLUMNS["loans"], [["v"] * len(names)])
    with pytest.raises(Exception, match="(?i)header"):  # another order in another file
        read_bronze(spark, path, "loans").collect()
    lacking = os.path.join(scratch, "lacking")
    write_csv(lacking, "a.csv", names[1:], [["v"] * (len(names) - 1)])
    with pytest.raises(ValueError, match=names[0]):
        read_bronze(spark, lacking, "loans")


def test_malformed_rows_are_kept_and_counted(spark, scratch):
    path = os.path.join(scratch, "loans")
    names = BRONZE_COLUMNS["loans"]
    good = [f"g{i}" for i in range(len(names))]
    write_csv(path, "a.csv", names, [good, [*good, "extra cell"], good[:-3], ["quoted\nnewline", *good[1:]], ["NA", *good[1:]]])
    text = read_csv_text(spark, path, "loans")
    counts = corrupt_counts({"loans": text}).first()
    assert (counts.total_rows, counts.corrupt_rows) == (5, 2)
    assert text.where(f"{names[0]} = 'NA'").count() == 1  # untouched
    assert text.where(f"{names[0]} = 'quoted\\nnewline'").count() == 1
    view = read_bronze(spark, path, "loans")
    assert view.count() == 3 and view.where(f"{names[0]} is null").count() == 1  # half rows stay behind
    whole = read_csv_text(spark, path, "loans", splittable=False)
    assert corrupt_counts({"loans": whole}).first().corrupt_rows == 2


def test_partition_independence(spark, scratch):
    raw = _export_feed_csv(spark, "transactions", os.path.join(scratch, "raw"), files=4)
    base = rows(silver_transactions(read_bronze(spark, raw, "transactions")))
    for n in (1, 3):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(4096 * n))
        try:  # splittable read: many splits per file, arrival order still holds
            split = read_bronze(spark, raw, "transactions", splittable=True)
            assert split.rdd.getNumPartitions() > 4
            assert rows(silver_transactions(split)) == base
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_broken_write_loses_nothing(spark, scratch):
    lake = Lake(spark, scratch)
    assert lake.write(spark.range(10), "silver", "t") == 10
    with pytest.raises(Exception, match="half way"):
        lake.write(spark.range(20).selectExpr("if(id = 19, raise_error('half way'), id) as id"), "silver", "t")
    assert lake.table("silver", "t").count() == 10
    assert lake.write(spark.range(30), "silver", "t", counts={"even": F.count_if(F.col("id") % 2 == 0)}) == 30
    assert lake.version("silver", "t").counts == {"even": 15}
    assert (lake.table("silver", "t", 1).count(), lake.table("silver", "t").count()) == (10, 30)
    gone = lake.snapshots("silver", "t").vacuum()
    assert len(gone) == 2  # the first version, and what the broken write left
    assert lake.table("silver", "t").count() == 30
    with pytest.raises(FileNotFoundError):
        lake.table("silver", "t", 1)
    assert lake.write(spark.range(0), "silver", "t") == 0 and lake.table("silver", "t").count() == 0


def test_two_writers_of_one_version_collide(spark, scratch):
    table = Lake(spark, scratch).snapshots("gold", "t")
    table.write(spark.range(1))
    late = Lake(spark, scratch).snapshots("gold", "t")
    known = table.numbers()
    late.numbers = lambda: known  # it looked before the other one was done
    table.write(spark.range(2))
    with pytest.raises(FileExistsError):
        late.write(spark.range(3))
    assert table.read().count() == 2


def test_landing_sets_malformed_rows_aside(spark, scratch):
    from bankmart.plans import medallion

    lake = Lake(spark, scratch)
    names = BRONZE_COLUMNS["customers"]
    good = [f"g{i}" for i in range(len(names))]
    spoilt = dict(zip(names, good, strict=True)) | {"address": 'Flat "2"\nHigh Street', "annual_income": "100"}
    write_csv(lake.path("raw", "customers"), "a.csv", names, [list(spoilt.values()), good[:5], [*good, "more"]])
    assert medallion.land_bronze(lake, ("customers",)) == {"customers": 1}
    assert medallion.quarantined(lake, "customers") == 2
    assert {r._corrupt for r in medallion.quarantine(lake, "customers").collect()} == {",".join(good[:5]), ",".join([*good, "more"])}
    medallion.build_silver(lake, entities=("customers",))
    silver = lake.table("silver", "customers").collect()
    assert [(r.cust_id, r.address) for r in silver] == [("g0", 'Flat "2"\nHigh Street')]


def test_catalog_tables_have_partitions_and_statistics(spark, scratch):
    lake = Lake(spark, scratch)
    lake.write(spark.range(100).selectExpr("id", "id % 3 as part", "if(id < 10, null, 'x') as x", "struct(id) as s"), "bronze", "t", ["part"])
    name, = lake.register_catalog("bronze", ["t"], "db_statistics")
    assert spark.table(name).count() == 100 and spark.table(name).where("part = 1").inputFiles()
    shown = dict(spark.sql(f"describe extended {name} x").collect())
    assert (shown["num_nulls"], shown["distinct_count"]) == ("10", "1")
    lake.write(spark.range(5).selectExpr("id", "id % 3 as part", "'y' as x", "struct(id) as s"), "bronze", "t", ["part"])
    lake.register_catalog("bronze", ["t"], "db_statistics")
    assert spark.table(name).count() == 5


def test_lake_write_register_export(spark, scratch):
    lake = Lake(spark, scratch)
    b = feeds(spark, sf_dir("0.001"))
    written = {e: lake.write(job(b[e]), "silver", e) for e, job in SILVER_JOBS.items()}
    assert all(n > 0 for n in written.values())
    assert lake.table("silver", "loans").count() == written["loans"]
    names = lake.register("silver", list(SILVER_JOBS))
    assert spark.sql(f"select count(*) c from {names[0]}").first().c == written["branches"]
    silver = {e: lake.table("silver", e) for e in SILVER_JOBS}
    mart = gold.customer_segments(silver["customers"])
    assert lake.write(mart, "gold", "customer_segments") == mart.count()
    out = lake.export_csv(lake.table("gold", "customer_segments"), "customer_segments")
    back = spark.read.option("header", True).csv(out)
    assert back.count() == mart.count()
    cat = lake.register_catalog("gold", ["customer_segments"])
    assert spark.table(cat[0]).count() == mart.count()


def test_medallion_layers(spark, scratch):
    from bankmart.plans import medallion

    lake = Lake(spark, scratch)
    for e in SILVER_JOBS:
        _export_feed_csv(spark, e, lake.path("raw", e), files=2)
    landed = medallion.land_bronze(lake)
    assert landed["transactions"] == feed(spark, sf_dir("0.001"), "transactions").count()
    silver = medallion.build_silver(lake)
    direct = {e: SILVER_JOBS[e](feeds(spark, sf_dir("0.001"))[e]) for e in SILVER_JOBS}
    for e in SILVER_JOBS:
        assert silver[e] == direct[e].count()
        cols = silver_columns(e)
        assert rows(lake.table("silver", e), *cols) == rows(direct[e], *cols)
    marts = medallion.build_gold(lake)
    assert marts["customer_segments"] > 0
    exports = medallion.export_marts(lake)
    assert spark.read.options(header=True, multiLine=True, escape='"').csv(exports["loan_performance"]).count() == marts["loan_performance"]
    assert set(medallion.business_queries(lake)) == {
        "top_branches", "city_volumes", "channel_mix", "customer_segments", "loan_performance", "default_rates"}
