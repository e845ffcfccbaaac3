"""Tables and marts that follow new files give what a full run gives."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest
from conftest import rows, sf_dir
from pyspark.sql import functions as F

from bankmart.functions import bloom
from bankmart.operators.dedupe import dedupe_keep_first
from bankmart.plans import gold, incremental
from bankmart.plans.silver import SILVER_JOBS
from bankmart.session import staged
from bankmart.sources import growing
from bankmart.sources.growing import KEY, GrowingTable
from bankmart.sources.lake import Lake
from testfeeds.tpch_feed import feed


def events(spark, n=3000):
    return spark.range(n).selectExpr("if(id % 50 = 0, null, cast(id * 7 % 1700 as string)) as k", "id as v", "id as _arrival")


def in_parts(table, full, bounds):
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        table.add(full.where(f"v >= {lo} and v < {hi}"), "k")


@pytest.mark.parametrize("block_keys", [2500, 40])
def test_base_and_increments_are_a_full_run(spark, scratch, monkeypatch, block_keys):
    monkeypatch.setattr(growing, "BLOCK_KEYS", block_keys)  # the smaller one builds the filter anew
    monkeypatch.setattr(growing, "MOST_PARTS", 2)
    table, full = GrowingTable(spark, f"{scratch}/t"), events(spark)
    in_parts(table, full, [0, 500, 501, 1500, 3000])
    want = rows(dedupe_keep_first(full, "k"), "k", "v")
    assert rows(table.read(), "k", "v") == want and table.version().rows == len(want)
    assert len(table.version().index["keys"]) <= 2
    assert table.add(full, "k").counts == {"added": 0}  # all known, the null key too
    assert table.add(full.limit(0), "k").rows == len(want)


def test_increment_that_breaks_off_is_as_if_not_begun(spark, scratch):
    table, full = GrowingTable(spark, f"{scratch}/t"), events(spark)
    in_parts(table, full, [0, 1000])
    with pytest.raises(Exception, match="half way"):
        table.add(full.where("v >= 1000"), "k", lambda df: df.withColumn("v", F.when(F.col("v") == 1001, F.raise_error(F.lit("half way"))).otherwise(F.col("v")).cast("long")))
    assert table.version().number == 1
    in_parts(table, full, [1000, 3000])
    assert rows(table.read(), "k", "v") == rows(dedupe_keep_first(full, "k"), "k", "v")
    kept = rows(table.read(), "k", "v")
    table.vacuum()
    assert rows(table.read(), "k", "v") == kept
    assert table.add(full, "k").counts == {"added": 0}


def test_index_is_not_shuffled(spark, scratch):
    table = GrowingTable(spark, f"{scratch}/t")
    in_parts(table, events(spark), [0, 1000])
    of = table.version()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = staged(spark.range(50).selectExpr(f"concat('=', id) as {KEY}"), "asked")
        join = asked.join(table._keys(of.index["keys"][0], of.index["buckets"]), KEY, "left_semi")
        plan = join._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and plan.count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_of_an_increment_are_shuffled_once_and_staged_nowhere(spark, scratch, monkeypatch):
    root = os.path.dirname(staged(spark.range(1), "probe").inputFiles()[0].removeprefix("file:")).rsplit("/", 1)[0]
    table, full, written = GrowingTable(spark, f"{scratch}/t"), events(spark).withColumn("wide", F.lit("payload")), []
    in_parts(table, full, [0, 1000])
    before = set(os.listdir(root))
    plain = GrowingTable.write_folder

    def seen(self, df, folder, *more):
        written.append((folder.split("-")[0], df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return plain(self, df, folder, *more)

    monkeypatch.setattr(GrowingTable, "write_folder", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        in_parts(table, full, [1000, 3000])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(table.read(), "k", "v") == rows(dedupe_keep_first(full, "k"), "k", "v")
    plan, = [p for what, _, p in written if what == "data"]
    assert plan.count("Exchange hashpartitioning") == 2 and "wide" in plan  # the rows, and the known keys
    assert set(os.listdir(root)) == before  # nothing stays of what was staged


def test_a_filter_of_the_earlier_kind_is_not_asked(spark, scratch):
    """Its blocks went by another hash, so it could deny keys that the table has."""
    table, full = GrowingTable(spark, f"{scratch}/t"), events(spark)
    in_parts(table, full, [0, 1000])
    of = table.version()
    index = {k: v for k, v in of.index.items() if k != "bucket_blocks"} | {"blocks": 3}
    table.commit(replace(of, number=2, index=index))
    in_parts(table, full, [0, 3000])
    assert rows(table.read(), "k", "v") == rows(dedupe_keep_first(full, "k"), "k", "v")
    assert table.version().index["bucket_blocks"] and table.add(full, "k").counts == {"added": 0}


def test_blocks_of_a_filter_follow_the_buckets_of_the_keys(spark, scratch):
    """Else every task that reads keys would shuffle a bitmap of every block."""
    table = GrowingTable(spark, f"{scratch}/t")
    table.add(spark.range(20000).selectExpr("cast(id as string) as k", "id as v", "id as _arrival"), "k")
    of = table.version()
    keys = table.read_folders(of.index["keys"], f"{KEY} string")
    blocks = of.index["bucket_blocks"] * of.index["buckets"]
    found = keys.select(bloom.block_of(F.col(KEY), blocks), F.input_file_name().alias("file")).distinct().collect()
    assert len(found) == len({r.block for r in found}) == blocks


def test_few_customers_of_a_bucket_are_rows_and_many_a_bitmap(spark, scratch, monkeypatch):
    monkeypatch.setattr(incremental, "MOST_LISTED", 20)
    lake, want = Lake(spark, scratch), None
    # a hundred branches with three customers each, and one with all: all of them few, then one of many, then more of that
    for lo, hi in ((0, 15), (15, 300), (300, 400)):
        new = spark.range(lo, hi).selectExpr("concat('t', id) as transaction_id", "concat('b', id % 100) as branch_id", "concat('c', id) as customer_id")
        new = new.unionByName(new.selectExpr("concat('a', transaction_id) as transaction_id", "'all' as branch_id", "customer_id")).withColumn("_arrival", F.lit(0))
        incremental.growing(lake, "transactions").add(new, "transaction_id", lambda df: df.drop("_arrival"))
        want = new if want is None else want.unionByName(new)
        found = incremental.follow_branch_customers(lake)
        count = found.groupBy("branch_id").agg(F.sum(F.coalesce(F.bitmap_count("bits"), F.lit(1))).alias("n"))
        assert rows(count) == rows(want.groupBy("branch_id").agg(F.countDistinct("customer_id").alias("n")))
        assert found.where("(at is null) = (bits is null)").count() == 0
        kinds = found.groupBy("branch_id", "bucket").agg(F.count("at").alias("listed"), F.count("bits").alias("bitmaps"))
        assert kinds.where("bitmaps > 1 or listed > 20 or (bitmaps = 1 and listed > 0)").count() == 0
    assert found.where("branch_id = 'all' and bits is not null").count() > 0
    assert found.where("branch_id <> 'all' and bits is not null").count() == 0


def test_filter_denies_no_key_and_few_others(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) as key")
    built = bloom.build(keys.where("substr(key, 2) % 2 = 0"), F.col("key"), 2)
    both = bloom.merge(built.unionByName(bloom.build(keys.where("substr(key, 2) % 4 = 1"), F.col("key"), 2)))
    seen = keys.withColumn("block", bloom.block_of(F.col("key"), 2)).join(both, "block", "left").withColumn("m", bloom.may_hold(F.col("bits"), F.col("key")))
    got = {r.key: r.m for r in seen.collect()}
    assert all(got[f"k{i}"] for i in range(5000) if i % 2 == 0 or i % 4 == 1)
    assert sum(got[f"k{i}"] for i in range(3, 5000, 4)) < 60
    assert not any(r[0] for r in keys.limit(5).select(bloom.may_hold(F.lit(None).cast("binary"), F.col("key"))).collect())


def test_marts_follow(spark, scratch):
    """Increments by ranges of the feed's arrival order, marts after each and at the end."""
    lake = Lake(spark, scratch)
    whole = {}
    for e in ("branches", "customers", "transactions", "loans"):
        df = feed(spark, sf_dir("0.001"), e)
        part = F.pmod(F.xxhash64(df.columns[0]), F.lit(3))  # copies of a key come in later parts, too
        df = staged(df.withColumn("part", F.when(F.rand(3) < 0.3, F.least(part + 1, F.lit(2))).otherwise(part)), "feed")
        whole[e] = SILVER_JOBS[e](df.withColumn("_arrival", F.struct("part", "_arrival")).drop("part"))
        steps = incremental.STEPS[e]
        for n in range(3):
            increment = steps.before(df.where(f"part = {n}").drop("part"))
            incremental.growing(lake, e).add(increment, incremental.KEYS[e], lambda first, s=steps: s.after(first).drop("_arrival"))
            if e == "customers":
                incremental.customer_segments(lake).count()
            if e == "transactions" and n != 1:  # one update takes two increments
                incremental.branch_performance(lake).count()
    for e, silver in whole.items():
        assert rows(incremental.current(lake, e)) == rows(silver), e
    assert rows(incremental.loan_performance(lake)) == rows(gold.loan_performance(whole["loans"]))
    mart = gold.customer_segments(whole["customers"])
    assert rows(incremental.customer_segments(lake), *mart.columns) == rows(mart)
    mart = gold.branch_performance(whole["transactions"], whole["branches"])
    assert rows(incremental.branch_performance(lake), *mart.columns) == rows(mart)
    assert rows(incremental.branch_performance(lake), *mart.columns) == rows(mart)  # nothing counts twice


def test_malformed_rows_of_an_increment_stay_behind(spark, scratch):
    from conftest import write_csv

    from bankmart.schemas import BRONZE_COLUMNS

    names = BRONZE_COLUMNS["loans"]
    lake = Lake(spark, f"{scratch}/lake")
    good = dict.fromkeys(names, "1") | {"issue_date": "2024-01-01"}
    for n in range(2):
        path = write_csv(scratch, f"{n}.csv", names, [list((good | {"loan_id": f"L{n}"}).values()), ["half", "a row"], list((good | {"loan_id": "L0"}).values())])
        incremental.take(lake, "loans", path)
    assert sorted(r.loan_id for r in incremental.current(lake, "loans").collect()) == ["L0", "L1"]
    bronze = lake.version("bronze", "loans")
    assert (bronze.rows, bronze.counts) == (6, {"malformed": 1, "added": 3})
    assert lake.table("bronze", "loans").where("_malformed").count() == 2
