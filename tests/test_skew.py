"""Hot keys: one key (or value) holding a third of all rows crosses the shuffle
as at most one row per map task, and results stay whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from bankmart.operators.dedupe import dedupe_keep_first
from bankmart.operators.profile import value_counts
from bankmart.schemas import ARRIVAL

N, TASKS = 30_000, 8


def _shuffle_records(df) -> list[int]:
    """Records written by each shuffle exchange of the executed plan."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.nodeName()
        if "Exchange" in name and "Broadcast" not in name:
            metrics = node.metrics()
            if metrics.contains("shuffleRecordsWritten"):
                found.append(int(metrics.apply("shuffleRecordsWritten").value()))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        # AQE wraps stages; descend into the final plan and query stages
        for attr in ("executedPlan", "plan"):
            if hasattr(node, attr):
                try:
                    walk(getattr(node, attr)())
                except Exception:
                    pass

    walk(plan)
    return found


def _hot(spark):
    # a third of the rows share key "HOT"; the rest are unique
    return (
        spark.range(N, numPartitions=TASKS)
        .select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), F.col("id"))).alias("k"),
            F.struct(F.col("id").alias("pos")).alias(ARRIVAL),
            F.col("id").alias("v"),
        )
    )


def test_dedupe_hot_key_is_combined_map_side(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # stable plan for the metric walk
    try:
        out = dedupe_keep_first(_hot(spark), "k")
        records = _shuffle_records(out)
        distinct_keys = N - N // 3 + 1
        assert records and max(records) <= distinct_keys - 1 + TASKS
        hot = out.where("k = 'HOT'").collect()
        assert len(hot) == 1 and hot[0].v == 0  # the first by arrival
        assert out.count() == distinct_keys     # whole result
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_value_counts_hot_value_is_combined_map_side(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counts = value_counts(_hot(spark), "k", ordered=False)
        records = _shuffle_records(counts)
        assert records and max(records) <= (N - N // 3) + TASKS
        assert counts.where("k = 'HOT'").first()["count"] == N // 3
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_branch_mart_with_a_hot_branch(spark):
    """One branch holds a third of the transactions, with many customers: totals
    stay exact, and the measures cross the shuffle as one row per branch per task."""
    from bankmart.plans.gold import branch_activity

    t = spark.range(N, numPartitions=TASKS).select(
        F.concat(F.lit("T"), F.col("id")).alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit("BR_HOT")).otherwise(
            F.concat(F.lit("BR"), F.col("id") % 50)).alias("branch_id"),
        F.concat(F.lit("C"), F.col("id") % 1000).alias("customer_id"),
        (F.col("id") % 100 / 4).alias("balance_after_transaction"),
        F.lit("ATM Withdrawal").alias("payment_channel"),
        F.lit("Completed").alias("transaction_status"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        act = branch_activity(t)
        records = _shuffle_records(act)
        # the measures' shuffle: at most one row per branch per task
        assert records and min(records) <= 51 * TASKS
        plan = act._jdf.queryExecution().executedPlan().toString()
        wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(branch_id" in line and "customer_id" in line]
        assert len(wide) == 1 and "balance" not in wide[0]
        hot = act.where("branch_id = 'BR_HOT'").first()
        ids = [i for i in range(N) if i % 3 == 0]
        assert hot.total_transactions == len(ids)
        assert hot.unique_customers == len({i % 1000 for i in ids})
        assert hot.total_value == sum(i % 100 for i in ids) / 4
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
