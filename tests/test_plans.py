"""Plan shapes that matter at scale (checked on the executed / optimized plans)."""

from __future__ import annotations

import pytest
from conftest import sf_dir

import __spark_entry__ as entry

SF = sf_dir("0.001")


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.llm.QUERIES if entry.llm else ())))
def test_no_pairwise_joins(spark, name):
    plan = _executed(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert "REPARTITION_BY_NUM" not in plan  # scans are not spread by a shuffle


def test_dedupe_limits_before_the_shuffle(spark):
    plan = _executed(entry.queries()["silver_transactions"](spark, SF))
    lines = plan.splitlines()
    partial = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line]
    final = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Final" in line]
    assert partial and final
    # the tree prints parents first: the exchange sits between final and partial
    between = lines[final[0]:partial[0]]
    assert any("Exchange hashpartitioning(transaction_id" in line for line in between)


def test_branch_mart_aggregates_before_joining(spark):
    df = entry.queries()["gold_branch_performance"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [i for i, line in enumerate(plan) if "Join Inner" in line]
    assert len(joins) == 2  # plain measures with distinct customers, then branches
    assert "Aggregate [branch_id" in plan[joins[1] + 1]


def test_scan_reads_only_needed_columns(spark):
    df = entry.queries()["vb_transaction_nulls"](spark, sf_dir("0.01"))
    plan = _executed(df)
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans
    for s in scans:
        assert "l_extendedprice" not in s and "l_shipdate" not in s


def test_top_k_is_a_bounded_sort(spark):
    plan = _executed(entry.queries()["vb_top_post_codes"](spark, SF))
    assert "TakeOrderedAndProject" in plan
