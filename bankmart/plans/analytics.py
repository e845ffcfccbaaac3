"""The six business queries over silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.functions.numeric import exact_units, not_finite, ratio_pct, rest_units, rounded_total
from bankmart.plans import gold
from bankmart.session import staged


def top_branches(transactions: DataFrame, branches: DataFrame, n: int = 10) -> DataFrame:
    """Busiest ``n`` branches (ties by branch id).  Planned as a top-k
    (``TakeOrderedAndProject``): each task keeps ``n`` rows."""
    return gold.branch_performance(transactions, branches).limit(n)


def city_volumes(transactions: DataFrame, branches: DataFrame) -> DataFrame:
    """Transactions and total balance per branch city.

    Pre-aggregated per branch id (exact units), joined to the branch
    table, then summed per city: the fact table is never joined row by row.
    """
    per_branch = (
        transactions.where(F.col("branch_id").isNotNull())
        .groupBy("branch_id")
        .agg(
            F.count("transaction_id").alias("n"),
            F.sum(exact_units("balance_after_transaction")).alias("units"),
            F.sum(not_finite("balance_after_transaction")).alias("odd"),
            F.sum(rest_units("balance_after_transaction")).alias("rest"),
        )
    )
    return (
        per_branch.join(branches.select("branch_id", "branch_city"), "branch_id", "inner")
        .groupBy("branch_city")
        .agg(
            F.sum("n").alias("total_transactions"),
            rounded_total(F.sum("units"), F.sum("odd"), rest=F.sum("rest")).alias("total_value"),
        )
        .orderBy(F.col("total_transactions").desc(), F.col("branch_city").asc_nulls_last())
    )


def channel_mix(transactions: DataFrame) -> DataFrame:
    """Transactions per payment channel and their share of all transactions.

    The grouped result is staged, so the denominator is a one-row total of
    it beside each row: no window, and the transactions are computed once.
    """
    counts = staged(transactions.groupBy("payment_channel").agg(F.count(F.lit(1)).alias("transaction_count")), "channels")
    total = counts.agg(F.sum("transaction_count")).scalar()
    return (
        counts.withColumn("pct_of_total", ratio_pct(F.col("transaction_count"), total, 2))
        .orderBy(F.col("transaction_count").desc(), F.col("payment_channel").asc_nulls_last())
    )


def customer_segments(customers: DataFrame) -> DataFrame:
    """Same as the customer-segment mart."""
    return gold.customer_segments(customers)


def loan_performance(loans: DataFrame) -> DataFrame:
    """Loan mart with the mean rate to 4 decimals and the mean term to 0."""
    return gold.loan_performance(loans, rate_scale=4, term_scale=0)


def default_rates(loans: DataFrame) -> DataFrame:
    """Default rate (percent, 2 decimals) per loan type, highest first."""
    defaulted = F.count(F.when(F.col("default_flag") == F.lit(True), F.lit(1)))
    return (
        loans.groupBy("loan_type")
        .agg(F.count(F.lit(1)).alias("total_loans"), defaulted.alias("defaulted_loans"))
        .withColumn("default_rate_pct", ratio_pct(F.col("defaulted_loans"), F.col("total_loans"), 2))
        .orderBy(F.col("default_rate_pct").desc(), F.col("loan_type").asc_nulls_last())
    )


QUERIES = {
    "top_branches": lambda s: top_branches(s["transactions"], s["branches"]),
    "city_volumes": lambda s: city_volumes(s["transactions"], s["branches"]),
    "channel_mix": lambda s: channel_mix(s["transactions"]),
    "customer_segments": lambda s: customer_segments(s["customers"]),
    "loan_performance": lambda s: loan_performance(s["loans"]),
    "default_rates": lambda s: default_rates(s["loans"]),
}

__all__ = ["QUERIES", "channel_mix", "city_volumes", "customer_segments", "default_rates",
           "loan_performance", "top_branches"]
