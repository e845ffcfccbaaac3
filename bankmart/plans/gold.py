"""Gold marts over silver tables.

``branch_performance`` aggregates transactions by ``branch_id`` and joins the
per-branch result to the branch table.  The plain measures are partial
aggregates: their shuffle carries one row per branch per task however skewed
the branches are.  The distinct customers are an aggregate of their own over
two columns (one row per branch and customer per task, narrow), joined by
branch; in one aggregate every measure would travel with each such pair.
Silver branches are unique on ``branch_id``, so this is the same as joining
first and grouping by the five branch columns, without ever shipping the
fact table through a join.  The joins are between small inputs (one row per
branch id on each side); Spark broadcasts the smaller side only when its
measured size is under the broadcast threshold (AQE re-checks at runtime),
otherwise it sort-merges.

Money figures are exact and rounded half-up once, see ``functions.numeric``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart import vocab
from bankmart.functions.numeric import mean_round, money_sum, round_half_up

BRANCH_KEYS = ["branch_name", "branch_id", "branch_city", "branch_type", "opening_date"]


def _count_when(cond) -> F.Column:
    return F.count(F.when(cond, F.lit(1)))


def branch_activity(transactions: DataFrame) -> DataFrame:
    """Per-branch transaction measures (one row per non-null ``branch_id``)."""
    t = transactions.where(F.col("branch_id").isNotNull())
    channel = F.col("payment_channel")
    status = F.col("transaction_status")
    aggs = [
        F.count("transaction_id").alias("total_transactions"),
        money_sum("balance_after_transaction").alias("total_value"),
        mean_round("balance_after_transaction", 2).alias("avg_transaction_value"),
    ]
    aggs += [_count_when(channel.isin(chs)).alias(name) for name, chs in vocab.CHANNEL_GROUPS.items()]
    aggs += [
        _count_when(status == "Completed").alias("completed_count"),
        _count_when(status == "Failed").alias("failed_count"),
    ]
    plain = t.groupBy("branch_id").agg(*aggs)
    customers = (
        t.select("branch_id", "customer_id").distinct()
        .groupBy("branch_id").agg(F.count("customer_id").alias("unique_customers"))
    )
    first, *rest = [c for c in plain.columns if c != "branch_id"]
    return plain.join(customers, "branch_id").select("branch_id", first, "unique_customers", *rest)


#: What ``branch_activity`` reads of the transactions.
ACTIVITY_COLUMNS = ["transaction_id", "branch_id", "customer_id", "balance_after_transaction", "payment_channel", "transaction_status"]


def branch_performance(transactions: DataFrame, branches: DataFrame) -> DataFrame:
    """Mart: one row per branch with transactions, busiest first."""
    activity = branch_activity(transactions)
    dims = branches.select(*BRANCH_KEYS)
    measures = [c for c in activity.columns if c != "branch_id"]
    return (
        activity.join(dims, "branch_id", "inner")
        .select(*BRANCH_KEYS, *measures)
        .orderBy(F.col("total_transactions").desc(), F.col("branch_id").asc())
    )


def customer_segments(customers: DataFrame) -> DataFrame:
    """Mart: customers by risk rating, employment status and city."""
    income = F.col("annual_income")
    return (
        customers.groupBy("risk_rating", "employment_status", "city")
        .agg(
            F.count("cust_id").alias("total_customers"),
            mean_round(income, 2).alias("avg_annual_income"),
            round_half_up(F.min(income), 2).alias("min_annual_income"),
            round_half_up(F.max(income), 2).alias("max_annual_income"),
            _count_when(F.col("kyc_status") == "Verified").alias("verified_count"),
            _count_when(F.col("kyc_status") == "Pending").alias("pending_count"),
            _count_when(F.col("gender") == "Male").alias("male_count"),
            _count_when(F.col("gender") == "Female").alias("female_count"),
        )
        .orderBy(
            F.col("risk_rating").asc_nulls_last(),
            F.col("employment_status").asc_nulls_last(),
            F.col("total_customers").desc(),
            F.col("city").asc_nulls_last(),
        )
    )


def loan_performance(loans: DataFrame, rate_scale: int = 2, term_scale: int = 2) -> DataFrame:
    """Mart: loans by type, status and default flag.

    The mart rounds the mean rate and term to 2 decimals; the business query
    of the same name rounds them to 4 and 0 (``analytics.loan_performance``).
    """
    return (
        loans.groupBy("loan_type", "loan_status", "default_flag")
        .agg(
            F.count("loan_id").alias("total_loans"),
            mean_round("principal_amount", 2).alias("avg_principal"),
            mean_round("interest_rate", rate_scale).alias("avg_interest_rate"),
            mean_round("monthly_payment", 2).alias("avg_monthly_payment"),
            money_sum("balance").alias("total_remaining_balance"),
            mean_round("term_months", term_scale).alias("avg_term_months"),
        )
        .orderBy(
            F.col("loan_type").asc_nulls_last(),
            F.col("total_loans").desc(),
            F.col("loan_status").asc_nulls_last(),
            F.col("default_flag").asc_nulls_last(),
        )
    )


MARTS = {
    "gold_branch_performance": lambda s: branch_performance(s["transactions"], s["branches"]),
    "gold_customer_segments": lambda s: customer_segments(s["customers"]),
    "gold_loan_performance": lambda s: loan_performance(s["loans"]),
}
