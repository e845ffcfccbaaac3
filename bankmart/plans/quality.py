"""Data-quality checks on bronze and silver tables.

Bronze checks confirm that the raw feeds landed with the dirt expected of
them; silver checks confirm each cleaning decision.  ``dirty_rates`` turns the
catalogue of known defects into one measured table: one aggregation pass per
feed (all issues of a feed are measures of the same ``agg``), unpivoted with
``stack`` and unioned - four scans, no per-issue job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart import vocab
from bankmart.functions.cleaning import strip_ws, to_number
from bankmart.functions.numeric import ratio_pct
from bankmart.operators.profile import count_where, frequency_profile, null_profile, row_count, sample_rows, value_counts
from bankmart.schemas import ARRIVAL, ENTITIES, KEYS

# ---------------------------------------------------------------- bronze ----


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``total_<entity>`` row counts of the four tables, as one row.

    The first count is the row; the others are scalar subqueries beside it.
    """
    first, *rest = ENTITIES
    return row_count(tables[first], f"total_{first}").select(
        f"total_{first}",
        *[row_count(tables[e], "n").scalar().alias(f"total_{e}") for e in rest],
    )


def spot_check(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows in arrival order, for reading by eye (a top-k)."""
    return sample_rows(df.orderBy(ARRIVAL), n).drop(ARRIVAL)


def null_staff_sample(branches: DataFrame, n: int = 5) -> DataFrame:
    return sample_rows(branches.select("no_of_staff"), n, F.col("no_of_staff").isNull())


def padded_managers(branches: DataFrame, n: int = 5) -> DataFrame:
    """The first raw managers (by branch, then arrival) with a leading space."""
    rows = branches.select("branch_id", "branch_manager", ARRIVAL).orderBy("branch_id", ARRIVAL)
    return sample_rows(rows, n, F.col("branch_manager").like(" %")).select("branch_id", "branch_manager")


def branch_type_counts(branches: DataFrame) -> DataFrame:
    return value_counts(branches, "branch_type")


def top_post_codes(branches: DataFrame, n: int = 20) -> DataFrame:
    return value_counts(branches, "post_code", limit=n)


def payment_channel_counts(transactions: DataFrame) -> DataFrame:
    return value_counts(transactions, "payment_channel")


def transaction_nulls(transactions: DataFrame) -> DataFrame:
    """One pass: rows, non-null customer ids and three null counts."""
    profile = null_profile(transactions, ["customer_id", "account_number", "branch_id"])
    return profile.select(
        "total_rows", (F.col("total_rows") - F.col("null_customer_id")).alias("non_null_customer_id"),
        "null_customer_id", "null_account_number", "null_branch_id")


def invalid_rate_counts(loans_bronze: DataFrame) -> DataFrame:
    """Frequencies of out-of-range interest rates (as numbers) in the raw feed."""
    rates = loans_bronze.select(to_number("interest_rate").alias("interest_rate"))
    bad = (F.col("interest_rate") < vocab.RATE_MIN) | (F.col("interest_rate") > vocab.RATE_MAX)
    return value_counts(rates, "interest_rate", where=bad)


def _not_canonical(c: str, mapping: dict[str, str]) -> F.Column:
    return ~F.col(c).isin(vocab.canonical_values(mapping))


def _padded(c: str) -> F.Column:
    return F.col(c) != strip_ws(c)


def dirty_issue_measures() -> dict[str, dict[str, F.Column]]:
    """Per feed: issue name -> rows affected (aggregate expressions)."""
    rate = to_number("interest_rate")
    return {
        "branches": {
            "padded_branch_manager": F.count_if(_padded("branch_manager")),
            "null_no_of_staff": F.count_if(F.col("no_of_staff").isNull()),
            "noncanonical_branch_type": F.count_if(_not_canonical("branch_type", vocab.BRANCH_TYPE_MAP)),
            "invalid_post_code": F.count_if(F.col("post_code").isin(vocab.INVALID_POSTCODES)),
        },
        "customers": {
            "noncanonical_gender": F.count_if(_not_canonical("gender", vocab.GENDER_MAP)),
            "null_annual_income": F.count_if(to_number("annual_income").isNull()),
            "padded_email": F.count_if(_padded("email")),
            "noncanonical_kyc_status": F.count_if(_not_canonical("kyc_status", vocab.KYC_STATUS_MAP)),
            "invalid_post_code": F.count_if(F.col("post_code").isin(vocab.INVALID_POSTCODES)),
        },
        "transactions": {
            "null_customer_id": F.count_if(F.col("customer_id").isNull()),
            "null_branch_id": F.count_if(F.col("branch_id").isNull()),
            "noncanonical_currency": F.count_if(F.col("currency") != "GBP"),
            "noncanonical_payment_channel": F.count_if(
                _not_canonical("payment_channel", vocab.PAYMENT_CHANNEL_MAP)),
            "negative_balance": F.count_if(to_number("balance_after_transaction") < 0),
        },
        "loans": {
            "invalid_interest_rate": F.count_if((rate < vocab.RATE_MIN) | (rate > vocab.RATE_MAX)),
            "null_interest_rate": F.count_if(rate.isNull()),
            "null_issue_date": F.count_if(F.col("issue_date").isNull()),
            "balance_above_principal": F.count_if(to_number("balance") > to_number("principal_amount")),
            "noncanonical_loan_status": F.count_if(_not_canonical("loan_status", vocab.LOAN_STATUS_MAP)),
        },
    }


def dirty_rates(bronze: dict[str, DataFrame]) -> DataFrame:
    """One row per (entity, issue): affected rows, total rows, rate in percent.

    Duplicates are the rows keep-first removes: ``rows - distinct keys``,
    with the null key counted as one key.  The issues of a feed are one plain
    ``agg`` (one row per task in its shuffle) whose measures are unpivoted
    with ``stack``; the distinct keys are a narrow aggregate of their own.
    """
    out = None
    for entity, issues in dirty_issue_measures().items():
        df = bronze[entity]
        # rows the keep-first dedupe keeps: null keys count as one key
        keys = df.select(KEYS[entity]).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
        wide = df.agg(F.count(F.lit(1)).alias("total_rows"),
                      *[c.cast("bigint").alias(n) for n, c in issues.items()])
        wide = wide.withColumn("duplicate_rows", F.col("total_rows") - keys)
        names = ["duplicate_rows", *issues]
        stack = "stack({}, {}) as (issue, affected_rows)".format(
            len(names), ", ".join(f"'{n}', `{n}`" for n in names))
        long = wide.select(F.lit(entity).alias("entity"), "total_rows", F.expr(stack))
        out = long if out is None else out.unionByName(long)
    return out.select(
        "entity", "issue", "affected_rows", "total_rows",
        ratio_pct(F.col("affected_rows"), F.col("total_rows"), 2).alias("rate_pct"),
    )


#: Columns of few values, profiled together.
PROFILED = {
    "branches": ["branch_type", "branch_city", "branch_province"],
    "customers": ["gender", "kyc_status", "risk_rating", "employment_status"],
    "transactions": ["payment_channel", "currency", "transaction_status", "fraud_flag"],
    "loans": ["loan_status", "default_flag", "term_months"],
}


def frequency_profiles(tables: dict[str, DataFrame]) -> DataFrame:
    """(entity, column, value, n_rows) of the profiled columns, one scan per table."""
    out = None
    for entity, columns in PROFILED.items():
        one = frequency_profile(tables[entity], columns).select(F.lit(entity).alias("entity"), "column", "value", "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- silver ----


def null_count(df: DataFrame, column: str, name: str) -> DataFrame:
    return count_where(df, F.col(column).isNull(), name)


def managers_with_leading_space(branches: DataFrame, n: int = 5) -> DataFrame:
    return sample_rows(branches.select("branch_manager"), n, F.col("branch_manager").like(" %"))


def silver_check_measures() -> dict[str, dict[str, F.Column]]:
    """Per silver table: check name -> rows failing it (expected 0 after
    cleaning, except null rates that were already null at source)."""
    return {
        "branches": {
            "noncanonical_branch_type": F.count_if(_not_canonical("branch_type", vocab.BRANCH_TYPE_MAP)),
            "null_no_of_staff": F.count_if(F.col("no_of_staff").isNull()),
            "manager_leading_space": F.count_if(F.col("branch_manager").like(" %")),
        },
        "customers": {
            "noncanonical_gender": F.count_if(_not_canonical("gender", vocab.GENDER_MAP)),
            "noncanonical_kyc_status": F.count_if(_not_canonical("kyc_status", vocab.KYC_STATUS_MAP)),
            "null_annual_income": F.count_if(F.col("annual_income").isNull()),
        },
        "transactions": {
            "noncanonical_payment_channel": F.count_if(
                _not_canonical("payment_channel", vocab.PAYMENT_CHANNEL_MAP)),
            "noncanonical_currency": F.count_if(F.col("currency") != "GBP"),
            "negative_balance": F.count_if(F.col("balance_after_transaction") < 0),
        },
        "loans": {
            "noncanonical_loan_status": F.count_if(_not_canonical("loan_status", vocab.LOAN_STATUS_MAP)),
            "null_interest_rate": F.count_if(F.col("interest_rate").isNull()),
            "balance_above_principal": F.count_if(F.col("balance") > F.col("principal_amount")),
        },
    }


def check_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """All scalar silver checks: one aggregation pass per table, unpivoted to
    ``(entity, check, failing_rows, total_rows)``."""
    out = None
    for entity, checks in silver_check_measures().items():
        wide = tables[entity].agg(F.count(F.lit(1)).alias("total_rows"),
                                  *[c.cast("bigint").alias(n) for n, c in checks.items()])
        stack = "stack({}, {}) as (check, failing_rows)".format(
            len(checks), ", ".join(f"'{n}', `{n}`" for n in checks))
        long = wide.select(F.lit(entity).alias("entity"), "total_rows", F.expr(stack))
        out = long if out is None else out.unionByName(long)
    return out.select("entity", "check", "failing_rows", "total_rows")


def reconciliation(bronze: dict[str, DataFrame], silver: dict[str, DataFrame]) -> DataFrame:
    """Rows in (bronze), rows out (silver) and rows removed, per entity."""
    out = None
    for e in ENTITIES:
        one = row_count(bronze[e], "bronze_rows").select(
            F.lit(e).alias("entity"), "bronze_rows",
            row_count(silver[e], "n").scalar().alias("silver_rows"),
        ).withColumn("removed_rows", F.col("bronze_rows") - F.col("silver_rows"))
        out = one if out is None else out.unionByName(one)
    return out


# Each check is a builder over a dict-like of tables, so asking for one check
# builds (and reads) only the tables that check needs.
SILVER_CHECKS = {
    "vs_row_counts": row_counts,
    "vs_branch_type_counts": lambda s: value_counts(s["branches"], "branch_type"),
    "vs_null_staff_count": lambda s: null_count(s["branches"], "no_of_staff", "null_staff_count"),
    "vs_manager_leading_space": lambda s: managers_with_leading_space(s["branches"]),
    "vs_gender_counts": lambda s: value_counts(s["customers"], "gender"),
    "vs_kyc_status_counts": lambda s: value_counts(s["customers"], "kyc_status"),
    "vs_null_income_count": lambda s: null_count(s["customers"], "annual_income", "null_income_count"),
    "vs_payment_channel_counts": lambda s: value_counts(s["transactions"], "payment_channel"),
    "vs_currency_counts": lambda s: value_counts(s["transactions"], "currency"),
    "vs_negative_balance_count": lambda s: count_where(
        s["transactions"], F.col("balance_after_transaction") < 0, "negative_balance_count"),
    "vs_orphaned_split": lambda s: value_counts(s["transactions"], "orphaned", ordered=False),
    "vs_loan_status_counts": lambda s: value_counts(s["loans"], "loan_status"),
    "vs_null_rate_count": lambda s: null_count(s["loans"], "interest_rate", "null_rate_count"),
    "vs_impossible_balance_count": lambda s: count_where(
        s["loans"], F.col("balance") > F.col("principal_amount"), "impossible_balance_count"),
    "vs_check_summary": check_summary,
    "vs_frequency_profiles": frequency_profiles,
}

BRONZE_CHECKS = {
    "vb_row_counts": row_counts,
    "vb_branch_type_counts": lambda b: branch_type_counts(b["branches"]),
    "vb_top_post_codes": lambda b: top_post_codes(b["branches"]),
    "vb_payment_channel_counts": lambda b: payment_channel_counts(b["transactions"]),
    "vb_transaction_nulls": lambda b: transaction_nulls(b["transactions"]),
    "vb_invalid_rate_counts": lambda b: invalid_rate_counts(b["loans"]),
    "vb_dirty_rates": dirty_rates,
    "vb_manager_leading_space": lambda b: padded_managers(b["branches"]),
    "vb_frequency_profiles": frequency_profiles,
}


def silver_checks(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All silver validation statements, each a DataFrame."""
    return {name: build(s) for name, build in SILVER_CHECKS.items()}


def bronze_checks(b: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All bronze validation statements, each a DataFrame."""
    return {name: build(b) for name, build in BRONZE_CHECKS.items()}
