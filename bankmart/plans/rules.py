"""One query per cleaning rule, over whole bronze feeds.

Each shows a rule's effect on every row of a feed: the raw value beside the
cleaned value with the number of rows having that pair (a partial
``groupBy``, so a value held by a third of the rows is one row per task in
the shuffle).  The silver jobs compose the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmart import vocab
from bankmart.functions.cleaning import (
    not_in_keep_null,
    null_if_greater,
    null_if_negative,
    null_outside,
    standardise,
    strip_ws,
    to_number,
)
from bankmart.operators.dedupe import dedupe_keep_first
from bankmart.operators.impute import exact_median
from bankmart.plans import silver as S
from bankmart.schemas import KEYS


def rule_effect(df: DataFrame, column: str, cleaned: Column) -> DataFrame:
    """``(<column>_raw, <column>, count)`` over all rows of ``df``."""
    return (
        df.select(F.col(column).alias(f"{column}_raw"), cleaned.alias(column))
        .groupBy(f"{column}_raw", column)
        .agg(F.count(F.lit(1)).alias("count"))
    )


def standardise_effect(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    return rule_effect(df, column, standardise(column, mapping))


def keep_first_transactions(bronze: dict[str, DataFrame]) -> DataFrame:
    """The first copy of every transaction key, as raw text."""
    return dedupe_keep_first(bronze["transactions"], KEYS["transactions"]).select(
        "transaction_id", "balance_after_transaction", "branch_id", "payment_channel")


def median_values(bronze: dict[str, DataFrame]) -> DataFrame:
    """The two fill values: staff median (branches after dedupe, before the
    post-code rejection) and income median (customers after rejection and
    dedupe)."""
    branches = bronze["branches"].transform(dedupe_keep_first, KEYS["branches"]).transform(S.type_branches)
    customers = S.clean_customers_rows(bronze["customers"]).transform(dedupe_keep_first, KEYS["customers"])
    staff = exact_median(branches, "no_of_staff", alias="median_no_of_staff")
    income = exact_median(customers, "annual_income", alias="median_annual_income")
    return staff.select("median_no_of_staff", income.scalar().alias("median_annual_income"))


def post_code_rejection(bronze: dict[str, DataFrame]) -> DataFrame:
    """``(post_code, kept, count)`` of the customer feed."""
    c = bronze["customers"]
    return (
        c.select("post_code", not_in_keep_null("post_code", vocab.INVALID_POSTCODES).alias("kept"))
        .groupBy("post_code", "kept")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def balance_above_principal(bronze: dict[str, DataFrame]) -> DataFrame:
    """``(principal_amount_raw, balance_raw, balance, count)`` of the loan feed."""
    loans = bronze["loans"]
    return (
        loans.select(
            F.col("principal_amount").alias("principal_amount_raw"),
            F.col("balance").alias("balance_raw"),
            null_if_greater(to_number("balance"), to_number("principal_amount")).alias("balance"),
        )
        .groupBy("principal_amount_raw", "balance_raw", "balance")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def issue_date_required(bronze: dict[str, DataFrame]) -> DataFrame:
    """``(kept, count)``: loans kept / dropped by the issue-date rule."""
    return (
        bronze["loans"].select(F.col("issue_date").isNotNull().alias("kept"))
        .groupBy("kept").agg(F.count(F.lit(1)).alias("count"))
    )


RULE_QUERIES = {
    "rule_keep_first_transactions": keep_first_transactions,
    "rule_standardise_branch_type": lambda b: standardise_effect(
        b["branches"], "branch_type", vocab.BRANCH_TYPE_MAP),
    "rule_standardise_gender": lambda b: standardise_effect(b["customers"], "gender", vocab.GENDER_MAP),
    "rule_standardise_kyc_status": lambda b: standardise_effect(
        b["customers"], "kyc_status", vocab.KYC_STATUS_MAP),
    "rule_standardise_payment_channel": lambda b: standardise_effect(
        b["transactions"], "payment_channel", vocab.PAYMENT_CHANNEL_MAP),
    "rule_standardise_transaction_status": lambda b: standardise_effect(
        b["transactions"], "transaction_status", vocab.TRANSACTION_STATUS_MAP),
    "rule_standardise_currency": lambda b: standardise_effect(
        b["transactions"], "currency", vocab.CURRENCY_MAP),
    "rule_standardise_loan_status": lambda b: standardise_effect(
        b["loans"], "loan_status", vocab.LOAN_STATUS_MAP),
    "rule_strip_branch_manager": lambda b: rule_effect(
        b["branches"], "branch_manager", strip_ws("branch_manager")),
    "rule_strip_email": lambda b: rule_effect(b["customers"], "email", strip_ws("email")),
    "rule_to_number_income": lambda b: rule_effect(
        b["customers"], "annual_income", to_number("annual_income")),
    "rule_to_number_balance": lambda b: rule_effect(
        b["transactions"], "balance_after_transaction", to_number("balance_after_transaction")),
    "rule_rate_range": lambda b: rule_effect(
        b["loans"], "interest_rate", null_outside(to_number("interest_rate"), vocab.RATE_MIN, vocab.RATE_MAX)),
    "rule_negative_balance": lambda b: rule_effect(
        b["transactions"], "balance_after_transaction",
        null_if_negative(to_number("balance_after_transaction"))),
    "rule_balance_above_principal": balance_above_principal,
    "rule_issue_date_required": issue_date_required,
    "rule_median_values": median_values,
    "rule_reject_post_codes": post_code_rejection,
}
