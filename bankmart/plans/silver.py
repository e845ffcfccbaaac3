"""Silver jobs: one lazy DataFrame chain per entity (bronze in, typed silver out).

Rule order is part of the result and follows the source pipeline:

* branches      dedupe -> type spelling -> strip manager -> staff median
                (population: deduplicated rows, *before* the post-code
                rejection) -> reject post codes
* customers     gender spelling, strip e-mail, income to number, reject post
                codes, KYC spelling -> dedupe -> income median (population:
                after rejection and dedupe).  The source job deduplicated per
                chunk before rejecting and again after; its cross-chunk
                behaviour (reject, then dedupe) is the one kept here.
* transactions  null flags, channel / status / currency spellings, balance to
                number, negative -> null -> dedupe
* loans         dedupe -> status spelling -> rate outside [0.03, 0.30] -> null
                -> drop rows without issue date -> balance above principal ->
                null -> five numeric columns to number, rounded half-even to 2

Typing (text -> number / date / boolean) is row-local, so it is done where the
source pipeline's reader did it: first.  Comparisons use unrounded values;
rounding is last, as in the source.

Each job is row-local work plus one shuffle (the dedupe).  The jobs with a
median fill stage the deduplicated table: the median is taken from its one
column and the fill reads it again, so the dedupe runs once.  ``STEPS`` has the
parts of each job around its dedupe, for tables that grow by increments
(``plans/incremental.py``): all but the median fill is local to a row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from bankmart import vocab
from bankmart.functions.cleaning import (
    is_missing,
    null_if_greater,
    null_if_negative,
    null_outside,
    round_half_even,
    standardise,
    strip_ws,
    to_bool,
    to_date,
    to_number,
)
from bankmart.operators.dedupe import dedupe_keep_first
from bankmart.operators.filters import drop_missing, reject_values
from bankmart.operators.impute import fill_median
from bankmart.schemas import KEYS, TRANSACTION_FLAGS, silver_columns
from bankmart.session import staged

LOAN_NUMERIC = ["principal_amount", "interest_rate", "term_months", "monthly_payment", "balance"]


def _finish(df: DataFrame, entity: str) -> DataFrame:
    """Silver column order, without the arrival column."""
    return df.select(*silver_columns(entity))


def type_branches(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "opening_date": to_date("opening_date"),
        "no_of_staff": to_number("no_of_staff"),
    })


def clean_branches_rows(first: DataFrame) -> DataFrame:
    """The row-local part of the branch job."""
    return first.transform(type_branches).withColumns({
        "branch_type": standardise("branch_type", vocab.BRANCH_TYPE_MAP),
        "branch_manager": strip_ws("branch_manager"),
    })


def fill_branches(cleaned: DataFrame) -> DataFrame:
    filled = fill_median(cleaned, "no_of_staff")
    return _finish(reject_values(filled, "post_code", vocab.INVALID_POSTCODES), "branches")


def silver_branches(bronze: DataFrame) -> DataFrame:
    deduped = bronze.transform(dedupe_keep_first, KEYS["branches"])
    return fill_branches(staged(clean_branches_rows(deduped), "branches-first"))


def type_customers(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "date_of_birth": to_date("date_of_birth"),
        "annual_income": to_number("annual_income"),
    })


def clean_customers_rows(bronze: DataFrame) -> DataFrame:
    """The row-local part of the customer job."""
    return (
        bronze.transform(type_customers)
        .withColumns({
            "gender": standardise("gender", vocab.GENDER_MAP),
            "email": strip_ws("email"),
            "kyc_status": standardise("kyc_status", vocab.KYC_STATUS_MAP),
        })
        .transform(reject_values, "post_code", vocab.INVALID_POSTCODES)
    )


def fill_customers(cleaned: DataFrame) -> DataFrame:
    return _finish(fill_median(cleaned, "annual_income"), "customers")


def silver_customers(bronze: DataFrame) -> DataFrame:
    deduped = clean_customers_rows(bronze).transform(dedupe_keep_first, KEYS["customers"])
    return fill_customers(staged(deduped, "customers-first"))


def type_transactions(df: DataFrame) -> DataFrame:
    return df.withColumns({
        # try_cast: an out-of-range number gives null instead of failing the job
        "account_number": to_number("account_number").try_cast("bigint"),
        "transaction_date": to_date("transaction_date"),
        "balance_after_transaction": to_number("balance_after_transaction"),
        "merchant_category_code": to_number("merchant_category_code").try_cast("int"),
        "fraud_flag": to_bool("fraud_flag"),
    })


def clean_transactions_rows(bronze: DataFrame) -> DataFrame:
    """The row-local part of the transaction job."""
    flagged = bronze.withColumns({flag: is_missing(src) for flag, src in TRANSACTION_FLAGS.items()})
    return (
        flagged.transform(type_transactions)
        .withColumns({
            "payment_channel": standardise("payment_channel", vocab.PAYMENT_CHANNEL_MAP),
            "transaction_status": standardise("transaction_status", vocab.TRANSACTION_STATUS_MAP),
            "currency": standardise("currency", vocab.CURRENCY_MAP),
        })
        .withColumn("balance_after_transaction", null_if_negative("balance_after_transaction"))
    )


def silver_transactions(bronze: DataFrame) -> DataFrame:
    cleaned = clean_transactions_rows(bronze).transform(dedupe_keep_first, KEYS["transactions"])
    return _finish(cleaned, "transactions")


def type_loans(df: DataFrame) -> DataFrame:
    typed = {c: to_number(c) for c in LOAN_NUMERIC}
    typed["default_flag"] = to_bool("default_flag")
    return df.withColumns(typed)


def clean_loans_rows(first: DataFrame) -> DataFrame:
    """The row-local part of the loan job."""
    return (
        first.transform(type_loans)
        .withColumn("loan_status", standardise("loan_status", vocab.LOAN_STATUS_MAP))
        .withColumn("interest_rate", null_outside("interest_rate", vocab.RATE_MIN, vocab.RATE_MAX))
        .transform(drop_missing, "issue_date")
        .withColumn("issue_date", to_date("issue_date"))
        .withColumn("balance", null_if_greater("balance", "principal_amount"))
        .withColumns({c: round_half_even(c, 2) for c in LOAN_NUMERIC})
    )


def silver_loans(bronze: DataFrame) -> DataFrame:
    return _finish(bronze.transform(dedupe_keep_first, KEYS["loans"]).transform(clean_loans_rows), "loans")


@dataclass(frozen=True)
class Steps:
    """A silver job: ``before`` the dedupe, ``after`` it, and what ``completes`` the whole table."""

    before: Callable[[DataFrame], DataFrame]
    after: Callable[[DataFrame], DataFrame]
    complete: Callable[[DataFrame], DataFrame]


def _as_is(df: DataFrame) -> DataFrame:
    return df


STEPS = {
    "branches": Steps(_as_is, clean_branches_rows, fill_branches),
    "customers": Steps(clean_customers_rows, _as_is, fill_customers),
    "transactions": Steps(clean_transactions_rows, _as_is, lambda df: _finish(df, "transactions")),
    "loans": Steps(_as_is, clean_loans_rows, lambda df: _finish(df, "loans")),
}

SILVER_JOBS = {
    "branches": silver_branches,
    "customers": silver_customers,
    "transactions": silver_transactions,
    "loans": silver_loans,
}


def silver_keys(entity: str, bronze: DataFrame) -> DataFrame:
    """The rows of a silver table before medians fill its gaps (as many rows): what
    counts of rows need."""
    steps = STEPS[entity]
    rows = steps.before(bronze).transform(dedupe_keep_first, KEYS[entity]).transform(steps.after)
    return rows.transform(reject_values, "post_code", vocab.INVALID_POSTCODES) if entity == "branches" else rows


def silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All four silver tables (lazy) from the four bronze feeds."""
    return {e: SILVER_JOBS[e](df) for e, df in bronze.items()}


__all__ = [
    "SILVER_JOBS", "STEPS", "Steps", "silver_keys", "clean_customers_rows", "clean_transactions_rows", "silver",
    "silver_branches", "silver_customers", "silver_loans", "silver_transactions",
]
