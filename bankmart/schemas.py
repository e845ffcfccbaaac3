"""Bronze and silver schemas of the four entities.

Bronze is all STRING: a typed CSV schema would turn a bad cell into null
without a trace, and ``cast`` under ANSI mode throws on it.  Typing happens
in silver with ``try_cast`` behind a numeric gate (see ``functions.cleaning``).
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# CSV header order of each raw feed.
BRONZE_COLUMNS: dict[str, list[str]] = {
    "branches": [
        "branch_id", "branch_name", "branch_city", "branch_province", "post_code",
        "opening_date", "branch_manager", "no_of_staff", "branch_type",
    ],
    "customers": [
        "cust_id", "first_name", "last_name", "date_of_birth", "gender",
        "marital_status", "employment_status", "kyc_status", "risk_rating",
        "address", "city", "province", "post_code", "phone_number", "email",
        "annual_income", "occupation",
    ],
    "transactions": [
        "transaction_id", "account_number", "customer_id", "branch_id",
        "transaction_date", "transaction_type", "balance_after_transaction",
        "currency", "payment_channel", "merchant_category_code",
        "transaction_status", "fraud_flag",
    ],
    "loans": [
        "loan_id", "customer_id", "loan_type", "principal_amount", "interest_rate",
        "term_months", "monthly_payment", "loan_status", "default_flag",
        "issue_date", "balance",
    ],
}

ENTITIES = tuple(BRONZE_COLUMNS)

# Business key of each entity (dedupe key).
KEYS: dict[str, str] = {
    "branches": "branch_id",
    "customers": "cust_id",
    "transactions": "transaction_id",
    "loans": "loan_id",
}

# Column carrying feed arrival order (file, position) on every bronze row.
ARRIVAL = "_arrival"

# Silver types for the columns that are not plain strings.
SILVER_TYPES: dict[str, dict[str, str]] = {
    "branches": {"opening_date": "date", "no_of_staff": "double"},
    "customers": {"date_of_birth": "date", "annual_income": "double"},
    "transactions": {
        "account_number": "bigint",
        "transaction_date": "date",
        "balance_after_transaction": "double",
        "merchant_category_code": "int",
        "fraud_flag": "boolean",
    },
    "loans": {
        "principal_amount": "double",
        "interest_rate": "double",
        "term_months": "double",
        "monthly_payment": "double",
        "balance": "double",
        "default_flag": "boolean",
        "issue_date": "date",
    },
}

# Flag columns that silver adds to transactions.
TRANSACTION_FLAGS = {
    "orphaned": "customer_id",
    "missing_account": "account_number",
    "missing_branch": "branch_id",
}


def bronze_schema(entity: str) -> StructType:
    """All-STRING schema of a raw feed, in CSV header order."""
    return StructType([StructField(c, StringType(), True) for c in BRONZE_COLUMNS[entity]])


def silver_columns(entity: str) -> list[str]:
    cols = list(BRONZE_COLUMNS[entity])
    if entity == "transactions":
        cols += list(TRANSACTION_FLAGS)
    return cols
