"""Hand-written DuckDB SQL for every registered query (the correctness oracle).

The oracle shares with the library the derived feeds' text (the *input*), the
fixed values (synonym maps, rejected post codes, channel groups) and the
column names of the results.  The rules are written here as SQL of their
own: amounts are added as the decimal text of each value and rounded once.

Counts are BIGINT, money and means DOUBLE, dates DATE, flags BOOLEAN.
"""

from __future__ import annotations

from bankmart import vocab
from testfeeds.tpch_feed import FEEDS_DUCKDB as FEEDS

# --------------------------------------------------------------------------
# scalar helpers (SQL text)
# --------------------------------------------------------------------------


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^\\s+', ''), '\\s+$', '')"


NUM_RE = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))$"


def num(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN regexp_matches({s}, '{NUM_RE}') AND NOT isnan(try_cast({s} AS DOUBLE)) "
            f"THEN try_cast({s} AS DOUBLE) END)")


def lookup(x: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {x} {arms} ELSE {x} END)"


def boolean(x: str) -> str:
    s = f"lower({strip(x)})"
    return f"(CASE WHEN {s} = 'true' THEN TRUE WHEN {s} = 'false' THEN FALSE END)"


def as_date(x: str) -> str:
    return f"try_cast({strip(x)} AS DATE)"


def not_listed(x: str, values: list[str]) -> str:
    return f"({x} IS NULL OR {x} NOT IN ({', '.join(q(v) for v in values)}))"


def decimal(x: str) -> str:
    """The decimal that the text of a finite double shows."""
    return f"CAST(CAST(CASE WHEN isfinite({x}) THEN {x} END AS VARCHAR) AS DECIMAL(38,12))"


def odd(x: str) -> str:
    return f"sum(CASE WHEN NOT isfinite({x}) THEN {x} END)"


def rounded_sum(x: str) -> str:
    return f"coalesce({odd(x)}, CAST(round(sum({decimal(x)}), 2) AS DOUBLE))"


def half_up(num_sql: str, den_sql: str) -> str:
    """round(num/den) half away from zero, integers, den > 0."""
    return (f"(CASE WHEN ({den_sql}) <= 0 THEN NULL WHEN ({num_sql}) >= 0 "
            f"THEN (2 * ({num_sql}) + ({den_sql})) // (2 * ({den_sql})) "
            f"ELSE -((-2 * ({num_sql}) + ({den_sql})) // (2 * ({den_sql}))) END)")


def rounded_mean(x: str, scale: int) -> str:
    """Exact avg rounded half-up to ``scale``; a decimal's text without its point counts 1e-12."""
    units = f"CAST(replace(CAST(sum({decimal(x)}) AS VARCHAR), '.', '') AS HUGEINT)"
    n = f"CAST(count({decimal(x)}) AS HUGEINT) * {10 ** (12 - scale)}"
    return f"coalesce({odd(x)}, CAST({half_up(units, n)} AS DOUBLE) / {10 ** scale})"


def pct(num_sql: str, den_sql: str, scale: int = 2) -> str:
    n = f"CAST({num_sql} AS HUGEINT) * {100 * 10 ** scale}"
    d = f"CAST({den_sql} AS HUGEINT)"
    return f"(CAST({half_up(n, d)} AS DOUBLE) / {10 ** scale})"


def round2(x: str) -> str:
    return f"CASE WHEN isfinite({x}) THEN CAST(round({decimal(x)}, 2) AS DOUBLE) ELSE {x} END"


def count_if(cond: str) -> str:
    return f"count(CASE WHEN {cond} THEN 1 END)"


# --------------------------------------------------------------------------
# bronze: derived feeds with missing-value spellings read as null
# --------------------------------------------------------------------------

TOKENS = ", ".join(q(t) for t in vocab.NULL_TOKENS)


def arriving(entity: str) -> str:
    """The source rows of a feed, those that arrive twice with both copy numbers."""
    spec = FEEDS[entity]
    copies = f"unnest(CASE WHEN {spec.copies_when} THEN [1, 2] ELSE [1] END)" if spec.copies_when else "1"
    return f"(SELECT *, {copies} AS copy_no FROM {spec.table})"


def csv_cell(x: str) -> str:
    quoted = f"'\"' || replace({x}, '\"', '\"\"') || '\"'"
    return f"CASE WHEN regexp_matches({x}, '[,\"\n]') THEN {quoted} ELSE coalesce({x}, '') END"


def malformed_lines(entity: str) -> str:
    spec = FEEDS[entity]
    cells = [csv_cell(f"({e})") for _, e in reversed(spec.columns)]
    line = " || ',' || ".join(cells)
    return (f"SELECT CASE WHEN {spec.cut_when} THEN {' || chr(44) || '.join(cells[:3])} ELSE {line} || ',surplus' END AS line "
            f"FROM {arriving(entity)} src WHERE {spec.damaged_when}")


def bronze_cte(entity: str) -> str:
    spec = FEEDS[entity]
    src = arriving(entity)
    raw_cols = ",\n    ".join(f"{e} AS {c}" for c, e in spec.columns)
    arr_cols = ", ".join(f"{e} AS _a{i}" for i, e in enumerate(spec.arrival))
    cleaned = ", ".join(f"CASE WHEN {c} IN ({TOKENS}) THEN NULL ELSE {c} END AS {c}" for c, _ in spec.columns)
    arr = ", ".join(f"_a{i}" for i in range(len(spec.arrival)))
    return (f"bronze_{entity} AS (SELECT {cleaned}, {arr} FROM (SELECT {raw_cols}, {arr_cols} "
            f"FROM {src} src) raw)")


def arrival_order(entity: str) -> str:
    return ", ".join(f"_a{i}" for i in range(len(FEEDS[entity].arrival)))


def first_by_key(table: str, key: str, entity: str) -> str:
    return (f"(SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {arrival_order(entity)}) AS _rn FROM {table}) WHERE _rn = 1)")


# --------------------------------------------------------------------------
# silver
# --------------------------------------------------------------------------

SILVER_BRANCHES = f"""
branches_first AS (
  SELECT branch_id, branch_name, branch_city, branch_province, post_code,
         {as_date('opening_date')} AS opening_date,
         {strip('branch_manager')} AS branch_manager,
         {num('no_of_staff')} AS no_of_staff,
         {lookup('branch_type', vocab.BRANCH_TYPE_MAP)} AS branch_type
  FROM {first_by_key('bronze_branches', 'branch_id', 'branches')} b
),
silver_branches AS (
  SELECT branch_id, branch_name, branch_city, branch_province, post_code, opening_date,
         branch_manager,
         coalesce(no_of_staff, (SELECT median(no_of_staff) FROM branches_first)) AS no_of_staff,
         branch_type
  FROM branches_first
  WHERE {not_listed('post_code', vocab.INVALID_POSTCODES)}
)"""

SILVER_CUSTOMERS = f"""
customers_kept AS (
  SELECT cust_id, first_name, last_name, {as_date('date_of_birth')} AS date_of_birth,
         {lookup('gender', vocab.GENDER_MAP)} AS gender, marital_status, employment_status,
         {lookup('kyc_status', vocab.KYC_STATUS_MAP)} AS kyc_status, risk_rating, address, city,
         province, post_code, phone_number, {strip('email')} AS email,
         {num('annual_income')} AS annual_income, occupation, {arrival_order('customers')}
  FROM bronze_customers
  WHERE {not_listed('post_code', vocab.INVALID_POSTCODES)}
),
customers_first AS (
  SELECT * EXCLUDE ({arrival_order('customers')})
  FROM {first_by_key('customers_kept', 'cust_id', 'customers')} c
),
silver_customers AS (
  SELECT * REPLACE (coalesce(annual_income, (SELECT median(annual_income) FROM customers_first))
                    AS annual_income)
  FROM customers_first
)"""

SILVER_TRANSACTIONS = f"""
silver_transactions AS (
  SELECT transaction_id,
         CAST({num('account_number')} AS BIGINT) AS account_number,
         customer_id, branch_id,
         {as_date('transaction_date')} AS transaction_date,
         transaction_type,
         CASE WHEN {num('balance_after_transaction')} < 0 THEN NULL
              ELSE {num('balance_after_transaction')} END AS balance_after_transaction,
         {lookup('currency', vocab.CURRENCY_MAP)} AS currency,
         {lookup('payment_channel', vocab.PAYMENT_CHANNEL_MAP)} AS payment_channel,
         CAST({num('merchant_category_code')} AS INTEGER) AS merchant_category_code,
         {lookup('transaction_status', vocab.TRANSACTION_STATUS_MAP)} AS transaction_status,
         {boolean('fraud_flag')} AS fraud_flag,
         customer_id IS NULL AS orphaned,
         account_number IS NULL AS missing_account,
         branch_id IS NULL AS missing_branch
  FROM {first_by_key('bronze_transactions', 'transaction_id', 'transactions')} t
)"""

SILVER_LOANS = f"""
loans_typed AS (
  SELECT loan_id, customer_id, loan_type,
         {num('principal_amount')} AS principal_amount,
         {num('interest_rate')} AS interest_rate,
         {num('term_months')} AS term_months,
         {num('monthly_payment')} AS monthly_payment,
         {lookup('loan_status', vocab.LOAN_STATUS_MAP)} AS loan_status,
         {boolean('default_flag')} AS default_flag,
         issue_date,
         {num('balance')} AS balance
  FROM {first_by_key('bronze_loans', 'loan_id', 'loans')} l
  WHERE issue_date IS NOT NULL
),
silver_loans AS (
  SELECT loan_id, customer_id, loan_type,
         round_even(principal_amount, 2) AS principal_amount,
         round_even(CASE WHEN interest_rate < 0.03 OR interest_rate > 0.30 THEN NULL
                         ELSE interest_rate END, 2) AS interest_rate,
         round_even(term_months, 2) AS term_months,
         round_even(monthly_payment, 2) AS monthly_payment,
         loan_status, default_flag,
         {as_date('issue_date')} AS issue_date,
         round_even(CASE WHEN balance > principal_amount THEN NULL ELSE balance END, 2) AS balance
  FROM loans_typed
)"""

SILVER_CTE = {
    "branches": SILVER_BRANCHES,
    "customers": SILVER_CUSTOMERS,
    "transactions": SILVER_TRANSACTIONS,
    "loans": SILVER_LOANS,
}


def with_layers(body: str, bronze: tuple[str, ...] = (), silver: tuple[str, ...] = ()) -> str:
    """``WITH`` the bronze feeds (and silver tables) a query needs, then ``body``."""
    need_bronze = list(dict.fromkeys([*bronze, *silver]))
    ctes = [bronze_cte(e) for e in need_bronze] + [SILVER_CTE[e].strip() for e in silver]
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --------------------------------------------------------------------------
# gold and business queries
# --------------------------------------------------------------------------

def _among(column: str, values) -> str:
    return f"{column} IN ({', '.join(q(v) for v in values)})"


# counts by branch, channel and status first; the marts add them up
_TALLY = """
tally AS (
  SELECT branch_id AS id, payment_channel AS via, transaction_status AS ended, count(transaction_id) AS n
  FROM silver_transactions WHERE branch_id IS NOT NULL GROUP BY ALL
)"""

_MONEY = f"""
money AS (
  SELECT branch_id AS id, sum({decimal('balance_after_transaction')}) AS exact,
         {odd('balance_after_transaction')} AS odd,
         {rounded_mean('balance_after_transaction', 2)} AS mean
  FROM silver_transactions GROUP BY branch_id
)"""

_FACES = """
faces AS (
  SELECT id, count(*) AS n
  FROM (SELECT DISTINCT branch_id AS id, customer_id FROM silver_transactions WHERE customer_id IS NOT NULL)
  GROUP BY id
)"""

_BRANCH_COUNTS = ", ".join(
    [f"CAST(coalesce(sum(n) FILTER (WHERE {_among('via', chs)}), 0) AS BIGINT) AS {name}" for name, chs in vocab.CHANNEL_GROUPS.items()]
    + [f"CAST(coalesce(sum(n) FILTER (WHERE ended = {q(v)}), 0) AS BIGINT) AS {v.lower()}_count" for v in ("Completed", "Failed")])
_COUNT_NAMES = ", ".join([*vocab.CHANNEL_GROUPS, "completed_count", "failed_count"])

BRANCH_PERFORMANCE = f"""
, {_TALLY.strip()}, {_MONEY.strip()}, {_FACES.strip()},
totals AS (SELECT id, CAST(sum(n) AS BIGINT) AS total_transactions, {_BRANCH_COUNTS} FROM tally GROUP BY id)
SELECT branch_name, branch_id, branch_city, branch_type, opening_date, total_transactions,
       coalesce(faces.n, 0) AS unique_customers,
       coalesce(odd, CAST(round(exact, 2) AS DOUBLE)) AS total_value, mean AS avg_transaction_value, {_COUNT_NAMES}
FROM totals JOIN money USING (id) LEFT JOIN faces USING (id) JOIN silver_branches ON branch_id = id
"""

CITY_VOLUMES = f"""
, {_TALLY.strip()}, {_MONEY.strip()},
moves AS (SELECT id, sum(n) AS n FROM tally GROUP BY id)
SELECT branch_city, CAST(sum(n) AS BIGINT) AS total_transactions,
       coalesce(sum(odd), CAST(round(sum(exact), 2) AS DOUBLE)) AS total_value
FROM silver_branches, moves, money WHERE branch_id = moves.id AND branch_id = money.id
GROUP BY branch_city
"""

# people grouped with every attribute that is counted, then summed per segment
CUSTOMER_SEGMENTS = f"""
, kinds AS (
  SELECT risk_rating AS r, employment_status AS e, city AS c, kyc_status AS k, gender AS g, count(cust_id) AS n
  FROM silver_customers GROUP BY ALL
),
incomes AS (
  SELECT risk_rating AS r, employment_status AS e, city AS c, {rounded_mean('annual_income', 2)} AS mean,
         min(annual_income) AS lo, max(annual_income) AS hi
  FROM silver_customers GROUP BY ALL
)
SELECT i.r AS risk_rating, i.e AS employment_status, i.c AS city, CAST(sum(n) AS BIGINT) AS total_customers,
       any_value(mean) AS avg_annual_income, {round2('any_value(lo)')} AS min_annual_income,
       {round2('any_value(hi)')} AS max_annual_income,
       {', '.join(f"CAST(coalesce(sum(n) FILTER (WHERE {col} = {q(v)}), 0) AS BIGINT) AS {v.lower()}_count"
                  for col, v in (('k', 'Verified'), ('k', 'Pending'), ('g', 'Male'), ('g', 'Female')))}
FROM incomes i JOIN kinds k ON (i.r, i.e, i.c) IS NOT DISTINCT FROM (k.r, k.e, k.c)
GROUP BY i.r, i.e, i.c
"""


def loan_performance_sql(rate_scale: int, term_scale: int) -> str:
    def of(column: str, alias: str, scale: int) -> str:
        return f"{rounded_mean(column, scale)} AS {alias}"

    means = ", ".join([of("principal_amount", "avg_principal", 2), of("interest_rate", "avg_interest_rate", rate_scale),
                       of("monthly_payment", "avg_monthly_payment", 2), of("term_months", "avg_term_months", term_scale)])
    return f"""
SELECT {means}, {rounded_sum('balance')} AS total_remaining_balance, count(loan_id) AS total_loans,
       loan_status, default_flag, loan_type
FROM silver_loans GROUP BY ALL
"""


CHANNEL_MIX = f"""
SELECT payment_channel, transaction_count,
    {pct('transaction_count', 'sum(transaction_count) OVER ()')} AS pct_of_total
FROM (SELECT payment_channel, count(*) AS transaction_count
      FROM silver_transactions GROUP BY payment_channel) c
ORDER BY transaction_count DESC
"""

DEFAULT_RATES = f"""
SELECT loan_type, total_loans, defaulted_loans,
    {pct('defaulted_loans', 'total_loans')} AS default_rate_pct
FROM (SELECT loan_type, count(*) AS total_loans,
             {count_if('default_flag = TRUE')} AS defaulted_loans
      FROM silver_loans GROUP BY loan_type) d
ORDER BY default_rate_pct DESC
"""


def value_counts(table: str, column: str, where: str | None = None, limit: int | None = None,
                 column_expr: str | None = None) -> str:
    expr = column_expr or column
    w = f" WHERE {where}" if where else ""
    lim = f" ORDER BY count DESC, {column} ASC NULLS LAST LIMIT {limit}" if limit else ""
    return f"SELECT {expr} AS {column}, count(*) AS count FROM {table}{w} GROUP BY {expr}{lim}"


PROFILED = {"branches": ["branch_type", "branch_city", "branch_province"],
            "customers": ["gender", "kyc_status", "risk_rating", "employment_status"],
            "transactions": ["payment_channel", "currency", "transaction_status", "fraud_flag"],
            "loans": ["loan_status", "default_flag", "term_months"]}


def scalar(table: str, cond: str, name: str) -> str:
    return f"SELECT {count_if(cond)} AS {name} FROM {table}"


def row_counts(layer: str) -> str:
    cols = ", ".join(f"(SELECT count(*) FROM {layer}_{e}) AS total_{e}" for e in
                     ("branches", "customers", "transactions", "loans"))
    return f"SELECT {cols}"


# --------------------------------------------------------------------------
# dirty-data rates (bronze)
# --------------------------------------------------------------------------

_CANON_TYPES = ", ".join(q(v) for v in vocab.canonical_values(vocab.BRANCH_TYPE_MAP))
_CANON_GENDER = ", ".join(q(v) for v in vocab.canonical_values(vocab.GENDER_MAP))
_CANON_KYC = ", ".join(q(v) for v in vocab.canonical_values(vocab.KYC_STATUS_MAP))
_CANON_CHANNEL = ", ".join(q(v) for v in vocab.canonical_values(vocab.PAYMENT_CHANNEL_MAP))
_CANON_LOAN = ", ".join(q(v) for v in vocab.canonical_values(vocab.LOAN_STATUS_MAP))
_BAD_POST = ", ".join(q(v) for v in vocab.INVALID_POSTCODES)


def _padded(c: str) -> str:
    return f"{c} <> {strip(c)}"


DIRTY_ISSUES: dict[str, list[tuple[str, str]]] = {
    "branches": [
        ("duplicate_rows", ""),
        ("padded_branch_manager", _padded("branch_manager")),
        ("null_no_of_staff", "no_of_staff IS NULL"),
        ("noncanonical_branch_type", f"branch_type NOT IN ({_CANON_TYPES})"),
        ("invalid_post_code", f"post_code IN ({_BAD_POST})"),
    ],
    "customers": [
        ("duplicate_rows", ""),
        ("noncanonical_gender", f"gender NOT IN ({_CANON_GENDER})"),
        ("null_annual_income", f"{num('annual_income')} IS NULL"),
        ("padded_email", _padded("email")),
        ("noncanonical_kyc_status", f"kyc_status NOT IN ({_CANON_KYC})"),
        ("invalid_post_code", f"post_code IN ({_BAD_POST})"),
    ],
    "transactions": [
        ("duplicate_rows", ""),
        ("null_customer_id", "customer_id IS NULL"),
        ("null_branch_id", "branch_id IS NULL"),
        ("noncanonical_currency", "currency <> 'GBP'"),
        ("noncanonical_payment_channel", f"payment_channel NOT IN ({_CANON_CHANNEL})"),
        ("negative_balance", f"{num('balance_after_transaction')} < 0"),
    ],
    "loans": [
        ("duplicate_rows", ""),
        ("invalid_interest_rate",
         f"{num('interest_rate')} < 0.03 OR {num('interest_rate')} > 0.30"),
        ("null_interest_rate", f"{num('interest_rate')} IS NULL"),
        ("null_issue_date", "issue_date IS NULL"),
        ("balance_above_principal", f"{num('balance')} > {num('principal_amount')}"),
        ("noncanonical_loan_status", f"loan_status NOT IN ({_CANON_LOAN})"),
    ],
}

_KEYS = {"branches": "branch_id", "customers": "cust_id", "transactions": "transaction_id",
         "loans": "loan_id"}


def dirty_rates() -> str:
    parts = []
    for entity, issues in DIRTY_ISSUES.items():
        for issue, cond in issues:
            affected = (f"count(*) - count(DISTINCT {_KEYS[entity]}) "
                        f"- max(CASE WHEN {_KEYS[entity]} IS NULL THEN 1 ELSE 0 END)"
                        if issue == "duplicate_rows"
                        else count_if(cond))
            parts.append(
                f"SELECT {q(entity)} AS entity, {q(issue)} AS issue, CAST({affected} AS BIGINT) AS affected_rows, "
                f"count(*) AS total_rows FROM bronze_{entity}")
    union = "\nUNION ALL\n".join(parts)
    return (f"SELECT entity, issue, affected_rows, total_rows, {pct('affected_rows', 'total_rows')} AS rate_pct "
            f"FROM ({union}) r")


# --------------------------------------------------------------------------
# the registry
# --------------------------------------------------------------------------

ALL = ("branches", "customers", "transactions", "loans")


SILVER_CHECKS: dict[str, list[tuple[str, str]]] = {
    "branches": [
        ("noncanonical_branch_type", f"branch_type NOT IN ({_CANON_TYPES})"),
        ("null_no_of_staff", "no_of_staff IS NULL"),
        ("manager_leading_space", "branch_manager LIKE ' %'"),
    ],
    "customers": [
        ("noncanonical_gender", f"gender NOT IN ({_CANON_GENDER})"),
        ("noncanonical_kyc_status", f"kyc_status NOT IN ({_CANON_KYC})"),
        ("null_annual_income", "annual_income IS NULL"),
    ],
    "transactions": [
        ("noncanonical_payment_channel", f"payment_channel NOT IN ({_CANON_CHANNEL})"),
        ("noncanonical_currency", "currency <> 'GBP'"),
        ("negative_balance", "balance_after_transaction < 0"),
    ],
    "loans": [
        ("noncanonical_loan_status", f"loan_status NOT IN ({_CANON_LOAN})"),
        ("null_interest_rate", "interest_rate IS NULL"),
        ("balance_above_principal", "balance > principal_amount"),
    ],
}


def check_summary() -> str:
    parts = [
        f"SELECT {q(e)} AS entity, {q(name)} AS \"check\", CAST({count_if(cond)} AS BIGINT) AS failing_rows, "
        f"count(*) AS total_rows FROM silver_{e}"
        for e, checks in SILVER_CHECKS.items() for name, cond in checks
    ]
    return "\nUNION ALL\n".join(parts)


def rule_effect(table: str, column: str, cleaned: str) -> str:
    return (f"SELECT {column} AS {column}_raw, {cleaned} AS {column}, count(*) AS count "
            f"FROM {table} GROUP BY ALL")


def rule_sql() -> dict[str, str]:
    s = with_layers
    std = {
        "branch_type": ("branches", vocab.BRANCH_TYPE_MAP),
        "gender": ("customers", vocab.GENDER_MAP),
        "kyc_status": ("customers", vocab.KYC_STATUS_MAP),
        "payment_channel": ("transactions", vocab.PAYMENT_CHANNEL_MAP),
        "transaction_status": ("transactions", vocab.TRANSACTION_STATUS_MAP),
        "currency": ("transactions", vocab.CURRENCY_MAP),
        "loan_status": ("loans", vocab.LOAN_STATUS_MAP),
    }
    out = {
        f"rule_standardise_{c}": s(rule_effect(f"bronze_{e}", c, lookup(c, m)), bronze=(e,))
        for c, (e, m) in std.items()
    }
    out.update({
        "rule_keep_first_transactions": s(
            "SELECT transaction_id, balance_after_transaction, branch_id, payment_channel FROM "
            + first_by_key("bronze_transactions", "transaction_id", "transactions") + " t",
            bronze=("transactions",)),
        "rule_strip_branch_manager": s(rule_effect("bronze_branches", "branch_manager", strip("branch_manager")),
                                       bronze=("branches",)),
        "rule_strip_email": s(rule_effect("bronze_customers", "email", strip("email")), bronze=("customers",)),
        "rule_to_number_income": s(rule_effect("bronze_customers", "annual_income", num("annual_income")),
                                   bronze=("customers",)),
        "rule_to_number_balance": s(
            rule_effect("bronze_transactions", "balance_after_transaction", num("balance_after_transaction")),
            bronze=("transactions",)),
        "rule_rate_range": s(rule_effect(
            "bronze_loans", "interest_rate",
            f"CASE WHEN {num('interest_rate')} < 0.03 OR {num('interest_rate')} > 0.30 THEN NULL "
            f"ELSE {num('interest_rate')} END"), bronze=("loans",)),
        "rule_negative_balance": s(rule_effect(
            "bronze_transactions", "balance_after_transaction",
            f"CASE WHEN {num('balance_after_transaction')} < 0 THEN NULL "
            f"ELSE {num('balance_after_transaction')} END"), bronze=("transactions",)),
        "rule_balance_above_principal": s(
            "SELECT principal_amount AS principal_amount_raw, balance AS balance_raw, "
            f"CASE WHEN {num('balance')} > {num('principal_amount')} THEN NULL ELSE {num('balance')} END "
            "AS balance, count(*) AS count FROM bronze_loans GROUP BY ALL",
            bronze=("loans",)),
        "rule_issue_date_required": s(
            "SELECT issue_date IS NOT NULL AS kept, count(*) AS count FROM bronze_loans GROUP BY ALL",
            bronze=("loans",)),
        "rule_median_values": s(
            "SELECT (SELECT median(no_of_staff) FROM branches_first) AS median_no_of_staff, "
            "(SELECT median(annual_income) FROM customers_first) AS median_annual_income",
            silver=("branches", "customers")),
        "rule_reject_post_codes": s(
            f"SELECT post_code, {not_listed('post_code', vocab.INVALID_POSTCODES)} AS kept, count(*) AS count "
            "FROM bronze_customers GROUP BY ALL", bronze=("customers",)),
    })
    return out


def oracle_sql() -> dict[str, str]:
    s = with_layers
    out = {
        # silver jobs
        "silver_branches": s("SELECT * FROM silver_branches", silver=("branches",)),
        "silver_customers": s("SELECT * FROM silver_customers", silver=("customers",)),
        "silver_transactions": s("SELECT * FROM silver_transactions", silver=("transactions",)),
        "silver_loans": s("SELECT * FROM silver_loans", silver=("loans",)),
        # marts
        "gold_branch_performance": s(BRANCH_PERFORMANCE + "ORDER BY total_transactions DESC, branch_id",
                                     silver=("branches", "transactions")),
        "gold_customer_segments": s(CUSTOMER_SEGMENTS, silver=("customers",)),
        "gold_loan_performance": s(loan_performance_sql(2, 2), silver=("loans",)),
        # business queries
        "top_branches": s(BRANCH_PERFORMANCE + "ORDER BY total_transactions DESC, branch_id LIMIT 10",
                          silver=("branches", "transactions")),
        "city_volumes": s(CITY_VOLUMES, silver=("branches", "transactions")),
        "channel_mix": s(CHANNEL_MIX, silver=("transactions",)),
        "customer_segments": s(CUSTOMER_SEGMENTS, silver=("customers",)),
        "loan_performance": s(loan_performance_sql(4, 0), silver=("loans",)),
        "default_rates": s(DEFAULT_RATES, silver=("loans",)),
        # bronze checks
        "vb_row_counts": s(row_counts("bronze"), bronze=ALL),
        "vb_branch_type_counts": s(value_counts("bronze_branches", "branch_type"), bronze=("branches",)),
        "vb_top_post_codes": s(value_counts("bronze_branches", "post_code", limit=20), bronze=("branches",)),
        "vb_payment_channel_counts": s(value_counts("bronze_transactions", "payment_channel"),
                                       bronze=("transactions",)),
        "vb_transaction_nulls": s(
            # a long list of the cells that are there, then one row of it
            ", cells AS (SELECT unnest(['customer', 'account', 'branch']) AS cell, "
            "unnest([customer_id, account_number, branch_id]) AS held FROM bronze_transactions), "
            "tally AS (SELECT cell, count(*) AS n, count(*) FILTER (WHERE held IS NULL) AS gone FROM cells GROUP BY cell) "
            "SELECT max(n) AS total_rows, max(n - gone) FILTER (WHERE cell = 'customer') AS non_null_customer_id, "
            + ", ".join(f"max(gone) FILTER (WHERE cell = '{c}') AS null_{c}_{x}"
                        for c, x in (("customer", "id"), ("account", "number"), ("branch", "id"))) + " FROM tally",
            bronze=("transactions",)),
        "vb_manager_leading_space": s(
            "SELECT branch_id, branch_manager FROM bronze_branches WHERE starts_with(branch_manager, ' ') "
            f"ORDER BY branch_id, {arrival_order('branches')} LIMIT 5", bronze=("branches",)),
        **{f"vb_peek_{e}": s(f"SELECT {', '.join(c for c, _ in FEEDS[e].columns)} FROM bronze_{e} "
                             f"ORDER BY {arrival_order(e)} LIMIT 10", bronze=(e,)) for e in ALL},
        "vb_null_staff_sample": s("SELECT no_of_staff FROM bronze_branches WHERE no_of_staff IS NULL LIMIT 5",
                                  bronze=("branches",)),
        "vb_invalid_rate_counts": s(
            value_counts("bronze_loans", "interest_rate",
                         where=f"{num('interest_rate')} < 0.03 OR {num('interest_rate')} > 0.30",
                         column_expr=num("interest_rate")),
            bronze=("loans",)),
        "vb_dirty_rates": s(dirty_rates(), bronze=ALL),
        # silver checks
        "vs_row_counts": s(row_counts("silver"), silver=ALL),
        "vs_branch_type_counts": s(value_counts("silver_branches", "branch_type"), silver=("branches",)),
        "vs_null_staff_count": s(scalar("silver_branches", "no_of_staff IS NULL", "null_staff_count"),
                                 silver=("branches",)),
        "vs_manager_leading_space": s(
            "SELECT branch_manager FROM silver_branches WHERE ord(branch_manager) = 32",
            silver=("branches",)),
        "vs_gender_counts": s(value_counts("silver_customers", "gender"), silver=("customers",)),
        "vs_kyc_status_counts": s(value_counts("silver_customers", "kyc_status"), silver=("customers",)),
        "vs_null_income_count": s(scalar("silver_customers", "annual_income IS NULL", "null_income_count"),
                                  silver=("customers",)),
        "vs_payment_channel_counts": s(value_counts("silver_transactions", "payment_channel"),
                                       silver=("transactions",)),
        "vs_currency_counts": s(value_counts("silver_transactions", "currency"), silver=("transactions",)),
        "vs_negative_balance_count": s(
            scalar("silver_transactions", "balance_after_transaction < 0", "negative_balance_count"),
            silver=("transactions",)),
        "vs_orphaned_split": s(value_counts("silver_transactions", "orphaned"), silver=("transactions",)),
        "vs_loan_status_counts": s(value_counts("silver_loans", "loan_status"), silver=("loans",)),
        "vs_null_rate_count": s(scalar("silver_loans", "interest_rate IS NULL", "null_rate_count"),
                                silver=("loans",)),
        "vs_impossible_balance_count": s(
            scalar("silver_loans", "balance > principal_amount", "impossible_balance_count"),
            silver=("loans",)),
        "vs_check_summary": s(check_summary(), silver=ALL),
        **{f"{short}_frequency_profiles": s(" UNION ALL ".join(
            f"SELECT '{e}' AS entity, '{c}' AS column, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows FROM {layer}_{e} GROUP BY {c}"
            for e, cs in PROFILED.items() for c in cs), **{layer: ALL}) for short, layer in (("vb", "bronze"), ("vs", "silver"))},
        "vs_reconciliation": s("\nUNION ALL\n".join(
            f"SELECT {q(e)} AS entity, b.n AS bronze_rows, s.n AS silver_rows, b.n - s.n AS removed_rows "
            f"FROM (SELECT count(*) AS n FROM bronze_{e}) b, (SELECT count(*) AS n FROM silver_{e}) s"
            for e in ALL), silver=ALL),
    }
    out.update(rule_sql())
    out.update({f"csv_bronze_{e}": s(f"SELECT {', '.join(c for c, _ in FEEDS[e].columns)} FROM bronze_{e}", bronze=(e,)) for e in ALL})
    out.update({f"lake_silver_{e}": out[f"silver_{e}"] for e in ALL})
    damaged = {e: f"count(CASE WHEN {FEEDS[e].damaged_when} THEN 1 END)" for e in ALL}
    out["csv_corrupt_rows"] = " UNION ALL ".join(
        f"SELECT '{e}' AS entity, count(*) + {damaged[e]} AS total_rows, {damaged[e]} AS corrupt_rows FROM {arriving(e)} src" for e in ALL)
    out["lake_quarantine_counts"] = " UNION ALL ".join(
        f"SELECT '{e}' AS entity, count(*) AS landed, {damaged[e]} AS set_aside, count(*) AS good_rows, {damaged[e]} AS malformed_rows "
        f"FROM {arriving(e)} src" for e in ALL)
    out["lake_quarantine_loans"] = f"SELECT replace(line, chr(10), ' ') AS raw_text FROM ({malformed_lines('loans')}) m"
    out["lake_after_broken_write"] = out["silver_loans"]
    out["lake_earlier_version"] = s(
        "SELECT CAST(1 AS BIGINT) AS version, count(*) AS n_rows FROM silver_loans UNION ALL "
        "SELECT CAST(2 AS BIGINT), count(*) FROM silver_loans WHERE default_flag", silver=("loans",))
    out["catalog_tables"] = s(
        "SELECT 'bronze' AS layer, loan_status, count(*) AS n_rows FROM bronze_loans GROUP BY loan_status UNION ALL "
        "SELECT 'silver', loan_status, count(*) FROM silver_loans GROUP BY loan_status", bronze=("loans",), silver=("loans",))
    out.update({f"grown_silver_{e}": out[f"silver_{e}"] for e in ALL})
    out["grown_loan_mart"], out["grown_customer_mart"] = out["gold_loan_performance"], out["gold_customer_segments"]
    out["grown_branch_mart"] = out["gold_branch_performance"]
    out["lake_rows_written"] = s(" UNION ALL ".join(
        f"SELECT '{e}' AS entity, count(*) AS rows_written, count(*) AS rows_found FROM silver_{e}" for e in ALL), silver=ALL)
    out["lake_branch_mart"] = out["gold_branch_performance"]
    out["lake_export_loans"] = out["gold_loan_performance"]
    return out
