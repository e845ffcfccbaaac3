"""Bronze feeds derived from the TPC-H style test tables.

The test tables (``supplier customer lineitem orders``) are clean and typed;
the pipeline's input is dirty CSV text.  Each feed below is a deterministic
mapping of one table onto one raw entity, written as portable SQL
expressions that Spark (``selectExpr``) and DuckDB evaluate identically, so
the library and the SQL oracle start from the same text:

=============  ==========  ===================================================
entity         table       dirt carried (rates at the source pipeline's level)
=============  ==========  ===================================================
branches       supplier    2% key copies (copy 2 arrives later), bad / null
                           post codes, padded managers, null staff, type
                           spellings, unknown / null types
customers      customer    5% key copies, gender / KYC spellings, padded
                           e-mails, null and unparseable incomes, bad post
                           codes (on some first copies)
transactions   lineitem    natural duplicate keys (order, line), null
                           customer / account / branch, unknown branches,
                           negative / zero / unparseable balances, channel,
                           status and currency spellings
loans          orders      6% key copies, out-of-range and null rates, rate
                           boundaries, status spellings, null issue dates,
                           balance above / equal to principal
=============  ==========  ===================================================

Every row of the source table is used: dirt is a function of the row's own
keys, never a filter.  ``_arrival`` is the feed order (copy number, then the
source key; for lineitem the non-key columns, so ties are identical rows).
List lookups are written per dialect (a literal array in Spark, a list in
DuckDB); everything else is the same text on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart import vocab
from bankmart.functions.cleaning import null_tokens
from bankmart.schemas import ARRIVAL, BRONZE_COLUMNS


def sql_str(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def spark_pick(index_sql: str, values: list[str]) -> str:
    """``values[index]`` (0-based) in Spark SQL: a folded literal array."""
    return f"element_at(array({', '.join(sql_str(v) for v in values)}), cast({index_sql} as int) + 1)"


def duckdb_pick(index_sql: str, values: list[str]) -> str:
    """``values[index]`` (0-based) in DuckDB SQL (1-based list index)."""
    return f"([{', '.join(sql_str(v) for v in values)}])[{index_sql} + 1]"


pick = spark_pick  # rebound per dialect by ``_specs``


def idx(key: str, div: int, mod: int) -> str:
    """Portable ``(key div div) % mod`` for non-negative keys."""
    return f"(cast(floor({key} / {div}) as bigint) % {mod})"


# Labels of the derived feeds: invented, compared with nothing.
CITIES = ["Alderwick", "Brindlemoor", "Castorby", "Dunmarrow", "Elderholt",
          "Farrowgate", "Greywater", "Hollinford", "Inverdale", "Juniper Cross"]
PROVINCES = ["North Reach", "East Fold", "Southmark", "Westering"]
FIRST_NAMES = ["Aldo", "Brynn", "Corin", "Dara", "Ewan", "Fenna", "Gil", "Hesper"]
LAST_NAMES = ["Ashdown", "Birkett", "Calloway", "Drummore", "Ellery", "Fenwick"]
MARITAL = ["never married", "wed", "formerly wed", "partnered"]
EMPLOYMENT = ["salaried", "freelance", "not working"]
TX_TYPES = ["till purchase", "bill", "recurring order", "incoming wire", "outgoing wire",
            "note machine", "counter deposit", "payroll", "reversal"]
LOAN_TYPES = ["house", "vehicle", "tuition", "bridge"]
OUT_OF_RANGE_RATES = ["0.0125", "0.75", "12", "-0.02"]


def _variants(mapping: dict[str, str], canonical: str) -> list[str]:
    return [k for k, v in mapping.items() if v == canonical]


@dataclass(frozen=True)
class FeedSpec:
    entity: str
    table: str
    columns: list[tuple[str, str]]
    arrival: list[str]
    damaged_when: str  # rows meeting this arrive once more, with a surplus cell
    cut_when: str  # or, meeting this too, with the first three cells of the line alone
    copies_when: str | None = None  # rows meeting this arrive twice


def _specs(pick) -> dict[str, FeedSpec]:
    """The four feed specs, with list lookups written by ``pick``."""
    def _post_code(key: str, nation: str) -> str:
        return f"'Z' || cast({nation} as string) || '-' || cast({key} % 900 + 100 as string)"


    _BR_MANAGER = "'Manager ' || cast(s_suppkey as string)"
    BRANCHES = FeedSpec(
        entity="branches",
        table="supplier",
        damaged_when="s_suppkey % 8 = 3",
        cut_when="s_suppkey % 16 = 3",
        copies_when="s_suppkey % 50 = 1",
        arrival=["copy_no", "s_suppkey"],
        columns=[
            ("branch_id", "'BR' || cast(s_suppkey as string)"),
            ("branch_name", "replace(s_name, 'Supplier#', 'Branch ')"),
            ("branch_city", pick("s_nationkey % 10", CITIES)),
            ("branch_province", pick("s_nationkey % 4", PROVINCES)),
            ("post_code",
             "CASE WHEN s_suppkey % 41 = 5 THEN NULL "
             "WHEN s_suppkey % 33 = 8 OR (s_suppkey % 50 = 1 AND copy_no = "
             "CASE WHEN s_suppkey % 100 = 1 THEN 1 ELSE 2 END) "
             f"THEN {pick(idx('s_suppkey', 33, 6), vocab.INVALID_POSTCODES)} "
             f"ELSE {_post_code('s_suppkey', 's_nationkey')} END"),
            ("opening_date", "cast(date '1990-01-01' + cast(s_suppkey * 37 % 12000 as int) as string)"),
            ("branch_manager",
             f"CASE WHEN s_suppkey % 20 = 3 THEN ' ' || {_BR_MANAGER} "
             f"WHEN s_suppkey % 20 = 13 THEN {_BR_MANAGER} || '  ' "
             f"WHEN s_suppkey % 40 = 7 THEN chr(9) || {_BR_MANAGER} || chr(10) "
             f"ELSE {_BR_MANAGER} END"),
            ("no_of_staff",
             "CASE WHEN s_suppkey % 10 = 0 THEN NULL "
             "ELSE cast(cast(8 + (s_suppkey * 7) % 45 as decimal(10,1)) as string) END"),
            ("branch_type",
             "CASE WHEN s_suppkey % 89 = 17 THEN NULL "
             "WHEN s_suppkey % 97 = 13 THEN 'Mobile Van' "
             f"WHEN s_suppkey % 10 = 4 THEN {pick(idx('s_suppkey', 10, 36), list(vocab.BRANCH_TYPE_MAP))} "
             f"ELSE {pick('s_suppkey % 7', vocab.canonical_values(vocab.BRANCH_TYPE_MAP))} END"),
        ],
    )

    _INCOME = "(20000 + cast(floor((c_acctbal + 1000) * 89) as bigint))"
    _INCOME_TXT = f"cast(cast({_INCOME} as decimal(12,1)) as string)"
    _EMAIL = "'cust' || cast(c_custkey as string) || '@example.co.uk'"
    _KYC = pick(idx("c_custkey", 9, 2), ["Verified", "Pending"])
    CUSTOMERS = FeedSpec(
        entity="customers",
        table="customer",
        damaged_when="c_custkey % 29 = 2",
        cut_when="c_custkey % 58 = 2",
        copies_when="c_custkey % 20 = 7",
        arrival=["copy_no", "c_custkey"],
        columns=[
            ("cust_id", "'CUST' || cast(c_custkey as string)"),
            ("first_name", pick("c_custkey % 8", FIRST_NAMES)),
            ("last_name", pick("c_nationkey % 6", LAST_NAMES)),
            ("date_of_birth", "cast(date '1940-01-01' + cast(c_custkey * 131 % 25000 as int) as string)"),
            ("gender",
             "CASE WHEN c_custkey % 101 = 50 THEN NULL "
             f"WHEN c_custkey % 20 = 1 THEN {pick(idx('c_custkey', 20, 12), list(vocab.GENDER_MAP))} "
             f"ELSE {pick('c_custkey % 3', ['Male', 'Female', 'Other'])} END"),
            ("marital_status", pick("c_custkey % 4", MARITAL)),
            ("employment_status", pick(idx("c_custkey", 3, 3), EMPLOYMENT)),
            ("kyc_status",
             f"CASE WHEN c_custkey % 10 = 3 THEN {pick(idx('c_custkey', 10, 8), list(vocab.KYC_STATUS_MAP))} "
             f"WHEN copy_no = 2 THEN upper({_KYC}) ELSE {_KYC} END"),
            ("risk_rating",
             "CASE WHEN c_acctbal < 2000 THEN 'High' WHEN c_acctbal < 6000 THEN 'Medium' ELSE 'Low' END"),
            ("address", f"cast(c_custkey % 300 + 1 as string) || ' High Street' || CASE WHEN c_custkey % 13 = 4 THEN chr(10) || 'Flat \"2\"' "
             f"WHEN c_custkey % 13 = 9 THEN chr(10) || chr(10) || 'Rear, ' ELSE ', ' END || {pick('c_nationkey % 10', CITIES)}"),
            ("city", pick("c_nationkey % 10", CITIES)),
            ("province", pick("c_nationkey % 4", PROVINCES)),
            ("post_code",
             "CASE WHEN c_custkey % 47 = 2 THEN NULL "
             "WHEN c_custkey % 33 = 5 OR (c_custkey % 40 = 7 AND copy_no = 1) "
             f"THEN {pick(idx('c_custkey', 33, 6), vocab.INVALID_POSTCODES)} "
             f"ELSE {_post_code('c_custkey', 'c_nationkey')} END"),
            ("phone_number", "'07' || cast(700000000 + c_custkey as string)"),
            ("email",
             f"CASE WHEN c_custkey % 25 = 4 THEN ' ' || {_EMAIL} "
             f"WHEN c_custkey % 25 = 9 THEN {_EMAIL} || '  ' "
             f"WHEN c_custkey % 50 = 14 THEN chr(9) || {_EMAIL} ELSE {_EMAIL} END"),
            ("annual_income",
             "CASE WHEN c_custkey % 14 = 0 THEN NULL "
             "WHEN c_custkey % 97 = 3 THEN 'n/a' "
             "WHEN c_custkey % 97 = 5 THEN 'NaN' "
             "WHEN c_custkey % 97 = 7 THEN '12d' "
             f"WHEN c_custkey % 97 = 11 THEN ' ' || {_INCOME_TXT} || ' ' "
             "WHEN c_custkey % 97 = 13 THEN 'abc' "
             "WHEN c_custkey % 97 = 17 THEN '4.5e4' "
             "WHEN c_custkey % 997 = 29 THEN 'Infinity' "
             f"WHEN c_custkey % 11 = 6 THEN {_INCOME_TXT} || '05' "
             f"WHEN copy_no = 2 THEN cast(cast({_INCOME} + 1000 as decimal(12,1)) as string) "
             f"ELSE {_INCOME_TXT} END"),
            ("occupation", "c_mktsegment"),
        ],
    )

    _PRICE = "cast(cast(l_extendedprice as decimal(12,2)) as string)"
    _ORPHAN = "(l_orderkey + l_linenumber) % 20 = 0"
    TRANSACTIONS = FeedSpec(
        entity="transactions",
        table="lineitem",
        damaged_when="l_partkey % 61 = 8",
        cut_when="l_partkey % 122 = 8",
        copies_when=None,
        # order within a key: the key columns (order, line) are equal there,
        # so the remaining columns make the order total (ties are equal rows)
        arrival=["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
        columns=[
            ("transaction_id", "'TXN' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string)"),
            ("account_number",
             f"CASE WHEN {_ORPHAN} THEN NULL "
             "ELSE cast(cast(10000000 + l_orderkey as decimal(12,1)) as string) END"),
            ("customer_id", f"CASE WHEN {_ORPHAN} THEN NULL ELSE 'CUST' || cast(l_partkey as string) END"),
            ("branch_id",
             "CASE WHEN l_partkey % 20 = 3 THEN NULL "
             "WHEN l_partkey % 97 = 1 THEN 'BR' || cast(l_suppkey + 900000 as string) "
             "ELSE 'BR' || cast(l_suppkey as string) END"),
            ("transaction_date", "cast(cast(l_shipdate as date) as string)"),
            ("transaction_type", pick("l_partkey % 9", TX_TYPES) + " || CASE WHEN l_partkey % 17 = 3 THEN ',' || chr(10) || 'see \"note\"' ELSE '' END"),
            ("balance_after_transaction",
             "CASE WHEN l_partkey % 211 = 5 THEN 'N/A' "
             "WHEN l_partkey % 211 = 9 THEN 'abc' "
             f"WHEN l_partkey % 40 = 7 THEN '-' || {_PRICE} "
             "WHEN l_partkey % 40 = 27 THEN '0.0' "
             "WHEN l_orderkey % 9973 = 11 THEN 'inf' "
             f"WHEN l_partkey % 13 = 4 THEN {_PRICE} || '25' "
             f"WHEN l_partkey % 13 = 6 THEN {_PRICE} || '5' "
             f"ELSE {_PRICE} END"),
            ("currency",
             "CASE WHEN l_orderkey % 997 = 5 THEN 'EUR' "
             f"WHEN l_orderkey % 100 < 7 THEN {pick('l_orderkey % 4', list(vocab.CURRENCY_MAP))} "
             "ELSE 'GBP' END"),
            ("payment_channel",
             "CASE WHEN l_orderkey % 503 = 11 THEN NULL "
             "WHEN l_orderkey % 499 = 7 THEN 'Carrier Pigeon' "
             f"WHEN l_orderkey % 11 = 2 THEN {pick('(l_orderkey + l_partkey) % 51', list(vocab.PAYMENT_CHANNEL_MAP))} "
             f"ELSE {pick('l_partkey % 12', vocab.canonical_values(vocab.PAYMENT_CHANNEL_MAP))} END"),
            ("merchant_category_code", "cast(5000 + l_partkey % 900 as string)"),
            ("transaction_status",
             f"CASE WHEN l_orderkey % 25 IN (1, 2) THEN {pick('l_partkey % 9', list(vocab.TRANSACTION_STATUS_MAP))} "
             "WHEN l_returnflag = 'R' THEN 'Failed' "
             "WHEN l_returnflag = 'A' THEN 'Completed' ELSE 'Pending' END"),
            ("fraud_flag", "CASE WHEN l_discount > 0.085 THEN 'True' ELSE 'False' END"),
        ],
    )

    _PRINCIPAL = "cast(floor(o_totalprice) as bigint)"
    LOANS = FeedSpec(
        entity="loans",
        table="orders",
        damaged_when="o_orderkey % 43 = 7",
        cut_when="o_orderkey % 86 = 7",
        copies_when="o_orderkey % 50 IN (3, 4, 5)",
        arrival=["copy_no", "o_orderkey"],
        columns=[
            ("loan_id", "'LOAN' || cast(o_orderkey as string)"),
            ("customer_id", "'CUST' || cast(o_custkey as string)"),
            ("loan_type", pick("o_orderkey % 4", LOAN_TYPES) + " || CASE WHEN o_orderkey % 31 = 6 THEN chr(10) || 'second charge' ELSE '' END"),
            ("principal_amount", f"cast({_PRINCIPAL} as string)"),
            ("interest_rate",
             "CASE WHEN o_orderkey % 20 = 9 THEN NULL "
             "WHEN o_orderkey % 997 = 1 THEN '0.0299' "
             "WHEN o_orderkey % 997 = 2 THEN '0.3001' "
             "WHEN o_orderkey % 20 = 13 OR (copy_no = 2 AND o_orderkey % 50 = 4) "
             f"THEN {pick(idx('o_orderkey', 20, 4), OUT_OF_RANGE_RATES)} "
             "ELSE cast(cast(0.03 + (o_orderkey % 2701) * 0.0001 as decimal(6,4)) as string) END"),
            ("term_months", "cast(12 * (1 + o_orderkey % 40) as string)"),
            ("monthly_payment",
             "CASE WHEN o_orderkey % 4999 = 17 THEN 'inf' ELSE "
             "cast(cast(floor(o_totalprice / 100) as decimal(12,0)) "
             "+ cast(o_orderkey % 100 as decimal(4,0)) * 0.01 as string) END"),
            ("loan_status",
             "CASE WHEN o_orderkey % 991 = 3 THEN 'Written Off' "
             "WHEN o_orderkey % 25 IN (3, 8) THEN CASE WHEN o_orderstatus = 'F' "
             f"THEN {pick(idx('o_orderkey', 25, 5), _variants(vocab.LOAN_STATUS_MAP, 'Paid off'))} "
             f"ELSE {pick(idx('o_orderkey', 25, 5), _variants(vocab.LOAN_STATUS_MAP, 'Active'))} END "
             "WHEN o_orderstatus = 'F' THEN 'Paid off' ELSE 'Active' END"),
            ("default_flag",
             "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0 THEN 'True' ELSE 'False' END"),
            ("issue_date",
             "CASE WHEN o_orderkey % 20 = 11 THEN NULL ELSE cast(cast(o_orderdate as date) as string) END"),
            ("balance",
             f"CASE WHEN o_orderkey % 25 = 4 THEN cast({_PRINCIPAL} + 1000 + o_orderkey % 1000 as string) "
             f"WHEN o_orderkey % 97 = 50 THEN cast({_PRINCIPAL} as string) "
             "WHEN copy_no = 2 THEN cast(cast(floor(o_totalprice * 0.5) as bigint) as string) "
             "ELSE cast(cast(floor(o_totalprice * (o_orderkey % 90 + 5) / 100) as bigint) as string) END"),
        ],
    )

    return {s.entity: s for s in (BRANCHES, CUSTOMERS, TRANSACTIONS, LOANS)}


FEEDS: dict[str, FeedSpec] = _specs(spark_pick)
FEEDS_DUCKDB: dict[str, FeedSpec] = _specs(duckdb_pick)

for _spec in [*FEEDS.values(), *FEEDS_DUCKDB.values()]:
    assert [c for c, _ in _spec.columns] == BRONZE_COLUMNS[_spec.entity], _spec.entity


def feed(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The raw (all-STRING) feed of ``entity`` derived from the test tables.

    Same shape as ``sources.bronze.read_bronze``: the entity's CSV columns
    plus ``_arrival``, with missing-value spellings already read as null.
    """
    text = raw_feed(spark, sf_dir, entity)
    return text.select(*[null_tokens(c, vocab.NULL_TOKENS).alias(c) for c in BRONZE_COLUMNS[entity]], ARRIVAL)


def table_of(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{FEEDS[entity].table}.parquet")


def raw_feed(spark: SparkSession, sf_dir: str, entity: str, damaged: bool = False, parts: int | None = None) -> DataFrame:
    """The feed as it stands in a raw file, missing-value spellings included; with
    ``damaged``, columns ``_damaged`` and ``_cut`` tell rows that arrive once more, malformed;
    with ``parts``, in arrival order, dealt to so many ranges (as rows of the table, which
    are a third of their text)."""
    spec = FEEDS[entity]
    src = table_of(spark, sf_dir, entity)
    if spec.copies_when:
        copies = F.when(F.expr(spec.copies_when), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        src = src.withColumn("copy_no", F.explode(copies))
    else:
        src = src.withColumn("copy_no", F.lit(1))
    if parts:
        src = src.repartitionByRange(parts, *spec.arrival).sortWithinPartitions(*spec.arrival)
    arrival = F.struct(*[F.expr(e).alias(f"a{i}") for i, e in enumerate(spec.arrival)])
    more = [F.expr(spec.damaged_when).alias("_damaged"), F.expr(spec.cut_when).alias("_cut")] if damaged else []
    return src.select(*[F.expr(e).alias(c) for c, e in spec.columns], arrival.alias(ARRIVAL), *more)


class Feeds(dict):
    """The four derived feeds, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark = spark
        self._dir = sf_dir

    def __missing__(self, entity: str) -> DataFrame:
        if entity not in FEEDS:
            raise KeyError(entity)
        df = feed(self._spark, self._dir, entity)
        self[entity] = df
        return df

    def __iter__(self):
        return iter(FEEDS)

    def __len__(self):
        return len(FEEDS)

    def keys(self):
        return list(FEEDS)

    def items(self):
        return [(e, self[e]) for e in FEEDS]

    def values(self):
        return [self[e] for e in FEEDS]


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four feeds of ``sf_dir`` (lazily built per entity)."""
    return Feeds(spark, sf_dir)
