"""Row-local cleaning rules on hand-written values (clean, dirty, unknown, null, boundary)."""

from __future__ import annotations

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from bankmart import vocab
from bankmart.functions import cleaning as C
from bankmart.operators.filters import drop_missing, reject_values


def _strings(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)],
                                 StructType([StructField("i", IntegerType()), StructField("x", StringType())]))


def _apply(spark, values, col):
    df = _strings(spark, values)
    return [r[0] for r in df.orderBy("i").select(col.alias("y")).collect()]


def test_standardise_known_unknown_null_case(spark):
    out = _apply(spark, ["Completed", "SUCCESS", "Weird", None, "success"],
                 C.standardise("x", vocab.TRANSACTION_STATUS_MAP))
    assert out == ["Completed", "Completed", "Weird", None, "success"]


@pytest.mark.parametrize("name,mapping", [
    ("branch_type", vocab.BRANCH_TYPE_MAP), ("gender", vocab.GENDER_MAP),
    ("kyc", vocab.KYC_STATUS_MAP), ("currency", vocab.CURRENCY_MAP),
    ("channel", vocab.PAYMENT_CHANNEL_MAP), ("status", vocab.TRANSACTION_STATUS_MAP),
    ("loan_status", vocab.LOAN_STATUS_MAP),
])
def test_standardise_is_idempotent(spark, name, mapping):
    values = list(mapping) + vocab.canonical_values(mapping)
    once = _apply(spark, values, C.standardise("x", mapping))
    twice = _apply(spark, values, C.standardise(C.standardise("x", mapping), mapping))
    assert once == twice
    assert set(once) <= set(vocab.canonical_values(mapping))


def test_map_sizes():
    assert len(vocab.BRANCH_TYPE_MAP) == 36 and len(set(vocab.BRANCH_TYPE_MAP.values())) == 7
    assert len(vocab.GENDER_MAP) == 12 and len(set(vocab.GENDER_MAP.values())) == 3
    assert len(vocab.KYC_STATUS_MAP) == 8 and len(set(vocab.KYC_STATUS_MAP.values())) == 2
    assert len(vocab.PAYMENT_CHANNEL_MAP) == 51 and len(set(vocab.PAYMENT_CHANNEL_MAP.values())) == 12
    assert len(vocab.TRANSACTION_STATUS_MAP) == 9 and len(set(vocab.TRANSACTION_STATUS_MAP.values())) == 2
    assert len(vocab.LOAN_STATUS_MAP) == 10 and len(set(vocab.LOAN_STATUS_MAP.values())) == 2
    assert len(vocab.CURRENCY_MAP) == 4 and set(vocab.CURRENCY_MAP.values()) == {"GBP"}


def test_strip_whitespace_like_python(spark):
    values = [" Ann", "Ann ", "\tAnn\n", None, "　Ann ", "A n n", ""]
    out = _apply(spark, values, C.strip_ws("x"))
    assert out == [v.strip() if v is not None else None for v in values]


def test_to_number_matches_pandas_coercion(spark):
    values = ["1e3", " 12 ", "12d", "abc", "", "NaN", "NA", "12f", "-0.5", ".5", "5.", "+7", "1_000", "0x1p3"]
    out = _apply(spark, values, C.to_number("x"))
    assert out == [1000.0, 12.0, None, None, None, None, None, None, -0.5, 0.5, 5.0, 7.0, None, None]


def test_to_number_infinity(spark):
    out = _apply(spark, ["inf", "-inf", "Infinity"], C.to_number("x"))
    assert out == [float("inf"), float("-inf"), float("inf")]


def test_to_bool_and_date(spark):
    assert _apply(spark, ["True", "False", "true", "x", None], C.to_bool("x")) == [True, False, True, None, None]
    import datetime as dt
    assert _apply(spark, ["2020-02-29", "2021-02-29", "junk", None], C.to_date("x")) == [
        dt.date(2020, 2, 29), None, None, None]


def test_null_tokens(spark):
    out = _apply(spark, ["NA", "N/A", "null", "", "None", "ok", "na", None],
                 C.null_tokens("x", vocab.NULL_TOKENS))
    assert out == [None, None, None, None, None, "ok", "na", None]


def test_reject_values_keeps_nulls(spark):
    df = _strings(spark, ["G1 11A", "LS1 1AB", None, "SA 1 1AA"]).withColumnRenamed("x", "post_code")
    kept = sorted(r.i for r in reject_values(df, "post_code", vocab.INVALID_POSTCODES).collect())
    assert kept == [1, 2]


def _doubles(spark, values, extra=None):
    schema = StructType([StructField("i", IntegerType()), StructField("x", DoubleType()),
                         StructField("p", DoubleType())])
    data = [(i, v, (extra[i] if extra else None)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, schema)


def _dapply(spark, values, col, extra=None):
    df = _doubles(spark, values, extra)
    return [r[0] for r in df.orderBy("i").select(col.alias("y")).collect()]


def test_rate_range_closed_interval(spark):
    out = _dapply(spark, [0.0299, 0.03, 0.30, 0.3001, None],
                  C.null_outside("x", vocab.RATE_MIN, vocab.RATE_MAX))
    assert out == [None, 0.03, 0.30, None, None]


def test_silver_rounding_is_half_even(spark):
    assert _dapply(spark, [0.125, 0.135, 0.045, 2.675], C.round_half_even("x", 2)) == [0.12, 0.14, 0.04, 2.68]


def test_negative_to_null(spark):
    assert _dapply(spark, [-0.01, 0.0, 5.0, None], C.null_if_negative("x")) == [None, 0.0, 5.0, None]


def test_balance_above_principal(spark):
    out = _dapply(spark, [10.0, 20.0, 30.0, None, 5.0], C.null_if_greater("x", "p"),
                  extra=[20.0, 20.0, 20.0, 20.0, None])
    assert out == [10.0, 20.0, None, None, 5.0]


def test_drop_missing_issue_date(spark):
    df = _strings(spark, [None, "2020-01-01"]).withColumnRenamed("x", "issue_date")
    assert [r.i for r in drop_missing(df, "issue_date").collect()] == [1]


def test_null_flags_retain_rows(spark):
    df = _strings(spark, [None, "CUST1"])
    out = df.orderBy("i").select(C.is_missing("x").alias("f")).collect()
    assert [r.f for r in out] == [True, False]
    assert df.count() == 2


def test_whitespace_set_is_pythons():
    import sys
    assert set(C.WHITESPACE_CHARS) == {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}


def test_out_of_range_numbers_do_not_fail(spark, scratch):
    from conftest import write_csv

    from bankmart.plans.silver import silver_transactions
    from bankmart.schemas import BRONZE_COLUMNS
    from bankmart.sources.bronze import read_bronze

    row = ["T1", "9e99", "C1", "BR1", "2024-01-01", "x", "inf", "GBP", "FPS", "1e12", "OK", "True"]
    path = write_csv(scratch, "t.csv", BRONZE_COLUMNS["transactions"], [row])
    r = silver_transactions(read_bronze(spark, path, "transactions")).first()
    assert r.account_number is None and r.merchant_category_code is None
    assert r.balance_after_transaction == float("inf")
