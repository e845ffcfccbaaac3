"""Silver jobs on small dirty CSV feeds: exact goldens, including which copy
wins, the median population of each job, and the mart join semantics."""

from __future__ import annotations

import datetime as dt
import os

from conftest import rows, write_csv

from bankmart.plans import analytics, gold
from bankmart.plans.silver import silver_branches, silver_customers, silver_loans, silver_transactions
from bankmart.schemas import BRONZE_COLUMNS
from bankmart.sources.bronze import read_bronze


def _branch(bid, post, staff, btype="Hub", manager="Ann Lee"):
    return [bid, f"Branch {bid}", "Leeds", "England", post, "2001-02-03", manager, staff, btype]


def test_silver_branches_golden(spark, scratch):
    lines = [
        _branch("BR001", "G1 11A", "10.0"),                 # first copy: rejected post code
        _branch("BR002", "LS1 1AB", "", "hub", " Bob  "),   # null staff, dirty type, padded manager
        _branch("BR003", "LS2 2AB", "20.0", "Mobile"),      # unknown type passes through
        _branch("BR004", None, "30.0", None),               # null post code is kept
        _branch("BR001", "LS9 9AB", "99.0"),                # later copy of BR001: ignored
        _branch("BR005", "M9-9 ZZ", "1000.0"),              # rejected, but counts in the median
    ]
    path = write_csv(scratch, "branches.csv", BRONZE_COLUMNS["branches"], lines)
    out = silver_branches(read_bronze(spark, path, "branches"))
    got = rows(out, "branch_id", "post_code", "no_of_staff", "branch_type", "branch_manager")
    # median population: BR001 (10), BR003 (20), BR004 (30), BR005 (1000) -> 25
    assert got == [
        ("BR002", "LS1 1AB", 25.0, "Hub", "Bob"),
        ("BR003", "LS2 2AB", 20.0, "Mobile", "Ann Lee"),
        ("BR004", None, 30.0, None, "Ann Lee"),
    ]
    assert out.first().opening_date == dt.date(2001, 2, 3)


def _customer(cid, post, income, gender="M", kyc="verify", email=" a@b.co "):
    return [cid, "Ann", "Lee", "1980-01-01", gender, "Single", "Employed", kyc, "Low",
            "1 High St, Leeds", "Leeds", "England", post, "0770", email, income, "Clerk"]


def test_silver_customers_golden(spark, scratch):
    lines = [
        _customer("C1", "G1 11A", "50000"),        # first copy rejected ...
        _customer("C1", "LS1 1AB", "60000.0"),     # ... so the second copy is kept
        _customer("C2", "LS1 1AB", "NA", "f"),     # income missing -> median
        _customer("C3", "LS1 1AB", "12d", "X"),    # unparseable -> median; unknown gender kept
        _customer("C4", "BS1A 1AA", "9999999"),    # rejected: not in the median population
        _customer("C5", "LS1 1AB", " 40000 "),
    ]
    path = write_csv(scratch, "customers.csv", BRONZE_COLUMNS["customers"], lines)
    out = silver_customers(read_bronze(spark, path, "customers"))
    got = rows(out, "cust_id", "annual_income", "gender", "kyc_status", "email")
    assert got == [
        ("C1", 60000.0, "Male", "Verified", "a@b.co"),
        ("C2", 50000.0, "Female", "Verified", "a@b.co"),
        ("C3", 50000.0, "X", "Verified", "a@b.co"),
        ("C5", 40000.0, "Male", "Verified", "a@b.co"),
    ]


def _txn(tid, bal, branch="BR1", cust="C1", acct="12345678.0", channel="FPS", status="OK", cur="£"):
    return [tid, acct, cust, branch, "2024-05-06", "Card Payment", bal, cur, channel, "5411", status, "False"]


def test_silver_transactions_golden(spark, scratch):
    lines = [
        _txn("T1", "50"),
        _txn("T1", "-50"),                                   # later copy ignored
        _txn("T2", "-0.01", cust=None, acct=None),           # negative -> null; orphan flags
        _txn("T3", "0", branch=None, channel="Carrier Pigeon", status="Pending", cur="GBP"),
        _txn("T4", "N/A", channel=None),
    ]
    path = write_csv(scratch, "transactions.csv", BRONZE_COLUMNS["transactions"], lines)
    out = silver_transactions(read_bronze(spark, path, "transactions"))
    got = rows(out, "transaction_id", "balance_after_transaction", "orphaned", "missing_account",
               "missing_branch", "payment_channel", "transaction_status", "currency", "account_number")
    assert got == [
        ("T1", 50.0, False, False, False, "Faster Payments (FPS)", "Completed", "GBP", 12345678),
        ("T2", None, True, True, False, "Faster Payments (FPS)", "Completed", "GBP", None),
        ("T3", 0.0, False, False, True, "Carrier Pigeon", "Pending", "GBP", 12345678),
        ("T4", None, False, False, False, None, "Completed", "GBP", 12345678),
    ]


def _loan(lid, rate, bal="1000", principal="2000", issue="2020-01-01", status="ACT"):
    return [lid, "C1", "Mortgage", principal, rate, "120", "100.125", status, "True", issue, bal]


def test_silver_loans_golden(spark, scratch):
    lines = [
        _loan("L1", "0.0299"),
        _loan("L2", "0.03", bal="2000"),            # balance == principal kept
        _loan("L3", "0.30", bal="2000.01"),         # balance > principal -> null
        _loan("L4", "0.3001", issue=None),          # no issue date -> dropped
        _loan("L5", None, principal=None),          # null principal: balance unchanged
        _loan("L6", "0.125"),
        _loan("L6", "0.2"),                         # later copy ignored
    ]
    path = write_csv(scratch, "loans.csv", BRONZE_COLUMNS["loans"], lines)
    out = silver_loans(read_bronze(spark, path, "loans"))
    got = rows(out, "loan_id", "interest_rate", "balance", "monthly_payment", "loan_status", "default_flag")
    assert got == [
        ("L1", None, 1000.0, 100.12, "Active", True),
        ("L2", 0.03, 2000.0, 100.12, "Active", True),
        ("L3", 0.3, None, 100.12, "Active", True),
        ("L5", None, 1000.0, 100.12, "Active", True),
        ("L6", 0.12, 1000.0, 100.12, "Active", True),
    ]


def test_keep_first_null_key_and_file_order(spark, scratch):
    header = BRONZE_COLUMNS["loans"]
    write_csv(os.path.join(scratch, "feed"), "part-0.csv", header, [_loan(None, "0.05"), _loan("L1", "0.06")])
    write_csv(os.path.join(scratch, "feed"), "part-1.csv", header, [_loan(None, "0.07"), _loan("L1", "0.08")])
    out = silver_loans(read_bronze(spark, os.path.join(scratch, "feed"), "loans"))
    got = rows(out, "loan_id", "interest_rate")
    # one row per key, null key included; the first file in path order wins
    assert got == [(None, 0.05), ("L1", 0.06)]


def test_mart_join_drops_null_unknown_and_rejected_branches(spark, scratch):
    b = write_csv(scratch, "b.csv", BRONZE_COLUMNS["branches"], [
        _branch("BR1", "LS1 1AB", "5.0"), _branch("BR2", "G1 11A", "5.0")])
    t = write_csv(scratch, "t.csv", BRONZE_COLUMNS["transactions"], [
        _txn("T1", "10.005", branch="BR1", channel="ATM"),
        _txn("T2", "20", branch="BR1", channel="Contactless", status="DECLINED"),
        _txn("T3", "30", branch=None),
        _txn("T4", "40", branch="BR9"),
        _txn("T5", "50", branch="BR2"),
    ])
    s = {"branches": silver_branches(read_bronze(spark, b, "branches")),
         "transactions": silver_transactions(read_bronze(spark, t, "transactions"))}
    mart = gold.branch_performance(s["transactions"], s["branches"]).collect()
    assert len(mart) == 1
    r = mart[0]
    assert (r.branch_id, r.total_transactions, r.unique_customers) == ("BR1", 2, 1)
    assert (r.atm_count, r.card_count, r.completed_count, r.failed_count) == (1, 1, 1, 1)
    # 30.005 and 15.0025, each rounded once
    assert r.total_value == 30.01 and r.avg_transaction_value == 15.0
    channels = {x.payment_channel: x for x in analytics.channel_mix(s["transactions"]).collect()}
    assert channels["Faster Payments (FPS)"].pct_of_total == 60.0
    assert sum(x.transaction_count for x in channels.values()) == 5


def test_csv_text_is_lossless(spark, scratch):
    lines = [_customer("C1", "LS1 1AB", "12.0", email="x@y.z")]
    lines[0][9] = '12 "Old" Lane, Leeds'  # quotes and a comma inside a field
    path = write_csv(scratch, "c.csv", BRONZE_COLUMNS["customers"], lines)
    r = read_bronze(spark, path, "customers").first()
    assert r.address == '12 "Old" Lane, Leeds' and r.annual_income == "12.0"
    t = write_csv(scratch, "t.csv", BRONZE_COLUMNS["transactions"], [_txn("T1", "1", cur="£")])
    assert read_bronze(spark, t, "transactions").first().currency == "£"


def test_quoted_newline_is_one_field(spark, scratch):
    path = write_csv(scratch, "b.csv", BRONZE_COLUMNS["branches"], [
        _branch("BR1", "LS1 1AB", "5.0", manager="\tAnn Lee\n"), _branch("BR2", "LS1 1AB", "6.0")])
    bronze = read_bronze(spark, path, "branches")
    assert bronze.count() == 2
    assert rows(silver_branches(bronze), "branch_id", "branch_manager") == [("BR1", "Ann Lee"), ("BR2", "Ann Lee")]


def test_dirty_rate_duplicates_count_null_key_once(spark, scratch):
    from bankmart.plans.quality import dirty_rates
    from bankmart.sources.bronze import read_bronze as rb

    feeds = {}
    for e, lines in {
        "branches": [_branch("B1", "LS1 1AB", "1.0")],
        "customers": [_customer("C1", "LS1 1AB", "1")],
        "transactions": [_txn(None, "1"), _txn(None, "2"), _txn("T1", "3"), _txn("T1", "4")],
        "loans": [_loan("L1", "0.05")],
    }.items():
        feeds[e] = rb(spark, write_csv(scratch, f"{e}.csv", BRONZE_COLUMNS[e], lines), e)
    out = {(r.entity, r.issue): r.affected_rows for r in dirty_rates(feeds).collect()}
    assert out[("transactions", "duplicate_rows")] == 2  # one null-key copy, one T1 copy
