"""Every registered query against its DuckDB oracle, and the derived feeds
against the same derivation evaluated by DuckDB."""

from __future__ import annotations

import pytest
from conftest import sf_dir

import __spark_entry__ as entry
from bankmart.schemas import ARRIVAL, BRONZE_COLUMNS
from testfeeds.tpch_feed import FEEDS, feed
from sqloracle import duckdb_sql
from tools.check_oracle import compare, duck

SF = sf_dir("0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


LLM = set(entry.llm.QUERIES) if entry.llm else set()  # tested in tests/llm


def test_every_query_has_an_oracle():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(qs) - set(sql) <= LLM


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - LLM))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    status = compare(df.columns, rows, [d[0] for d in res.description], res.fetchall())
    assert status == "OK", status


@pytest.mark.parametrize("name", ["vb_peek_branches", "vb_peek_loans", "vb_null_staff_sample"])
def test_samples_are_bounded(spark, name):
    n = entry.queries()[name](spark, SF).count()
    assert 0 < n <= 10


@pytest.mark.parametrize("entity", list(FEEDS))
def test_feed_parity_with_duckdb(spark, con, entity):
    df = feed(spark, SF, entity).drop(ARRIVAL)
    res = con.execute(f"WITH {duckdb_sql.bronze_cte(entity)} SELECT {', '.join(BRONZE_COLUMNS[entity])} "
                      f"FROM bronze_{entity}")
    status = compare(df.columns, [tuple(r) for r in df.collect()],
                     [d[0] for d in res.description], res.fetchall())
    assert status == "OK", status


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["branch_name", "branch_id", "branch_city", "branch_type", "opening_date"]
