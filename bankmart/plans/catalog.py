"""Named queries over the four feeds: silver jobs, marts, business queries and
quality checks.  Each entry takes the bronze feeds (a dict of DataFrames)
and returns a lazy DataFrame; ``registry(source)`` binds them to a source of
bronze feeds, e.g. the TPC-H-derived test feeds or a lake's raw CSV.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from bankmart.plans import analytics, gold, quality
from bankmart.plans.rules import RULE_QUERIES
from bankmart.plans.silver import SILVER_JOBS, silver_keys
from bankmart.session import staged

Bronze = dict[str, DataFrame]


class Layers:
    """Lazily built silver tables over a set of bronze feeds (built once each)."""

    def __init__(self, bronze: Bronze):
        self.bronze = bronze
        self._silver: dict[str, DataFrame] = {}

    def silver(self, entity: str) -> DataFrame:
        if entity not in self._silver:
            self._silver[entity] = SILVER_JOBS[entity](self.bronze[entity])
        return self._silver[entity]

    def activity(self) -> DataFrame:
        """What the branch mart reads of silver transactions, staged: it reads them twice."""
        return staged(self.silver("transactions").select(*gold.ACTIVITY_COLUMNS), "activity")

    def counted(self) -> dict[str, DataFrame]:
        """Silver tables as far as counts of their rows need them: no median is taken."""
        return {e: silver_keys(e, self.bronze[e]) for e in self.bronze}

    def all_silver(self) -> dict[str, DataFrame]:
        return {e: self.silver(e) for e in self.bronze}


def _silver(entity: str) -> Callable[[Layers], DataFrame]:
    return lambda L: L.silver(entity)


def _mart(fn) -> Callable[[Layers], DataFrame]:
    return lambda L: fn(_SilverView(L))


class _SilverView(dict):
    """dict-like access to silver tables, built on first use."""

    def __init__(self, layers: Layers):
        super().__init__()
        self._layers = layers

    def __missing__(self, key):
        return self._layers.silver(key)


def _bronze_check(name: str) -> Callable[[Layers], DataFrame]:
    return lambda L: quality.BRONZE_CHECKS[name](L.bronze)


def _silver_check(name: str) -> Callable[[Layers], DataFrame]:
    return lambda L: quality.SILVER_CHECKS[name](_SilverView(L))


QUERIES: dict[str, Callable[[Layers], DataFrame]] = {
    "silver_branches": _silver("branches"),
    "silver_customers": _silver("customers"),
    "silver_transactions": _silver("transactions"),
    "silver_loans": _silver("loans"),
    **{name: _mart(fn) for name, fn in gold.MARTS.items()},
    **{name: _mart(fn) for name, fn in analytics.QUERIES.items()},
    "gold_branch_performance": lambda L: gold.branch_performance(L.activity(), L.silver("branches")),
    "top_branches": lambda L: analytics.top_branches(L.activity(), L.silver("branches")),
    **{name: _bronze_check(name) for name in quality.BRONZE_CHECKS},
    **{name: _silver_check(name) for name in quality.SILVER_CHECKS},
    "vs_row_counts": lambda L: quality.row_counts(L.counted()),
    "vs_reconciliation": lambda L: quality.reconciliation(L.bronze, L.counted()),
    **{name: (lambda fn: lambda L: fn(L.bronze))(fn) for name, fn in RULE_QUERIES.items()},
    # spot checks: the limit is the feature
    "vb_peek_branches": lambda L: quality.spot_check(L.bronze["branches"]),
    "vb_peek_customers": lambda L: quality.spot_check(L.bronze["customers"]),
    "vb_peek_transactions": lambda L: quality.spot_check(L.bronze["transactions"]),
    "vb_peek_loans": lambda L: quality.spot_check(L.bronze["loans"]),
    "vb_null_staff_sample": lambda L: quality.null_staff_sample(L.bronze["branches"]),
}


def run(name: str, bronze: Bronze) -> DataFrame:
    return QUERIES[name](Layers(bronze))
