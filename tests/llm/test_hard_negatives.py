from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest

from bankmart.llm import hard_negatives, queries
from bankmart.llm.hard_negatives import Bounds, Side, mine, segments, summary

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, anchors, n_pos=5, n_neg=5, scale=256):
    def ok(r):
        return r[0] is not None and r[1] is not None and r[2] is not None and all(c is not None and math.isfinite(c) for c in r[2])

    rows = sorted({(i, y, tuple(math.floor(scale * c) for c in v)) for i, y, v in filter(ok, rows)})
    out = []
    for a in rows:
        if not anchors(a[0]):
            continue
        scored = sorted(((-sum(x * z for x, z in zip(a[2], b[2], strict=True)), b[0], b[1]) for b in rows if b[0] != a[0] and len(b[2]) == len(a[2])))
        for p, pid, _ in [s for s in scored if s[2] == a[1]][:n_pos]:
            band = [s for s in scored if s[2] != a[1] and 80 * -p <= 100 * -s[0] <= 100 * -p][:n_neg]
            out += [(a[0], pid, k + 1, nid, -p, -s) for k, (s, nid, _) in enumerate(band)]
    return sorted(out)


def mined(spark, rows, **how):
    return sorted(map(tuple, mine(spark.createDataFrame(rows, SCHEMA), lambda c: c % 10 == 0, **how).collect()))


def vectors(rng, n, dim, labels=4):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    return [(i, rng.randrange(labels), [c + rng.gauss(0, 0.4) for c in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize(("n", "dim", "block"), [(150, 16, 16_384), (300, 7, 40), (90, 1, 16_384), (200, 64, 64)])
def test_same_as_brute_force(spark, monkeypatch, n, dim, block):
    monkeypatch.setattr(hard_negatives, "ROWS", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    rows = vectors(random.Random(n), n, dim)
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_edge_cases(spark):
    rng = random.Random(1)
    rows = vectors(rng, 60, 4, 3)
    rows += [(10, 1, rows[10][2]), (10, 1, rows[10][2]), (70, 2, rows[20][2]), (70, 2, rows[21][2])]  # repeated rows, repeated ids
    rows += [(80, None, [1.0] * 4), (90, 1, None), (100, 1, [1.0, None, 0.0, 0.0]), (110, 1, [float("nan")] * 4), (120, 1, [float("inf")] * 4),
             (None, 1, [1.0] * 4), (130, 1, []), (131, 1, []), (132, 2, []), (140, 0, [1.0, 2.0]), (141, 0, [2.0, 1.0]), (142, 1, [2.0, 1.0]), (150, 0, [0.0] * 4)]
    rows += [(200 + i, i % 2, [0.5, 0.5, -0.0, 0.5]) for i in range(40)]  # one vector many times
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 10 == 0)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rank", "'x' as hash", "2 as dim")
    assert sorted(map(tuple, mine(df, lambda c: c % 10 == 0).collect())) == got
    assert mine(df.limit(0), lambda c: c % 10 == 0).collect() == []
    assert mine(df, lambda c: c < 0).collect() == []


def test_large_components_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, [float(rng.randint(-10 ** 9, 10 ** 9)) for _ in range(3)]) for i in range(40)]
    assert mined(spark, rows, scale=1) == brute(rows, lambda i: i % 10 == 0, scale=1)


@pytest.mark.parametrize("dim", [1, 2, 3, 8, 13, 64])
def test_bounds_hold_and_narrow(dim):
    rng = np.random.default_rng(dim)
    x = np.floor(rng.normal(0, 40, (30, dim)) + rng.integers(-50, 50, (30, 1)))
    import pyarrow as pa

    table = pa.table({"vec_id": np.arange(30), "label": np.zeros(30, np.int64), "v": list(x), "summary": list(summary(x))})
    side = Side(table, dim)
    exact = x @ x.T
    bounds, width = Bounds(side, np.arange(30), side), np.inf
    for k in range(len(segments(dim))):
        low, high = np.full(exact.shape, -np.inf), np.full(exact.shape, np.inf)
        bounds.level(k, np.ones(exact.shape, bool), low, high)
        assert (low <= exact).all() and (exact <= high).all()
        assert (high - low).mean() <= width + 1e-3
        width = (high - low).mean()


def test_filter_spares_exact_scores():
    """On clustered vectors most rows are ruled out by their summaries."""
    rng = np.random.default_rng(0)
    import pyarrow as pa

    x = np.floor(256 * (np.repeat(rng.normal(0, 1, (40, 8)), 8, axis=1)[rng.integers(0, 40, 2000)] + rng.normal(0, 0.05, (2000, 64))))
    side = Side(pa.table({"vec_id": np.arange(2000), "label": np.zeros(2000, np.int64), "v": list(x), "summary": list(summary(x))}), 64)
    pick = np.arange(50)
    alive = hard_negatives._refined(Bounds(side, pick, side), np.ones((50, 2000), bool),
                                    lambda alive, low, high: high < hard_negatives._nth(low, alive, 5)[:, None])
    assert alive.mean() < 0.1


def test_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view embeddings as from '{sf}/embeddings.parquet'")
    want = con.sql(queries.ORACLE_SQL["op11_hard_negatives"]).fetchall()
    got = queries.op11_hard_negatives(spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 100
