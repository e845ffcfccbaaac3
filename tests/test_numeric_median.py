"""Exact gold arithmetic and the distributed exact median."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from bankmart.functions.numeric import mean_round, money_sum, ratio_pct, round_half_up
from bankmart.operators.impute import exact_median, fill_median


def _ref_mean(vals, scale):
    d = [Decimal(str(v)) for v in vals if v is not None]
    if not d:
        return None
    m = sum(d) / Decimal(len(d))
    return float(m.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP))


@pytest.mark.parametrize("scale", [0, 2, 4])
def test_mean_round_is_exact_half_up(spark, scale):
    rnd = random.Random(7)
    groups = {
        "ties": [0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.07, 0.08],  # mean 0.045
        "neg": [-1.25, -1.26],
        "mixed": [round(rnd.uniform(-500, 500), 2) for _ in range(97)],
        "nulls": [None, 2.5, None],
        "empty": [None],
    }
    data = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r.m for r in df.groupBy("g").agg(mean_round("v", scale).alias("m")).collect()}
    for g, vs in groups.items():
        assert got[g] == _ref_mean(vs, scale), g


def test_money_sum_exact_and_order_free(spark):
    vals = [0.1] * 10 + [0.2] * 10 + [1234567.89, -0.01]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    expect = float(sum(Decimal(str(v)) for v in vals))
    for parts in (1, 3, 7):
        got = df.repartition(parts).agg(money_sum("v").alias("s")).first().s
        assert got == expect


def test_totals_round_once_at_the_end(spark):
    def total(vals):
        return spark.createDataFrame([(float(v),) for v in vals], "v double").agg(
            money_sum("v").alias("s"), mean_round("v", 2).alias("m")).first()

    assert total([0.004] * 1000) == (4.0, 0.0)
    assert total([1234.565] * 3 + [1000.125])[0] == 4703.82
    assert total([0.005, -0.01]) == (-0.01, 0.0)
    inf = float("inf")
    assert total([1.0, inf]) == (inf, inf) and total([-inf, 2.0]) == (-inf, -inf)
    assert all(x != x for x in total([inf, -inf]))
    with pytest.raises(Exception, match="does not fit"):
        total([1e18])


@pytest.mark.parametrize("seed", range(3))
def test_amounts_of_many_decimals_are_added_whole(spark, seed):
    """Against decimals: no value is rounded before the end, up to FINEST decimals."""
    rnd = random.Random(seed)
    vals = [rnd.choice([1, -1]) * float(f"{rnd.uniform(0, 10 ** rnd.randint(0, 4)):.{rnd.randint(0, 16)}f}") for _ in range(600)]
    vals += [0.004999999999999999, 1e-13, -1e-13, 3e-18, 5e-13, -5e-13, 0.1234567890123456] * rnd.randint(1, 5) + [None]
    groups = [(i % 7, v) for i, v in enumerate(vals)] + [(8, 0.005), (8, -1e-19), (9, -0.005), (9, 1e-19), (10, 0.0049999999999), (10, 1.0000000001e-13), (11, -0.005)]
    got = spark.createDataFrame(groups, "g int, v double").repartition(5).groupBy("g").agg(
        money_sum("v").alias("s"), mean_round("v", 2).alias("m"), money_sum("v", 4).alias("s4")).collect()
    for r in got:
        d = [Decimal(repr(v)) for g, v in groups if g == r.g and v is not None]
        total = sum(d)
        assert r.s == float(total.quantize(Decimal("0.01"), ROUND_HALF_UP)), r.g
        assert r.s4 == float(total.quantize(Decimal("0.0001"), ROUND_HALF_UP)), r.g
        assert r.m == _ref_mean([v for g, v in groups if g == r.g], 2), r.g
    single = spark.createDataFrame([(0.004999999999999999,), (0.0050000000000000001,), (-0.00499999999999999,), (2.675,)], "v double")
    assert [r[0] for r in single.select(round_half_up("v", 2)).collect()] == [0.0, 0.01, 0.0, 2.68]


def test_ratio_pct_half_up(spark):
    df = spark.createDataFrame([(1, 8000), (1, 3), (2, 3), (0, 5), (5, 0)], "n long, d long")
    got = [r.p for r in df.select(ratio_pct("n", "d", 2).alias("p")).collect()]
    # 100 * 1/8000 = 0.0125 -> 0.01; a zero denominator gives null
    assert got == [0.01, 33.33, 66.67, 0.0, None]


def test_round_half_up_single_values(spark):
    df = spark.createDataFrame([(2.675,), (1.005,), (-1.005,), (None,)], "v double")
    got = [r.r for r in df.select(round_half_up("v", 2).alias("r")).collect()]
    assert got == [2.68, 1.01, -1.01, None]


def _median_of(spark, values, parts=4):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    return exact_median(df, "v").first()[0]


@pytest.mark.parametrize("values,expect", [
    ([1, 2, 4, 9, None], 3.0),
    ([5], 5.0),
    ([3, 1, 2], 2.0),
    ([None, None], None),
    ([], None),
    ([7, 7, 7, 7], 7.0),
    ([1, 2, float("nan"), 3], 2.0),
])
def test_exact_median_small(spark, values, expect):
    vals = [None if v is None else float(v) for v in values]
    assert _median_of(spark, vals) == expect


def test_exact_median_matches_numpy_with_hot_value(spark):
    rnd = random.Random(11)
    n = 30_000
    hot = [12345.0] * (n // 3)  # one value holds a third of the rows
    rest = [float(rnd.randint(0, 1_000_000)) for _ in range(n - len(hot))]
    vals = hot + rest
    rnd.shuffle(vals)
    assert _median_of(spark, vals, parts=8) == float(np.median(vals))


@pytest.mark.parametrize("seed", range(4))
def test_exact_median_random(spark, seed):
    rnd = random.Random(seed)
    n = rnd.randint(1, 5000)
    vals = [round(rnd.gauss(100, 30), 2) for _ in range(n)]
    parts = rnd.randint(1, 8)
    assert _median_of(spark, vals, parts=parts) == pytest.approx(float(np.median(vals)), abs=1e-9)


def test_exact_median_with_infinities_and_wide_range(spark):
    inf = float("inf")
    assert _median_of(spark, [-inf, 1.0, 2.0, inf]) == 1.5
    assert _median_of(spark, [1.0, inf, inf]) == inf
    assert _median_of(spark, [-inf, -inf, 5.0]) == -inf
    assert _median_of(spark, [1e-300, 2e-300, 3e-300, 1e300, -1e300]) == 2e-300
    assert _median_of(spark, [5e-324, 1e-323, 1.5e-323]) == 1e-323


@pytest.mark.parametrize(("error", "picked"), [(1e-3, 2), (1e-2, 8), (0.05, 1 << 16)])
def test_exact_median_by_several_sketches(spark, monkeypatch, error, picked):
    from bankmart.operators import impute

    monkeypatch.setattr(impute, "ERROR", error)
    monkeypatch.setattr(impute, "PICKED", picked)
    monkeypatch.setattr(impute, "middle", lambda hist: pytest.fail("the sketch missed"))
    rnd = random.Random(picked)
    vals = [rnd.lognormvariate(0, 8) for _ in range(2001)]
    assert _median_of(spark, vals) == float(np.median(vals))


@pytest.mark.parametrize("hot", [900, 2001, 2002, 2500])
def test_exact_median_where_sketches_do_not_narrow(spark, monkeypatch, hot):
    from bankmart.operators import impute

    monkeypatch.setattr(impute, "ERROR", 1e-2)
    monkeypatch.setattr(impute, "PICKED", 1)
    vals = [float(i) for i in range(2000)] + [1e6] * hot
    assert _median_of(spark, vals) == float(np.median(vals))


def test_exact_median_when_a_sketch_misses(spark, monkeypatch):
    from bankmart.operators import impute

    monkeypatch.setattr(impute.F, "percentile_approx", lambda c, ends, accuracy: F.array(F.max(c), F.max(c)))
    monkeypatch.setattr(impute, "BINS", 3)  # many narrowing steps over the histogram
    rnd = random.Random(3)
    vals = [rnd.lognormvariate(0, 8) for _ in range(2001)]
    assert _median_of(spark, vals) == float(np.median(vals))


def test_median_takes_two_scans_and_no_histogram(spark, monkeypatch):
    from bankmart.operators import impute

    monkeypatch.setattr(impute, "staged", lambda *a: pytest.fail("a histogram was written"))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("median", "median")
    try:
        impute.exact_median(spark.range(100_000).selectExpr("cast(id * 7919 % 100003 as double) as v"), "v")
        assert len(jobs.getJobIdsForGroup("median")) <= 4  # two aggregates, a shuffle's job each under AQE
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_fill_median_population_and_type(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (4, 4.0), (5, 9.0)], "k int, v double")
    out = {r.k: r.v for r in fill_median(df, "v").collect()}
    assert out == {1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0, 5: 9.0}
    pop = df.where(F.col("k") != 5)  # median of 1,2,4 = 2
    out2 = {r.k: r.v for r in fill_median(df, "v", population=pop).collect()}
    assert out2[3] == 2.0
