"""Significance of correlations, against closed forms and an integral."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvial.operators import stats


def closed_form(t, nu):
    """Two-sided p-values of Student's t for few degrees of freedom."""
    t = abs(t)
    if nu == 1:
        return 1 - 2 / math.pi * math.atan(t)
    if nu == 2:
        return 2 / (math.sqrt(2 + t * t) * (math.sqrt(2 + t * t) + t))
    theta = math.atan(t / math.sqrt(nu))
    s, c = math.sin(theta), math.cos(theta)
    if nu == 4:
        return 1 - s * (1 + c * c / 2)
    return 1 - 2 / math.pi * (theta + s * c)      # nu == 3


def log10_p(r, n):
    """log10 of the p-value, by Gauss-Legendre on the part that counts."""
    a, k = math.asin(abs(r)), n - 3
    width = min(math.pi / 2 - a, 20 / math.sqrt(k), 100 / (k * math.tan(a)) if a else math.inf)
    x, w = np.polynomial.legendre.leggauss(400)
    s = (x + 1) / 2 * width
    value = (w * np.exp(k * (np.log(np.cos(a + s)) - math.log(math.cos(a))))).sum() / 2 * width
    log = math.log(2) + math.lgamma((n - 1) / 2) - math.lgamma((n - 2) / 2) - math.log(math.pi) / 2
    return (log + k * math.log(math.cos(a)) + math.log(value)) / math.log(10)


def measured(spark, pairs):
    df = spark.createDataFrame([(float(r), int(n)) for r, n in pairs], "r double, n long")
    p, log = stats.student_t_p(F.col("r"), F.col("n"))
    return [(x.p, x.log) for x in df.select("r", "n", p.alias("p"), log.alias("log")).collect()]


def test_few_degrees_of_freedom(spark):
    pairs = [(r, nu + 2) for nu in (1, 2, 3, 4) for r in (0.0, 0.01, -0.3, 0.5, 0.9, -0.999)]
    for (r, n), (p, log) in zip(pairs, measured(spark, pairs)):
        want = closed_form(r * math.sqrt((n - 2) / (1 - r * r)), n - 2)
        assert p == pytest.approx(want, rel=1e-10, abs=1e-14)
        assert log == pytest.approx(math.log10(p), abs=1e-9)


def test_many_pairs_and_strong_effects(spark):
    pairs = [(r, n) for n in (12, 100, 5000, 60_000, 2_000_000) for r in (0.0005, 0.02, 0.1, 0.4, 0.95)]
    for (r, n), (p, log) in zip(pairs, measured(spark, pairs)):
        want = log10_p(r, n)
        assert log == pytest.approx(want, rel=1e-10, abs=1e-9)
        if want > -300:
            assert p == pytest.approx(10 ** want, rel=2e-8)
    assert min(log for _, log in measured(spark, [(0.95, 2_000_000)])) < -1e6


def test_below_ten_to_the_minus_ten_and_edges(spark):
    (p, log), = measured(spark, [(0.2, 1500)])
    assert p < 1e-10 and log == pytest.approx(log10_p(0.2, 1500), rel=1e-11)
    assert measured(spark, [(0.5, 2), (0.5, 0)]) == [(None, None)] * 2
    assert measured(spark, [(1.0, 10), (-1.0, 10)]) == [(0.0, None)] * 2
    assert measured(spark, [(0.0, 10)])[0][0] == pytest.approx(1.0)


def test_constant_side_has_no_correlation_but_fails_nothing(spark):
    import duckdb
    import math
    from pluvial.operators.ranks import spearman
    from pluvial.operators.stats import pairwise_regression

    rows = [("flat", 0.0, float(k % 3)) for k in range(9)] + [("same", float(k), 2.0) for k in range(9)] \
        + [("line", float(k), float(k * k)) for k in range(9)] + [("none", None, 1.0)]
    long = spark.createDataFrame(rows, "g string, x double, y double")
    got = {r.g: r for r in pairwise_regression(long, "g", "x", "y").collect()}
    want = duckdb.sql("""SELECT g, regr_count(y, x), round(corr(x, y), 6), round(regr_slope(y, x), 6),
        round(regr_intercept(y, x), 6), round(regr_r2(y, x), 6) FROM (VALUES %s) t(g, x, y) GROUP BY g""" % ", ".join(
        f"('{g}', {'NULL::DOUBLE' if x is None else f'{x}::DOUBLE'}, {y}::DOUBLE)" for g, x, y in rows)).fetchall()

    def same(a, b):
        return a is b is None or (a is not None and b is not None and (a == b or (math.isnan(a) and math.isnan(b))))

    for g, *values in want:
        assert all(same(a, b) for a, b in zip(got[g][1:6], values)), (got[g], values)
    assert all(math.isnan(got[g][c]) for g in ("flat", "same") for c in ("t_stat", "p_value", "log10_p"))
    ranked = {r.g: r for r in spearman(long, "g", "x", "y").collect()}
    assert math.isnan(ranked["flat"].spearman_rho) and math.isnan(ranked["same"].p_value)
    assert ranked["line"].spearman_rho == 1.0
