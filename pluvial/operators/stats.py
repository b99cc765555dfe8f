"""Statistics as column arithmetic over one-pass aggregates.

Everything here runs on executors: the aggregates (counts, co-moments) are
combined map-side, and the test statistics are arithmetic on the final row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Terms of the two expansions of erfc; both have converged to double precision.
SERIES_TERMS, FRACTION_TERMS = 60, 80
#: Steps after which the series of a ratio of gamma functions has converged, too.
GAMMA_STEPS = 30


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI division would raise)."""
    return F.when(den != 0, num / den)


def pearson(n: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """Pearson's r from sums of squares and products (``regr_sxx`` and so on): NULL
    without pairs, NaN where a side is constant, as the SQL aggregate has it
    (``corr`` raises there in ANSI mode)."""
    spread = F.sqrt(sxx * syy)
    return F.when(spread != 0, sxy / spread).when(n > 0, F.lit(float("nan")))


def _erf_small(x: Column) -> Column:
    """erf(x) for 0 <= x < 2 by its series of positive terms."""
    first = F.struct(x.alias("term"), x.alias("total"))

    def add(acc: Column, n: Column) -> Column:
        term = acc["term"] * F.lit(2.0) * x * x / (F.lit(2.0) * n + F.lit(1.0))
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    total = F.aggregate(F.sequence(F.lit(1), F.lit(SERIES_TERMS)), first, add, lambda acc: acc["total"])
    return F.lit(2.0 / math.sqrt(math.pi)) * F.exp(-(x * x)) * total


def _erfcx_large(x: Column) -> Column:
    """exp(x^2) erfc(x) for x >= 2 by its continued fraction, from the inside out."""
    inner = F.aggregate(F.sequence(F.lit(FRACTION_TERMS), F.lit(1), F.lit(-1)), x,
                        lambda acc, k: x + k / F.lit(2.0) / acc)
    return F.lit(1.0 / math.sqrt(math.pi)) / inner


def erfc_nonneg(x: Column) -> Column:
    """erfc(x) for x >= 0, right in its leading digits however small it is."""
    return F.when(x < 2, F.lit(1.0) - _erf_small(x)).otherwise(_erfcx_large(x) * F.exp(-(x * x)))


def log10_erfc_nonneg(x: Column) -> Column:
    """log10(erfc(x)) for x >= 0, also where erfc itself is below all doubles."""
    return F.when(x < 2, F.log10(F.lit(1.0) - _erf_small(x))).otherwise(
        F.log10(_erfcx_large(x)) - x * x / F.lit(math.log(10.0)))


def chi2_sf_1df(chi2: Column) -> Column:
    """Upper-tail probability of a chi-square statistic with one degree of freedom."""
    return erfc_nonneg(F.sqrt(chi2 / F.lit(2.0)))


def _gamma_ratio(a: Column) -> Column:
    """gamma(a + 1/2) / gamma(a) for a > 0: by its series in 1/a, after ``GAMMA_STEPS``
    steps upward that make a large."""
    steps = F.aggregate(F.sequence(F.lit(0), F.lit(GAMMA_STEPS - 1)), F.lit(1.0),
                        lambda acc, k: acc * (a + k) / (a + k + F.lit(0.5)))
    u = F.lit(1.0) / (a + F.lit(float(GAMMA_STEPS)))
    series = F.lit(1.0) - u / 8 + u * u / 128 + 5 * u * u * u / 1024 - 21 * u * u * u * u / 32768
    return steps * series / F.sqrt(u)


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, from the inside
    out; for x < (a + 1) / (a + b + 2) terms grow with the root of the larger of a and b."""
    terms = F.ceil(F.lit(100.0) + F.lit(12.0) * F.sqrt(F.greatest(a, b))).cast("int")

    def term(k: Column) -> Column:
        m = F.floor(k / F.lit(2)).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(k % 2 == 0, even).otherwise(odd)

    inner = F.aggregate(F.sequence(terms, F.lit(1), F.lit(-1)), F.lit(1.0), lambda acc, k: F.lit(1.0) + term(k) / acc)
    return F.lit(1.0) / inner


def student_t_p(r: Column, n: Column) -> tuple[Column, Column]:
    """(two-sided p-value, its log10) of a correlation r of n pairs, by Student's t
    with n - 2 degrees of freedom.

    p is the regularised incomplete beta function I(1 - r^2; (n - 2) / 2, 1/2); the
    log10 is right in its leading digits also where p is below all doubles.
    NULL for n <= 2, NaN where r is; a perfect correlation has p 0 and no log10.
    """
    a, half, y = (n - F.lit(2.0)) / F.lit(2.0), F.lit(0.5), r * r
    x = F.lit(1.0) - y
    # the factor before both fractions: x^a y^(1/2) / B(a, 1/2)
    front = F.sqrt(y) * _gamma_ratio(a) / F.lit(math.sqrt(math.pi))
    log_x = a * F.log1p(-y)
    tail = front * _beta_fraction(a, half, x) / a
    near = F.lit(1.0) - F.exp(log_x) * front * _beta_fraction(half, a, y) / half
    small = x < (a + 1) / (a + F.lit(2.5))
    usable = (n > 2) & r.isNotNull()
    p = F.when(usable & F.isnan(r), r).when(usable & (y >= 1), F.lit(0.0)).when(usable & small, F.exp(log_x) * tail).when(usable, near)
    log10_p = (F.when(usable & F.isnan(r), r).when(usable & (y < 1) & small, log_x / F.lit(math.log(10.0)) + F.log10(tail))
               .when(usable & (y < 1), F.log10(near)))
    return p, log10_p


def two_by_two(cells: DataFrame, a: str, b: str, c: str, d: str, digits: int = 6) -> DataFrame:
    """Chi-square test of independence on one row of 2x2 counts.

    Layout: row 1 = (a, b), row 2 = (c, d).  Adds n, chi2, p_value,
    its log10 (strong effects round to a p_value of 0), odds_ratio and both row rates of the first column.
    """
    A, B, C, D = (F.col(x).cast("double") for x in (a, b, c, d))
    n = A + B + C + D
    den = (A + B) * (C + D) * (A + C) * (B + D)
    chi2 = safe_div(n * (A * D - B * C) * (A * D - B * C), den)
    return cells.select(
        a, b, c, d,
        n.cast("bigint").alias("n"),
        F.round(chi2, digits).alias("chi2"),
        F.round(chi2_sf_1df(chi2), digits).alias("p_value"),
        F.round(log10_erfc_nonneg(F.sqrt(chi2 / F.lit(2.0))), digits).alias("log10_p"),
        F.round(safe_div(A * D, B * C), digits).alias("odds_ratio"),
        F.round(safe_div(A, A + B), digits).alias("rate_row1"),
        F.round(safe_div(C, C + D), digits).alias("rate_row2"),
    )


def pairwise_regression(long: DataFrame, group: str, x: str, y: str,
                        digits: int = 6) -> DataFrame:
    """Per group: pair count, Pearson r, least-squares line of y on x, R^2, and
    the t statistic of r (n - 2 degrees of freedom) with its two-sided p-value and
    log10.  Pairs with a NULL on either side are ignored, as the SQL aggregates do; a
    constant factor has r and a slope of NaN, a constant y an r of NaN."""
    X, Y = F.col(x), F.col(y)
    agg = long.groupBy(group).agg(
        F.regr_count(Y, X).alias("n"),
        F.regr_sxx(Y, X).alias("_sxx"), F.regr_syy(Y, X).alias("_syy"), F.regr_sxy(Y, X).alias("_sxy"),
        F.regr_slope(Y, X).alias("slope"),
        F.regr_intercept(Y, X).alias("intercept"),
        F.regr_r2(Y, X).alias("r2"),
    ).withColumn("r", pearson(F.col("n"), F.col("_sxx"), F.col("_syy"), F.col("_sxy")))
    r = F.col("r")
    slope = F.when((F.col("n") > 0) & (F.col("_sxx") == 0), F.lit(float("nan"))).otherwise(F.col("slope"))
    t = r * F.sqrt(safe_div(F.col("n") - F.lit(2.0), F.lit(1.0) - r * r))
    p_value, log10_p = student_t_p(r, F.col("n"))
    return agg.select(
        group, "n",
        F.round(r, digits).alias("pearson_r"),
        F.round(slope, digits).alias("slope"),
        F.round("intercept", digits).alias("intercept"),
        F.round("r2", digits).alias("r2"),
        F.round(F.when(F.col("n") > 2, t), digits).alias("t_stat"),
        F.round(p_value, digits).alias("p_value"),
        F.round(log10_p, digits).alias("log10_p"),
    )
