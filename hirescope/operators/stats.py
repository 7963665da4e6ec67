"""Hypothesis tests (A18-A20) from distributed sufficient statistics.

Each test reduces the data to per-group sums in Spark (one aggregate), so
only a handful of numbers per group ever reach the driver.  The statistic is
computed in SQL; the p-value is one scalar special-function evaluation on
the driver (``f_sf`` / ``chi2_sf`` below).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def anova_oneway(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way ANOVA F statistic of ``value`` across ``group``.

    Each group gives its count, mean and sum of squared deviations, which stay
    accurate where raw sums of squares would cancel.  Null with fewer than two
    groups, without spare rows or without spread inside the groups.
    Returns one row: f_stat, df_between, df_within, n.
    """
    x = F.col(value).cast("double")
    g = (df.groupBy(group).agg(F.count(value).alias("n"), F.avg(x).alias("m"), F.var_pop(x).alias("v"))
         .filter("n > 0"))
    w = Window.partitionBy(F.lit(1))  # one row per group
    g = g.withColumn("grand", F.sum(F.col("n") * F.col("m")).over(w) / F.sum("n").over(w))
    tot = g.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("N"), F.count(F.lit(1)).alias("k"),
                F.sum(F.col("n") * (F.col("m") - F.col("grand")) ** 2).alias("ssb"),
                F.sum(F.col("n") * F.col("v")).alias("ssw"))
    return tot.select(
        F.round(F.try_divide(F.try_divide(F.col("ssb"), F.col("k") - 1),
                             F.try_divide(F.col("ssw"), F.col("N") - F.col("k"))), 6).alias("f_stat"),
        (F.col("k") - 1).alias("df_between"), (F.col("N") - F.col("k")).alias("df_within"),
        F.col("N").alias("n"))


def group_mean_count(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean and count per group."""
    return df.groupBy(group).agg(F.round(F.avg(value), 6).alias("mean"), F.count(value).alias("count"))


def chi_square(cells: DataFrame, row: str, col: str, count: str = "n") -> DataFrame:
    """Chi-square statistic of independence from long-form cell counts.

    chi2 = N * (sum_ij o_ij^2 / (r_i c_j) - 1); only non-zero cells are
    needed, margins are aggregates.  dof = (R-1)(C-1).  With dof = 1 Yates'
    correction is applied, as SciPy does: every |o - e| less 0.5 (or itself).
    """
    r = cells.groupBy(row).agg(F.sum(count).alias("_r"))
    c = cells.groupBy(col).agg(F.sum(count).alias("_c"))
    j = cells.join(r, row).join(c, col)
    return j.agg(
        F.sum(F.col(count).cast("double") ** 2 / (F.col("_r").cast("double") * F.col("_c"))).alias("_q"),
        F.sum(count).alias("n"), F.count_distinct(row).alias("_R"), F.count_distinct(col).alias("_C"),
        F.first("_r").alias("_r1"), F.first("_c").alias("_c1"), F.first(count).alias("_o1"),
    ).select(F.when((F.col("_R") == 2) & (F.col("_C") == 2), _yates()).otherwise(
        F.round(F.col("n") * (F.col("_q") - 1), 4)).alias("chi2"),
             ((F.col("_R") - 1) * (F.col("_C") - 1)).alias("dof"), "n")


def _yates():
    """Corrected chi-square of a 2 x 2 table from one cell and its margins: the
    deviation from the expected count is the same in all four cells."""
    n, r, c = (F.col(x).cast("double") for x in ("n", "_r1", "_c1"))
    e = r * c / n
    gap = F.abs(F.col("_o1") - e)
    less = F.greatest(gap - F.lit(0.5), F.lit(0.0))
    return F.round(less ** 2 * (n / (r * c) + n / ((n - r) * c) + n / (r * (n - c)) + n / ((n - r) * (n - c))), 4)


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation (Spark's ``corr`` is a one-pass aggregate)."""
    return df.agg(F.round(F.corr(F.col(x).cast("double"), F.col(y).cast("double")), 6).alias("r"),
                  F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------- p-values (scalar)
def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > 1e-300 else 1e-300
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > 1e-300 else 1e-300
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 3e-14:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b) (continued fraction)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def f_sf(f: float, d1: float, d2: float) -> float:
    """Survival function of the F distribution."""
    if f is None or f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def gammaincc(a: float, x: float) -> float:
    """Regularized upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1:
        s, term, n = 1.0 / a, 1.0 / a, a
        for _ in range(1000):
            n += 1
            term *= x / n
            s += term
            if abs(term) < abs(s) * 1e-15:
                break
        return 1.0 - s * math.exp(-x + a * math.log(x) - math.lgamma(a))
    b, c, d = x + 1 - a, 1e300, 1.0 / (x + 1 - a)
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = b + an / c
        c = c if abs(c) > 1e-300 else 1e-300
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def chi2_sf(x: float, dof: float) -> float:
    """Survival function of the chi-square distribution."""
    return gammaincc(dof / 2.0, x / 2.0)


# ------------------------------------------------------- tests with p-values
def anova_test(df: DataFrame, group: str, value: str) -> dict:
    """A18 as reported: F, p and degrees of freedom (one aggregate row reaches
    the driver)."""
    r = anova_oneway(df, group, value).first()
    return {"f_stat": r.f_stat, "p_value": None if r.f_stat is None else f_sf(r.f_stat, r.df_between, r.df_within),
            "df_between": r.df_between, "df_within": r.df_within, "n": r.n}


def chi2_test(cells: DataFrame, row: str, col: str, count: str = "n") -> dict:
    """A20 as reported: chi-square, p and dof."""
    r = chi_square(cells, row, col, count).first()
    return {"chi2": r.chi2, "p_value": chi2_sf(r.chi2, r.dof), "dof": r.dof, "n": r.n}
