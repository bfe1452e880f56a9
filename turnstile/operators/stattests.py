"""One-sample tests per metric over a long (key, metric, value) table
(M7-M10).

Test statistics are plain aggregates and windows over the metric table (the
windows run per metric over already-aggregated per-event rows).  p-values
need special functions that Spark lacks, so they are computed by a
vectorised pandas UDF over the one-row-per-metric result.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# the p-value functions travel with the tasks: executors need no copy of the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def long_metrics(df: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """Unpivot the metric columns; NULL changes are dropped (n is reported)."""
    return (df.unpivot(key, metrics, "metric", "value")
            .where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double"))))


def t_test(long: DataFrame) -> DataFrame:
    """M7: t = mean / (sd / sqrt(n)), sample sd."""
    g = long.groupBy("metric").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"),
                                   F.stddev_samp("value").alias("sd"))
    return g.withColumn("t", F.try_divide(F.col("mean"), F.col("sd") / F.sqrt(F.col("n"))))


def wilcoxon(long: DataFrame) -> DataFrame:
    """M8: signed-rank statistic; zeros dropped, tied |x| get the average
    rank; normal approximation with the tie correction."""
    nz = long.where(F.col("value") != 0).withColumn("a", F.abs("value"))
    w = Window.partitionBy("metric").orderBy("a")
    ties = F.count(F.lit(1)).over(Window.partitionBy("metric", "a"))
    r = nz.withColumn("rank", F.rank().over(w) + (ties - 1) / 2.0).withColumn("t", ties)
    g = r.groupBy("metric").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("value") > 0, F.col("rank")).otherwise(0.0)).alias("w_plus"),
        F.sum(F.when(F.col("value") < 0, F.col("rank")).otherwise(0.0)).alias("w_minus"),
        # sum over tie groups of (t^3 - t): each row of a group contributes (t^3 - t) / t
        F.sum((F.pow("t", 3) - F.col("t")) / F.col("t")).alias("tie_term"))
    n = F.col("n")
    mean = n * (n + 1) / 4.0
    var = n * (n + 1) * (2 * n + 1) / 24.0 - F.col("tie_term") / 48.0
    return (g.withColumn("w", F.least("w_plus", "w_minus"))
            .withColumn("z", F.try_divide(F.col("w") - mean, F.sqrt(var))))


def jarque_bera(long: DataFrame) -> DataFrame:
    """M9 (re-aimed Shapiro gate): population skewness and excess kurtosis
    from central moments, JB = n / 6 (S^2 + K^2 / 4)."""
    mu = long.groupBy("metric").agg(F.avg("value").alias("_mu"))
    c = long.join(mu, "metric").withColumn("d", F.col("value") - F.col("_mu"))
    g = c.groupBy("metric").agg(F.count(F.lit(1)).alias("n"), F.avg(F.pow("d", 2)).alias("m2"),
                                F.avg(F.pow("d", 3)).alias("m3"), F.avg(F.pow("d", 4)).alias("m4"))
    skew = F.try_divide(F.col("m3"), F.pow("m2", 1.5))
    kurt = F.try_divide(F.col("m4"), F.pow("m2", 2)) - 3.0
    return (g.withColumn("skewness", skew).withColumn("kurtosis", kurt)
            .withColumn("jb", F.col("n") / 6.0 * (F.col("skewness") ** 2 + F.col("kurtosis") ** 2 / 4.0)))


#: fixed values: numerator and denominator of the inverse normal's rational approximation, in the middle and in the tails
QUANTILE_MIDDLE = ((-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239),
                   (-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0))
QUANTILE_TAIL = ((-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783),
                 (0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0))
QUANTILE_TAIL_FROM = 0.02425

#: fixed values: corrections of the two outermost Shapiro-Wilk weights and the normalising moments, by powers of the argument
OUTER_WEIGHT = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
NEXT_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
SMALL_GAMMA = (-2.273, 0.459)
SMALL_MEAN = (0.5440, -0.39978, 0.025054, -0.0006714)
SMALL_LOG_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
LARGE_LOG_SD = (-0.4803, -0.082676, 0.0030302)

#: sizes for which the order-statistic weights are published
SHAPIRO_SIZES = (3, 5000)


def _poly(coefficients, x):
    """Sum of coefficients[i] * x^i."""
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def normal_quantile(p):
    """Inverse of the normal distribution function (relative error under 1.2e-9); p strictly between 0 and 1."""
    near = F.least(p, 1 - p)  # the lower half, mirrored
    q = near - 0.5
    middle = _poly(QUANTILE_MIDDLE[0][::-1], q * q) * q / _poly(QUANTILE_MIDDLE[1][::-1], q * q)
    t = F.sqrt(-2 * F.ln(near))
    tail = _poly(QUANTILE_TAIL[0][::-1], t) / _poly(QUANTILE_TAIL[1][::-1], t)
    low = F.when(near < QUANTILE_TAIL_FROM, tail).otherwise(middle)
    return F.when(p <= 0.5, low).otherwise(-low)


def shapiro_wilk(long: DataFrame) -> DataFrame:
    """M9: ``metric, n, w`` and ``normal_score`` (the normalised ln(1 - w); its upper tail is the p-value, for n = 3
    ``p3`` is).  Weights are those of Royston's approximation from normal scores of the ranks.

    Metrics of other sizes than ``SHAPIRO_SIZES`` have no row, so no window holds more than 5000 values; without any
    spread w is NULL."""
    size = long.groupBy("metric").agg(F.count("*").alias("n"), F.avg("value").alias("mu")).where(
        F.col("n").between(*SHAPIRO_SIZES))
    ranked = long.join(F.broadcast(size), "metric").withColumn("i", F.row_number().over(Window.partitionBy("metric").orderBy("value")))
    n, i = F.col("n").cast("double"), F.col("i").cast("double")
    score = lambda k: normal_quantile((k - 0.375) / (n + 0.25))
    ranked = ranked.withColumn("m", score(i))
    whole = ranked.groupBy("metric").agg(F.sum(F.col("m") * F.col("m")).alias("mm"))
    each = ranked.join(F.broadcast(whole), "metric").withColumn("m_n", score(n)).withColumn("m_next", score(n - 1))
    u, root = 1 / F.sqrt(n), F.sqrt("mm")
    each = each.withColumn("a_n", F.when(n == 3, F.lit(0.5 ** 0.5)).otherwise(F.col("m_n") / root + _poly(OUTER_WEIGHT, u)))
    each = each.withColumn("a_next", F.when(n > 5, F.col("m_next") / root + _poly(NEXT_WEIGHT, u)))
    left = F.col("mm") - 2 * F.col("m_n") ** 2 - F.when(n > 5, 2 * F.col("m_next") ** 2).otherwise(0.0)
    share = 1 - 2 * F.col("a_n") ** 2 - F.when(n > 5, 2 * F.col("a_next") ** 2).otherwise(0.0)
    inner = F.when(n == 3, 0.0).otherwise(F.col("m") / F.sqrt(left / share))
    outer = F.when(F.col("i") == 1, -F.col("a_n")).when(F.col("i") == F.col("n"), F.col("a_n"))
    second = F.when((n > 5) & (F.col("i") == 2), -F.col("a_next")).when((n > 5) & (F.col("i") == F.col("n") - 1), F.col("a_next"))
    each = each.withColumn("a", F.coalesce(outer, second, inner)).withColumn("d", F.col("value") - F.col("mu"))
    g = each.groupBy("metric", "n").agg(F.sum(F.col("a") * F.col("d")).alias("ad"), F.sum(F.col("d") * F.col("d")).alias("dd"))
    g = g.withColumn("w", F.when(F.col("dd") > 0, F.least(F.lit(1.0), F.col("ad") ** 2 / F.col("dd"))))
    low = F.ln(1 - F.col("w"))
    small = (-F.ln(_poly(SMALL_GAMMA, n) - low) - _poly(SMALL_MEAN, n)) / F.exp(_poly(SMALL_LOG_SD, n))
    large = (low - _poly(LARGE_MEAN, F.ln(n))) / F.exp(_poly(LARGE_LOG_SD, F.ln(n)))
    # a w so small that the argument of the outer logarithm is not positive is beyond any quantile
    small = F.when(_poly(SMALL_GAMMA, n) > low, small).otherwise(F.when(F.col("w").isNotNull(), F.lit(40.0)))
    p3 = F.greatest(F.lit(0.0), 6 / math.pi * (F.asin(F.sqrt("w")) - math.asin(0.75 ** 0.5)))
    return g.select("metric", "n", "w", F.when(n == 3, None).when(n <= 11, small).otherwise(large).alias("normal_score"),
                    F.when(n == 3, p3).alias("p3"))


def normality_gate(long: DataFrame) -> DataFrame:
    """M9: ``metric, n, gate, statistic, p_normal``.  ``gate`` names the test used: ``shapiro-wilk`` where its weights are
    published, ``jarque-bera`` for more values; ``none`` (NULLs) for fewer than three values or values without spread."""
    jb = jarque_bera(long).select("metric", F.col("n"), "jb")
    sw = shapiro_wilk(long).select("metric", "w", "normal_score", "p3")
    both = jb.join(sw, "metric", "left")
    small = F.col("w").isNotNull()
    large = (F.col("n") > SHAPIRO_SIZES[1]) & F.col("jb").isNotNull()
    p = F.when(small, F.coalesce("p3", normal_upper_p("normal_score"))).when(large, chi2_2df_sf(F.col("jb")))
    return both.select("metric", "n", F.when(small, "shapiro-wilk").when(large, "jarque-bera").otherwise("none").alias("gate"),
                       F.when(small, F.col("w")).when(large, F.col("jb")).alias("statistic"), p.alias("p_normal"))


# ------------------------------------------------------------------ p-values

def _betacf(a, b, x, iters=300, eps=1e-15):
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = 1.0
    d = 1.0 - qab * x / qap
    d = 1.0 / d if abs(d) > 1e-300 else 1e300
    h = d
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / d if abs(d) > 1e-300 else 1e300
        c = 1.0 + aa / c if abs(1.0 + aa / c) > 1e-300 else 1e-300
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / d if abs(d) > 1e-300 else 1e300
        c = 1.0 + aa / c if abs(1.0 + aa / c) > 1e-300 else 1e-300
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc_reg(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b) (continued fraction)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1 - x) / b


def t_two_sided_p(t: float, df: float) -> float:
    if t is None or df is None or not np.isfinite(t) or df <= 0:
        return float("nan")
    return betainc_reg(df / 2.0, 0.5, df / (df + t * t))


@pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(a, b) if pd.notna(a) and pd.notna(b) else np.nan
                      for a, b in zip(t, df, strict=True)])


@pandas_udf(T.DoubleType())
def normal_two_sided_p(z: pd.Series) -> pd.Series:
    return pd.Series([math.erfc(abs(v) / math.sqrt(2.0)) if pd.notna(v) else np.nan for v in z])


@pandas_udf(T.DoubleType())
def normal_upper_p(z: pd.Series) -> pd.Series:
    return pd.Series([0.5 * math.erfc(v / math.sqrt(2.0)) if pd.notna(v) else np.nan for v in z])


# Up to this many values the signed-rank distribution is counted out.
EXACT_SIGNED_RANKS = 50


def signed_rank_p(w: float, n: int) -> float:
    """Two-sided p of the smaller rank sum ``w`` of ``n`` untied values: the share of all 2^n sign patterns with a
    rank sum as small, counted rank by rank."""
    ways = np.zeros(n * (n + 1) // 2 + 1)
    ways[0] = 1.0
    for rank in range(1, n + 1):
        ways[rank:] += ways[:-rank].copy()
    return float(min(1.0, 2.0 * ways[: int(w) + 1].sum() / 2.0 ** n))


@pandas_udf(T.DoubleType())
def signed_rank_pvalue(w: pd.Series, n: pd.Series, z: pd.Series, tie_term: pd.Series) -> pd.Series:
    """Exact for few untied values, the normal approximation otherwise."""
    return pd.Series([np.nan if pd.isna(a) else signed_rank_p(a, int(m)) if m <= EXACT_SIGNED_RANKS and not t
                      else math.erfc(abs(b) / math.sqrt(2.0)) for a, m, b, t in zip(w, n, z, tie_term, strict=True)])


def signed_rank_method(n, tie_term):
    """Which of the two ``signed_rank_pvalue`` takes."""
    return F.when((n <= EXACT_SIGNED_RANKS) & (tie_term == 0), "exact").otherwise("normal")


def chi2_2df_sf(x):
    """Survival function of chi-square with 2 degrees of freedom."""
    return F.exp(-x / 2.0)
