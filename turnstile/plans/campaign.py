"""Campaign queries: interval joins and before/during change."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.operators import campaigns
from turnstile.operators.joins import interval_join
from turnstile.plans.registry import register
from turnstile.plans.sqlbind import REVIEWS, values_cte
from turnstile.sources.tables import reviews

# The promo calendar bound to the order dates (1995-2001).
# Promos 1 and 2 overlap, "Summer Nights" runs twice, promo 16 lies after the
# last order (both of its windows are empty).
PROMOS = [
    (1, "Spring Fiesta", "1995-03-01", "1995-04-15"),
    (2, "Easter Parade", "1995-04-01", "1995-04-30"),
    (3, "Summer Nights", "1995-07-01", "1995-08-31"),
    (4, "Halloween Horror", "1995-10-01", "1995-10-31"),
    (5, "Winter Lights", "1996-12-01", "1996-12-31"),
    (6, "Summer Nights", "1996-07-01", "1996-08-15"),
    (7, "Lunar New Year", "1997-02-01", "1997-02-14"),
    (8, "Family Month", "1997-06-01", "1997-06-30"),
    (9, "Student Week", "1998-03-09", "1998-03-15"),
    (10, "Halloween Horror", "1998-09-25", "1998-11-01"),
    (11, "Anniversary Sale", "1999-05-18", "1999-05-18"),
    (12, "Locals Pass", "1999-09-01", "1999-12-31"),
    (13, "Spring Fiesta", "2000-03-01", "2000-04-15"),
    (14, "Summer Nights", "2000-07-01", "2000-08-31"),
    (15, "Year End Bash", "2001-06-15", "2001-07-31"),
    (16, "Grand Reopening", "2002-03-01", "2002-03-31"),
]
BRANCH = "F"

_PROMO_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
])

PROMOS_SQL = values_cte("promos", ["event_id", "event", "start_date", "end_date"],
                        PROMOS, ["BIGINT", "VARCHAR", "DATE", "DATE"])


def review_span() -> tuple[dt.date, dt.date]:
    """First and last day any promo window covers (before windows included)."""
    lo = min(dt.date.fromisoformat(s) - (dt.date.fromisoformat(e) - dt.date.fromisoformat(s)) for _, _, s, e in PROMOS)
    hi = max(dt.date.fromisoformat(e) for _, _, _, e in PROMOS)
    return lo, hi


def promos(spark: SparkSession) -> DataFrame:
    rows = [(i, n, dt.date.fromisoformat(s), dt.date.fromisoformat(e)) for i, n, s, e in PROMOS]
    return spark.createDataFrame(rows, _PROMO_SCHEMA)


def _windowed(spark, sf_dir, phase, shuffle=False):
    r = reviews(spark, sf_dir, date_range=review_span())
    p = promos(spark)
    w = campaigns.review_windows(p).where(F.col("phase") == phase)
    r = r.where(F.col("branch") == BRANCH)
    j = interval_join(r, w, "written_date", "lo", "hi", shuffle=shuffle)
    return j.select("event_id", "event_key", "review_id", "written_date", "rating",
                    F.round("polarity", 6).alias("polarity"))


_WINDOWS_SQL = f"""WITH {REVIEWS}, {PROMOS_SQL},
windows AS (
  SELECT event_id, event || ' (' || strftime(start_date, '%Y-%m-%d') || ')' AS event_key,
         'during' AS phase, start_date AS lo, end_date AS hi FROM promos
  UNION ALL
  SELECT event_id, event || ' (' || strftime(start_date, '%Y-%m-%d') || ')',
         'before', start_date - CAST(end_date - start_date AS INTEGER), start_date - 1 FROM promos)"""

_WINDOWED_SQL = _WINDOWS_SQL + """
SELECT w.event_id, w.event_key, r.review_id, r.written_date, r.rating,
       round(r.polarity, 6) AS polarity
FROM reviews r JOIN windows w ON r.written_date BETWEEN w.lo AND w.hi
WHERE r.branch = 'F' AND w.phase = '{phase}' AND w.lo <= w.hi"""


@register("campaign_during", _WINDOWED_SQL.format(phase="during"))
def campaign_during(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of the branch written during each promo (month-bucketed interval join)."""
    return _windowed(spark, sf_dir, "during")


@register("campaign_before", _WINDOWED_SQL.format(phase="before"))
def campaign_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews in the shifted window [start - duration, start - 1 day]."""
    return _windowed(spark, sf_dir, "before")


@register("interval_join_bucketed", _WINDOWED_SQL.format(phase="during"))
def interval_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join in its sort-merge form (both sides shuffled on the month)."""
    return _windowed(spark, sf_dir, "during", shuffle=True)


CHANGE_SQL = _WINDOWS_SQL + """,
agg AS (
  SELECT w.event_id,
         avg(polarity) FILTER (WHERE phase = 'during') AS pol_d,
         avg(polarity) FILTER (WHERE phase = 'before') AS pol_b,
         avg(rating) FILTER (WHERE phase = 'during') AS rat_d,
         avg(rating) FILTER (WHERE phase = 'before') AS rat_b,
         count(*) FILTER (WHERE phase = 'during') AS n_d,
         count(*) FILTER (WHERE phase = 'before') AS n_b
  FROM reviews r JOIN windows w ON r.written_date BETWEEN w.lo AND w.hi
  WHERE r.branch = 'F'
  GROUP BY w.event_id)
SELECT p.event_id, p.event || ' (' || strftime(p.start_date, '%Y-%m-%d') || ')' AS event_key,
       round(pol_d - pol_b, 6) AS review_polarity_change,
       round(rat_d - rat_b, 6) AS review_rating_change,
       coalesce(n_d, 0) - coalesce(n_b, 0) AS review_volume_change
FROM promos p LEFT JOIN agg a ON p.event_id = a.event_id"""


def change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns.change_in_reviews(reviews(spark, sf_dir, date_range=review_span()), promos(spark), BRANCH)


@register("campaign_change", CHANGE_SQL)
def campaign_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G26 (J6 + J7, F3 event key): during minus before per promo."""
    return change(spark, sf_dir)


# ------------------------------------------------------------------ statistics of the changes

_METRICS = ["review_polarity_change", "review_rating_change", "review_volume_change"]



def _change_cte() -> str:
    """The change table as a CTE named ``chg`` (body of CHANGE_SQL)."""
    body = CHANGE_SQL[len("WITH "):]
    head, final = body.rsplit("\nSELECT p.event_id", 1)
    return head + ",\nchg AS (SELECT p.event_id" + final + ")"


_LONG_CTE = """lng AS (
  SELECT event_id, 'review_polarity_change' AS metric, CAST(review_polarity_change AS DOUBLE) AS value FROM chg
  UNION ALL SELECT event_id, 'review_rating_change', CAST(review_rating_change AS DOUBLE) FROM chg
  UNION ALL SELECT event_id, 'review_volume_change', CAST(review_volume_change AS DOUBLE) FROM chg),
lv AS (SELECT * FROM lng WHERE value IS NOT NULL AND NOT isnan(value))"""


def _long(spark, sf_dir):
    from turnstile.operators.stattests import long_metrics
    c = change(spark, sf_dir).select("event_id", *[F.col(m).cast("double").alias(m) for m in _METRICS])
    return long_metrics(c, "event_id", _METRICS)


def _corr_pair_sql(a: str, b: str) -> str:
    return (f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(covar_pop({a}, {b}) / nullif("
            f"stddev_pop(CASE WHEN {b} IS NOT NULL THEN {a} END) * "
            f"stddev_pop(CASE WHEN {a} IS NOT NULL THEN {b} END), 0), 6) AS corr FROM chg")


@register("campaign_change_corr", "WITH " + _change_cte() + "\n" + "\nUNION ALL\n".join(
    _corr_pair_sql(a, b) for a in _METRICS for b in _METRICS))
def campaign_change_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G20 on the per-event changes (pairwise complete)."""
    from turnstile.operators.aggregates import corr_matrix_long
    c = change(spark, sf_dir).select(*[F.col(m).cast("double").alias(m) for m in _METRICS])
    return corr_matrix_long(c, _METRICS)


@register("campaign_ttest", "WITH " + _change_cte() + ",\n" + _LONG_CTE + """
SELECT metric, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd,
  round(avg(value) / (stddev_samp(value) / sqrt(count(*))), 6) AS t FROM lv GROUP BY metric""")
def campaign_ttest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: one-sample t statistic of each change metric against 0."""
    from turnstile.operators.stattests import t_test
    t = t_test(_long(spark, sf_dir))
    return t.select("metric", "n", *[F.round(c, 6).alias(c) for c in ["mean", "sd", "t"]])


@register("campaign_wilcoxon", "WITH " + _change_cte() + ",\n" + _LONG_CTE + """,
nz AS (SELECT metric, value, abs(value) AS a FROM lv WHERE value <> 0),
rk AS (SELECT *, rank() OVER (PARTITION BY metric ORDER BY a) + (count(*) OVER (PARTITION BY metric, a) - 1) / 2.0
  AS rnk, count(*) OVER (PARTITION BY metric, a) AS t FROM nz),
g AS (SELECT metric, count(*) AS n, sum(CASE WHEN value > 0 THEN rnk ELSE 0 END) AS w_plus,
  sum(CASE WHEN value < 0 THEN rnk ELSE 0 END) AS w_minus, sum((t * t * t - t) / t) AS tie_term FROM rk GROUP BY metric)
SELECT metric, n, round(w_plus, 6) AS w_plus, round(w_minus, 6) AS w_minus, round(least(w_plus, w_minus), 6) AS w,
  round((least(w_plus, w_minus) - n * (n + 1) / 4.0) /
        sqrt(n * (n + 1) * (2 * n + 1) / 24.0 - tie_term / 48.0), 6) AS z FROM g""")
def campaign_wilcoxon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: signed-rank statistic and its normal approximation."""
    from turnstile.operators.stattests import wilcoxon
    w = wilcoxon(_long(spark, sf_dir))
    return w.select("metric", "n", *[F.round(c, 6).alias(c) for c in ["w_plus", "w_minus", "w", "z"]])


def _poly_sql(coefficients, x: str) -> str:
    return "(" + " + ".join(f"({c!r}) * pow({x}, {i})" for i, c in enumerate(coefficients)) + ")"


def _score_sql(p: str) -> str:
    """Normal quantile of ``p`` as SQL text."""
    from turnstile.operators import stattests as ST

    near, q2 = f"least({p}, 1 - ({p}))", f"pow(least({p}, 1 - ({p})) - 0.5, 2)"
    t = f"sqrt(-2 * ln({near}))"
    middle = f"({near} - 0.5) * {_poly_sql(ST.QUANTILE_MIDDLE[0][::-1], q2)} / {_poly_sql(ST.QUANTILE_MIDDLE[1][::-1], q2)}"
    tail = f"{_poly_sql(ST.QUANTILE_TAIL[0][::-1], t)} / {_poly_sql(ST.QUANTILE_TAIL[1][::-1], t)}"
    return f"(sign({p} - 0.5) * -1 * CASE WHEN {near} < {ST.QUANTILE_TAIL_FROM} THEN {tail} ELSE {middle} END)"


def _shapiro_sql() -> str:
    from turnstile.operators import stattests as ST

    score = lambda i: _score_sql(f"(({i}) - 0.375) / (n + 0.25)")
    return f"""r AS (SELECT metric, value, count(*) OVER (PARTITION BY metric) AS n,
  row_number() OVER (PARTITION BY metric ORDER BY value) AS i, avg(value) OVER (PARTITION BY metric) AS mu FROM lv),
sc AS (SELECT *, {score('i')} AS m, {score('n')} AS mn, {score('n - 1')} AS mx FROM r),
ss AS (SELECT *, sum(m * m) OVER (PARTITION BY metric) AS mm FROM sc),
ow AS (SELECT *, mn / sqrt(mm) + {_poly_sql(ST.OUTER_WEIGHT, '(1 / sqrt(n))')} AS an,
  mx / sqrt(mm) + {_poly_sql(ST.NEXT_WEIGHT, '(1 / sqrt(n))')} AS ax FROM ss),
aw AS (SELECT *, CASE WHEN i = 1 THEN -an WHEN i = n THEN an WHEN i = 2 THEN -ax WHEN i = n - 1 THEN ax
  ELSE m / sqrt((mm - 2 * mn * mn - 2 * mx * mx) / (1 - 2 * an * an - 2 * ax * ax)) END AS a FROM ow WHERE n > 5),
sw AS (SELECT metric, pow(sum(a * (value - mu)), 2) / nullif(sum(pow(value - mu, 2)), 0) AS w FROM aw GROUP BY metric)"""


@register("campaign_normality", "WITH " + _change_cte() + ",\n" + _LONG_CTE + """,
mu AS (SELECT metric, avg(value) AS mu FROM lv GROUP BY metric),
m AS (SELECT lv.metric, count(*) AS n, avg(pow(value - mu, 2)) AS m2, avg(pow(value - mu, 3)) AS m3,
  avg(pow(value - mu, 4)) AS m4 FROM lv JOIN mu USING (metric) GROUP BY lv.metric),
s AS (SELECT metric, n, m3 / nullif(pow(m2, 1.5), 0) AS skewness, m4 / nullif(pow(m2, 2), 0) - 3.0 AS kurtosis FROM m),
""" + _shapiro_sql() + """
SELECT metric, n, round(skewness, 6) AS skewness, round(kurtosis, 6) AS kurtosis,
  round(n / 6.0 * (skewness * skewness + kurtosis * kurtosis / 4.0), 6) AS jb,
  CASE WHEN w IS NULL THEN 'none' ELSE 'shapiro-wilk' END AS gate, round(w, 6) AS statistic
FROM s LEFT JOIN sw USING (metric)""")
def campaign_normality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: Shapiro-Wilk normality statistic per metric (``gate`` says which test was used), beside the moments."""
    from turnstile.operators.stattests import jarque_bera, normality_gate
    lg = _long(spark, sf_dir)
    gate = normality_gate(lg).select("metric", "gate", F.round("statistic", 6).alias("statistic"))
    j = jarque_bera(lg).select("metric", "n", *[F.round(c, 6).alias(c) for c in ["skewness", "kurtosis", "jb"]])
    return j.join(gate, "metric")


@register("campaign_significance")
def campaign_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per metric, the normality gate (p > .05) picks the t-test or the
    signed-rank test; verdict at alpha .05.  ``gate`` and ``method`` say which forms were used."""
    from turnstile.operators import stattests as ST
    lg = _long(spark, sf_dir)
    t = ST.t_test(lg).select("metric", "n", "t")
    w = ST.wilcoxon(lg).select("metric", "z", "w", F.col("n").alias("n_signed"), "tie_term")
    j = ST.normality_gate(lg).select("metric", "gate", "p_normal")
    r = t.join(w, "metric", "left").join(j, "metric", "left")
    r = (r.withColumn("p_t", ST.t_pvalue(F.col("t"), (F.col("n") - 1).cast("double")))
         .withColumn("p_wilcoxon", ST.signed_rank_pvalue("w", F.col("n_signed").cast("double"), "z", "tie_term")))
    normal = F.coalesce(F.col("p_normal") > 0.05, F.lit(False))
    p = F.when(normal, F.col("p_t")).otherwise(F.col("p_wilcoxon"))
    method = F.when(~normal, ST.signed_rank_method(F.col("n_signed"), F.col("tie_term"))).otherwise("exact")
    return r.select("metric", "n", "gate", F.when(normal, "t-test").otherwise("wilcoxon").alias("test"), method.alias("method"),
                    F.round(p, 6).alias("p_value"),
                    F.when(p < 0.05, "significant change").otherwise("no significant change").alias("verdict"))
