"""Survey statistics.

Survey role = customer x nation x region (see ``sources.tables.survey``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnstile.functions.scalars import contains_flag, safe_corr
from turnstile.operators import aggregates as A
from turnstile.operators.joins import maybe_broadcast
from turnstile.plans.registry import register
from turnstile.plans.sqlbind import REVIEWS, SURVEY, VISITS, with_ctes
from turnstile.sources.tables import reviews, survey, table, visits


_sql = with_ctes


@register("filtered_mean", _sql("""SELECT count(*) AS n, round(avg(score), 6) AS mean_score
FROM survey WHERE coalesce(contains(segment, 'BUILD'), false)""", SURVEY))
def filtered_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + P9: mean over a substring-filtered subset (NULL = no match)."""
    s = survey(spark, sf_dir)
    return s.where(contains_flag("segment", "BUILD")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean_score"))


@register("group_mean", _sql("""SELECT region, segment, round(avg(score), 6) AS mean_score
FROM survey WHERE region IS NOT NULL AND segment IS NOT NULL GROUP BY region, segment""", SURVEY))
def group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = A.drop_null_keys(survey(spark, sf_dir), ["region", "segment"])
    return s.groupBy("region", "segment").agg(F.round(F.avg("score"), 6).alias("mean_score"))


@register("value_counts", _sql("""SELECT nation, count(*) AS n FROM survey
WHERE nation IS NOT NULL GROUP BY nation""", SURVEY))
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = A.drop_null_keys(survey(spark, sf_dir), ["nation"])
    return s.groupBy("nation").agg(F.count(F.lit(1)).alias("n"))


@register("relative_frequency", _sql("""SELECT segment, n, round(n / sum(n) OVER (), 6) AS share,
       round(100.0 * n / sum(n) OVER (), 2) AS pct
FROM (SELECT segment, count(*) AS n FROM survey WHERE segment IS NOT NULL GROUP BY segment)""", SURVEY))
def relative_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares over non-null values, with the rounded percent."""
    f = A.relative_frequency(survey(spark, sf_dir), "segment", "n", "share")
    return f.select("segment", "n", F.round("share", 6).alias("share"),
                    F.round(F.col("share") * 100.0, 2).alias("pct"))


@register("top_k", _sql("""SELECT nation, n, rnk FROM (
  SELECT nation, n, row_number() OVER (ORDER BY n DESC, nation) AS rnk
  FROM (SELECT nation, count(*) AS n FROM survey WHERE nation IS NOT NULL GROUP BY nation))
WHERE rnk <= 5""", SURVEY))
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: top 5 nations by respondents (TakeOrderedAndProject), rank attached
    over the 5 kept rows."""
    s = A.drop_null_keys(survey(spark, sf_dir), ["nation"])
    top = s.groupBy("nation").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), "nation").limit(5)
    return top.withColumn("rnk", F.row_number().over(Window.orderBy(F.desc("n"), "nation")).cast("long"))


@register("corr_pair", _sql("""SELECT region, round(covar_pop(score, nationkey) /
  nullif(stddev_pop(CASE WHEN nationkey IS NOT NULL THEN score END) *
         stddev_pop(CASE WHEN score IS NOT NULL THEN nationkey END), 0), 6) AS corr
FROM survey WHERE region IS NOT NULL GROUP BY region""", SURVEY))
def corr_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = A.drop_null_keys(survey(spark, sf_dir), ["region"])
    return s.groupBy("region").agg(F.round(safe_corr("score", "nationkey"), 6).alias("corr"))


_LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql(a: str, b: str, src: str) -> str:
    return (f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(covar_pop({a}, {b}) / nullif("
            f"stddev_pop(CASE WHEN {b} IS NOT NULL THEN {a} END) * "
            f"stddev_pop(CASE WHEN {a} IS NOT NULL THEN {b} END), 0), 6) AS corr FROM {src}")


@register("corr_matrix_long", "\nUNION ALL\n".join(
    _corr_sql(a, b, "lineitem") for a in _LI_COLS for b in _LI_COLS))
def corr_matrix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.corr_matrix_long(table(spark, sf_dir, "lineitem"), _LI_COLS)


@register("category_codes_corr", _sql("""codes AS (
  SELECT segment, dense_rank() OVER (ORDER BY segment) - 1 AS code
  FROM (SELECT DISTINCT segment FROM survey WHERE segment IS NOT NULL)),
coded AS (SELECT coalesce(c.code, -1) AS code, s.score FROM survey s LEFT JOIN codes c USING (segment))
SELECT round(covar_pop(code, score) / nullif(stddev_pop(CASE WHEN score IS NOT NULL THEN code END) *
       stddev_pop(CASE WHEN code IS NOT NULL THEN score END), 0), 6) AS corr FROM coded""", SURVEY))
def category_codes_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F21 + G19: category codes (sorted distinct, NULL = -1) against the score."""
    s = survey(spark, sf_dir)
    codes = (s.select("segment").where(F.col("segment").isNotNull()).distinct()
             .withColumn("code", F.dense_rank().over(Window.orderBy("segment")) - 1))
    coded = s.join(maybe_broadcast(codes), "segment", "left") \
        .withColumn("code", F.coalesce(F.col("code"), F.lit(-1)))
    return coded.agg(F.round(safe_corr("code", "score"), 6).alias("corr"))


def _recommend():
    return F.when(F.col("score") >= 4500, "Yes").when(F.col("score") < 1000, "No")
_RECOMMEND_SQL = "CASE WHEN score >= 4500 THEN 'Yes' WHEN score < 1000 THEN 'No' END"


@register("nps", _sql(f"""SELECT region, round(100.0 * (count(*) FILTER (WHERE rec = 'Yes')
   - count(*) FILTER (WHERE rec = 'No')) / nullif(count(rec), 0), 6) AS nps
FROM (SELECT region, {_RECOMMEND_SQL} AS rec FROM survey) WHERE region IS NOT NULL GROUP BY region""",
                      SURVEY))
def nps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net promoter score per region."""
    s = A.drop_null_keys(survey(spark, sf_dir), ["region"]).withColumn("rec", _recommend())
    return s.groupBy("region").agg(F.round(A.nps("rec"), 6).alias("nps"))


@register("kpi_ratio", _sql("""SELECT segment, round(avg(CASE WHEN score > 0 THEN 1 ELSE 0 END), 6) AS ratio
FROM survey WHERE segment IS NOT NULL GROUP BY segment""", SURVEY))
def kpi_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of a boolean per group."""
    s = A.drop_null_keys(survey(spark, sf_dir), ["segment"])
    return s.groupBy("segment").agg(
        F.round(F.avg(F.coalesce(F.col("score") > 0, F.lit(False)).cast("int")), 6).alias("ratio"))


@register("box_summary", _sql("""q AS (
  SELECT segment, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS median,
         quantile_cont(score, 0.75) AS q3
  FROM survey WHERE segment IS NOT NULL AND score IS NOT NULL GROUP BY segment),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q)
SELECT f.segment, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr, round(lo_fence, 6) AS lo_fence, round(hi_fence, 6) AS hi_fence,
       round(min(score) FILTER (WHERE score BETWEEN lo_fence AND hi_fence), 6) AS whisker_lo,
       round(max(score) FILTER (WHERE score BETWEEN lo_fence AND hi_fence), 6) AS whisker_hi,
       count(*) FILTER (WHERE NOT (score BETWEEN lo_fence AND hi_fence)) AS n_outliers,
       count(*) AS n
FROM survey s JOIN f USING (segment) WHERE s.score IS NOT NULL
GROUP BY f.segment, q1, median, q3, iqr, lo_fence, hi_fence""", SURVEY))
def box_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box-plot data per segment."""
    b = A.box_summary(survey(spark, sf_dir), "segment", "score")
    return b.select("segment", *[F.round(c, 6).alias(c) for c in
                                 ["q1", "median", "q3", "iqr", "lo_fence", "hi_fence",
                                  "whisker_lo", "whisker_hi"]], "n_outliers", "n")


@register("histogram", _sql("""SELECT bin, round(CAST(-1.0 AS DOUBLE) + bin * CAST(0.1 AS DOUBLE), 6) AS bin_lo, count(*) AS count FROM (
  SELECT CASE WHEN polarity = 1.0 THEN 19 ELSE CAST(floor((polarity - (-1.0)) / 0.1) AS BIGINT) END AS bin
  FROM reviews WHERE polarity BETWEEN -1.0 AND 1.0) GROUP BY bin""", REVIEWS))
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-width polarity histogram, last bin closed."""
    h = A.histogram(reviews(spark, sf_dir), "polarity", -1.0, 1.0, 0.1)
    return h.select("bin", "bin_lo", "count")


@register("minmax_scale", _sql("""SELECT respondent,
  round((score - min(score) OVER ()) / nullif(max(score) OVER () - min(score) OVER (), 0), 6) AS scaled
FROM survey""", SURVEY))
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The global min / max come back as a one-row finaliser."""
    s = survey(spark, sf_dir)
    r = A.scalar_row(s, F.min("score").alias("lo"), F.max("score").alias("hi"))
    lo, hi = r["lo"], r["hi"]
    rng = None if lo is None or hi is None or hi == lo else float(hi - lo)
    scaled = (F.col("score") - F.lit(lo)) / F.lit(rng) if rng else F.lit(None).cast("double")
    return s.select("respondent", F.round(scaled, 6).alias("scaled"))


@register("mean_impute", _sql("""SELECT event_id, ride,
  round(coalesce(CASE WHEN ride <> 'error' THEN wait END,
                 avg(CASE WHEN ride <> 'error' THEN wait END) OVER ()), 6) AS wait_imputed
FROM visits""", VISITS))
def mean_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of the 'error' ride are missing; fill with the mean of
    the others (scalar finaliser, then a literal)."""
    v = visits(spark, sf_dir).withColumn(
        "w", F.when(F.col("ride") != "error", F.col("wait")))
    mean = A.scalar_row(v, F.avg("w").alias("m"))["m"]
    return v.select("event_id", "ride",
                    F.round(F.coalesce(F.col("w"), F.lit(mean)), 6).alias("wait_imputed"))


def _mode_sql(col: str, key: str = "segment", src: str = "survey") -> str:
    return f"""(SELECT {key}, {col} AS mode_{col} FROM (
  SELECT {key}, {col}, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {col}) AS rn
  FROM {src} WHERE {key} IS NOT NULL AND {col} IS NOT NULL GROUP BY {key}, {col}) WHERE rn = 1)"""


@register("mode_per_group", _sql("SELECT * FROM " + _mode_sql("nation"), SURVEY))
def mode_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent value per group, ties to the lowest."""
    s = A.drop_null_keys(survey(spark, sf_dir), ["segment"])
    return s.groupBy("segment").agg(A.mode_of("nation").alias("mode_nation"))


def _band():
    return (F.when(F.col("score") < 0, "negative").when(F.col("score") < 5000, "standard")
            .when(F.col("score").isNotNull(), "high"))
_BAND_SQL = ("CASE WHEN score < 0 THEN 'negative' WHEN score < 5000 THEN 'standard' "
             "WHEN score IS NOT NULL THEN 'high' END")
_SURVEY_BANDED = f"banded AS (SELECT *, {_BAND_SQL} AS band FROM survey)"


@register("segment_profile", _sql(f"""stats AS (
  SELECT segment, round_even(100.0 * avg(CASE WHEN score > 0 THEN 1 ELSE 0 END), 2) AS positive_pct,
         round_even(avg(score), 2) AS mean_score, count(*) AS size
  FROM banded WHERE segment IS NOT NULL GROUP BY segment)
SELECT s.segment, r.mode_region, n.mode_nation, b.mode_band, s.positive_pct, s.mean_score, s.size,
       CASE WHEN s.mean_score >= 4500 THEN 'High balance'
            WHEN s.positive_pct < 90 THEN 'Mixed balance' ELSE 'Standard' END AS profile
FROM stats s JOIN {_mode_sql('region', src='banded')} r USING (segment)
JOIN {_mode_sql('nation', src='banded')} n USING (segment)
JOIN {_mode_sql('band', src='banded')} b USING (segment)""", SURVEY, _SURVEY_BANDED))
def segment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three modes, share, mean, size; the name follows the profile."""
    s = A.drop_null_keys(survey(spark, sf_dir), ["segment"]).withColumn("band", _band())
    g = s.groupBy("segment").agg(
        A.mode_of("region").alias("mode_region"), A.mode_of("nation").alias("mode_nation"),
        A.mode_of("band").alias("mode_band"),
        F.bround(100.0 * F.avg(F.coalesce(F.col("score") > 0, F.lit(False)).cast("int")), 2)
        .alias("positive_pct"),
        F.bround(F.avg("score"), 2).alias("mean_score"), F.count(F.lit(1)).alias("size"))
    return g.withColumn("profile", F.when(F.col("mean_score") >= 4500, "High balance")
                        .when(F.col("positive_pct") < 90, "Mixed balance").otherwise("Standard"))


@register("segment_responses", _sql("""SELECT segment, region, count(*) AS n FROM survey
WHERE segment IS NOT NULL AND region IS NOT NULL GROUP BY segment, region""", SURVEY))
def segment_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by (segment, answer) for grouped bars."""
    s = A.drop_null_keys(survey(spark, sf_dir), ["segment", "region"])
    return s.groupBy("segment", "region").agg(F.count(F.lit(1)).alias("n"))


@register("segment_top_answer", _sql(f"""SELECT r.segment, r.mode_region, n.mode_nation, b.mode_band
FROM {_mode_sql('region', src='banded')} r JOIN {_mode_sql('nation', src='banded')} n USING (segment)
JOIN {_mode_sql('band', src='banded')} b USING (segment)""", SURVEY, _SURVEY_BANDED))
def segment_top_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top answer per segment for three questions."""
    s = A.drop_null_keys(survey(spark, sf_dir), ["segment"]).withColumn("band", _band())
    return s.groupBy("segment").agg(A.mode_of("region").alias("mode_region"),
                                    A.mode_of("nation").alias("mode_nation"),
                                    A.mode_of("band").alias("mode_band"))


@register("conditional_share", _sql("""SELECT region,
  round(100.0 * avg(CASE WHEN score > 5000 THEN 1 ELSE 0 END), 6) AS share_pct
FROM survey WHERE region IS NOT NULL GROUP BY region""", SURVEY))
def conditional_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G11."""
    s = A.drop_null_keys(survey(spark, sf_dir), ["region"])
    return s.groupBy("region").agg(F.round(100.0 * F.avg(
        F.coalesce(F.col("score") > 5000, F.lit(False)).cast("int")), 6).alias("share_pct"))
