"""Campaign before/during comparison.

One long table of review windows replaces the reference's two dicts of
frames: every promo contributes a ``during`` window ``[start, end]`` and a
``before`` window ``[start - duration, start - 1 day]`` (duration in days).
Reviews are interval-joined once against all windows, aggregated once per
(event, phase), and pivoted by conditional aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.operators.joins import interval_join


def event_key(name_col: str = "event", start_col: str = "start_date"):
    """``name (yyyy-mm-dd)``."""
    return F.format_string("%s (%s)", F.col(name_col),
                           F.date_format(F.col(start_col), "yyyy-MM-dd"))


def review_windows(promos: DataFrame) -> DataFrame:
    """(event_id, event_key, phase, lo, hi) - two windows per promo."""
    p = promos.withColumn("duration", F.datediff("end_date", "start_date"))
    during = p.select("event_id", event_key().alias("event_key"),
                      F.lit("during").alias("phase"),
                      F.col("start_date").alias("lo"), F.col("end_date").alias("hi"))
    before = p.select("event_id", event_key().alias("event_key"),
                      F.lit("before").alias("phase"),
                      F.date_sub("start_date", F.col("duration")).alias("lo"),
                      F.date_sub("start_date", 1).alias("hi"))
    return during.unionByName(before)


def reviews_in_windows(reviews: DataFrame, promos: DataFrame, branch: str | None,
                       phase: str | None = None) -> DataFrame:
    """J6 (phase='during') / J7 (phase='before') / both (phase=None)."""
    w = review_windows(promos)
    if phase is not None:
        w = w.where(F.col("phase") == phase)
    r = reviews if branch is None else reviews.where(F.col("branch") == branch)
    return interval_join(r, w, "written_date", "lo", "hi")


def change_in_reviews(reviews: DataFrame, promos: DataFrame,
                      branch: str | None) -> DataFrame:
    """Per promo, during minus before of mean polarity, mean rating and
    review count.  Empty windows give a NULL mean and a count of 0."""
    j = reviews_in_windows(reviews, promos, branch)
    d = F.col("phase") == "during"
    b = F.col("phase") == "before"
    agg = j.groupBy("event_id").agg(
        F.avg(F.when(d, F.col("polarity"))).alias("pol_d"),
        F.avg(F.when(b, F.col("polarity"))).alias("pol_b"),
        F.avg(F.when(d, F.col("rating"))).alias("rat_d"),
        F.avg(F.when(b, F.col("rating"))).alias("rat_b"),
        F.count(F.when(d, 1)).alias("n_d"),
        F.count(F.when(b, 1)).alias("n_b"),
    )
    # promos is a dimension of events (one row each): the aggregate is joined
    # back to it so that promos without any review keep their row
    keys = promos.select("event_id", event_key().alias("event_key"))
    out = keys.join(agg, "event_id", "left")
    return out.select(
        "event_id", "event_key",
        F.round(F.col("pol_d") - F.col("pol_b"), 6).alias("review_polarity_change"),
        F.round(F.col("rat_d") - F.col("rat_b"), 6).alias("review_rating_change"),
        (F.coalesce(F.col("n_d"), F.lit(0)) - F.coalesce(F.col("n_b"), F.lit(0)))
        .alias("review_volume_change"),
    )
