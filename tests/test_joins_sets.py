"""Interval join, pair statistics, salted top-k, unions."""

import datetime as dt
import itertools

from pyspark.sql import Window
from pyspark.sql import functions as F

from turnstile.operators import sets as U
from turnstile.operators.campaigns import change_in_reviews
from turnstile.operators.joins import interval_join


def _d(s):
    return dt.date.fromisoformat(s)


def test_interval_join_paths_agree_and_handle_edges(spark):
    pts = spark.createDataFrame([(i, _d("2000-01-01") + dt.timedelta(days=i)) for i in range(120)],
                                "pid long, d date")
    iv = spark.createDataFrame([(1, _d("2000-01-10"), _d("2000-03-05")),   # spans three months
                                (2, _d("2000-02-01"), _d("2000-02-01")),   # one day
                                (3, _d("2000-03-01"), _d("2000-02-01")),   # empty (start > end)
                                (4, None, _d("2000-02-01"))],               # NULL bound
                               "iid long, lo date, hi date")
    a = interval_join(pts, iv, "d", "lo", "hi")
    b = interval_join(pts, iv, "d", "lo", "hi", shuffle=True)
    ka = sorted((r.pid, r.iid) for r in a.collect())
    kb = sorted((r.pid, r.iid) for r in b.collect())
    assert ka == kb
    brute = sorted((p, i) for p in range(120) for i, lo, hi in [(1, 9, 64), (2, 31, 31)] if lo <= p <= hi)
    assert ka == brute


def test_change_keeps_empty_windows(spark):
    rev = spark.createDataFrame([(1, _d("2000-01-05"), "F", 5, 0.5), (2, _d("2000-01-15"), "F", 1, -0.5)],
                                "review_id long, written_date date, branch string, rating long, polarity double")
    promos = spark.createDataFrame([(1, "x", _d("2000-01-10"), _d("2000-01-19")),
                                    (2, "y", _d("2030-01-01"), _d("2030-01-02"))],
                                   "event_id long, event string, start_date date, end_date date")
    out = {r.event_id: r for r in change_in_reviews(rev, promos, "F").collect()}
    assert out[1].review_rating_change == -4 and out[1].review_volume_change == 0
    assert out[2].review_polarity_change is None and out[2].review_volume_change == 0
    assert out[2].event_key == "y (2030-01-01)"


def test_pair_product_stats_equal_brute_force(spark):
    vals = [("a", float(x)) for x in [1, 2, 3, 4]] + [("b", 5.0), ("c", None), ("c", 2.0), ("c", 7.0)]
    df = spark.createDataFrame(vals, "g string, x double")
    got = {r.g: (r.n_pairs, r.mean_pair_product) for r in U.pair_product_stats(df, ["g"], "x").collect()}
    for g in "abc":
        xs = [x for k, x in vals if k == g and x is not None]
        prods = [a * b for a, b in itertools.combinations(xs, 2)]
        assert got[g][0] == len(prods)
        assert (got[g][1] is None) if not prods else abs(got[g][1] - sum(prods) / len(prods)) < 1e-12


def test_salted_top_k_equals_plain_window(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("g"), F.col("id"),
                                     ((F.col("id") * 7919) % 1000).alias("v"))
    order = [F.desc("v"), F.asc("id")]
    got = sorted((r.g, r.id, r.rnk) for r in U.top_k_per_group(df, ["g"], order, 4, "id", salts=8).collect())
    w = Window.partitionBy("g").orderBy(*order)
    want = sorted((r.g, r.id, r.rnk) for r in df.withColumn("rnk", F.row_number().over(w))
                  .where(F.col("rnk") <= 4).collect())
    assert got == want


def test_surrogate_ids_are_consecutive(spark):
    df = spark.range(0, 50).select((F.col("id") * 3).alias("k"))
    ids = sorted(r.sid for r in U.surrogate_ids(df, ["k"], 100).collect())
    assert ids == list(range(101, 151))


def test_outer_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k long, s string")
    b = spark.createDataFrame([(2, 3.5)], "k long, d double")
    rows = sorted(U.union_all(a, b, allow_missing=True).collect(), key=lambda r: r.k)
    assert rows[0].d is None and rows[1].s is None
