"""SURVEY §5 invariants on the driver data (sf0.001)."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as entry
from turnstile.plans.io import STREAM_WATERMARK_S

from .conftest import SF_SMALL

Q = entry.queries()


def test_frequencies_sum_to_one(spark):
    r = Q["relative_frequency"](spark, SF_SMALL).agg(F.sum("share").alias("s"), F.sum("pct").alias("p")).first()
    assert abs(r.s - 1) < 1e-5 and abs(r.p - 100) < 0.05


def test_each_day_has_exactly_one_day_type(spark):
    d = Q["day_type"](spark, SF_SMALL)
    days = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(F.to_date("ts").alias("day")).distinct()
    assert d.count() == days.count() == d.select("day").distinct().count()
    assert {r.day_type for r in d.select("day_type").distinct().collect()} <= {"quiet", "busy", "covid", "normal"}


def test_transition_rows_are_stochastic(spark):
    t = Q["transition_matrix"](spark, SF_SMALL).groupBy("from_ride").agg(F.sum("p").alias("s"))
    assert all(abs(r.s - 1) < 1e-5 or r.s == 0 for r in t.collect())


def test_steady_state_is_a_distribution(spark):
    pi = [r.pi for r in Q["steady_state"](spark, SF_SMALL).collect()]
    assert abs(sum(pi) - 1) < 1e-5 and min(pi) >= 0


def test_sessions_partition_visits_and_visit_counts_add_up(spark):
    s = Q["sessions"](spark, SF_SMALL)
    v = Q["visit_summary"](spark, SF_SMALL)
    assert s.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert v.agg(F.sum("n_rides")).first()[0] == s.count()
    assert v.count() == s.select("visitor", "session_id").distinct().count()


def test_closed_stream_sessions_hold_their_events(spark):
    # append mode: only sessions that the watermark has closed
    st = Q["stream_sessions"](spark, SF_SMALL)
    rows = st.collect()
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    end = ev.agg(F.max("ts")).first()[0]
    assert rows and all(len(r.rides) == r.n_events and 0 <= r.express_share <= 1 for r in rows)
    assert all(r.session_end <= end - dt.timedelta(seconds=STREAM_WATERMARK_S) for r in rows)
    closed = ev.where(F.col("ts") < F.lit(end - dt.timedelta(days=30)))
    assert closed.count() <= sum(r.n_events for r in rows) <= ev.count()
