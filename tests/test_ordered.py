"""Bucketed sessions (W1/W2) and distributed row numbers."""

import datetime as dt

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from turnstile.operators.ordered import gap_sessions, global_row_number

T0 = dt.datetime(2024, 1, 1, 9, 0, 0)


def _visits(spark, rows):
    return spark.createDataFrame(
        [(i, k, T0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(rows)],
        "event_id long, visitor long, ts timestamp_ntz")


def _collect(df):
    return {r.event_id: (r.gap_seconds, r.session_id) for r in df.collect()}


def test_gap_exactly_threshold_stays_in_session(spark):
    v = _visits(spark, [(1, 0), (1, 1800), (1, 3601), (2, 0)])
    out = _collect(gap_sessions(v, "ts", "event_id", 1800, key="visitor"))
    assert out[0] == (0.0, 0)
    assert out[1] == (1800.0, 0)          # exactly the gap: same session
    assert out[2] == (1801.0, 1)          # one second more: new session
    assert out[3] == (0.0, 0)             # other key starts at 0


def one_window(df, gap, key=None):
    """The same by a single window per key."""
    w = (Window.partitionBy(key) if key else Window.partitionBy()).orderBy("ts", "event_id")
    g = df.withColumn("gap_seconds", F.coalesce(F.timestamp_diff("MICROSECOND", F.lag("ts").over(w), F.col("ts")) / 1e6, F.lit(0.0)))
    return g.withColumn("session_id", F.sum((F.col("gap_seconds") > gap).cast("long")).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))


@pytest.mark.parametrize("bucket", [1, 1000, 3600, 86_400, 10 ** 9])
def test_hot_key_matches_one_window_for_any_bucket(spark, bucket):
    # one visitor holds 95 % of the rows; NULL keys and NULL times as well
    rows = [(7, i * 1000 + (900 if i % 5 == 0 else 0)) for i in range(1200)]
    rows += [(k, s) for k in range(20) for s in (0, 50, 4000)]
    v = _visits(spark, rows + [(None, 10), (None, 5000), (None, 5000)])
    nulls = spark.createDataFrame([(90001, 7, None), (90002, None, None), (90003, 7, None)], v.schema)
    v = v.unionByName(nulls)
    for key in ("visitor", None):
        got = gap_sessions(v, "ts", "event_id", 1800, key=key, bucket_seconds=bucket)
        assert _collect(got) == _collect(one_window(v, 1800, key))


def test_global_timeline_plan(spark):
    v = _visits(spark, [(0, s) for s in (0, 10, 4000, 4005, 9000, 9001, 200_000)])
    got = gap_sessions(v, "ts", "event_id", 1800, key=None)
    assert _collect(got) == _collect(one_window(v, 1800))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "SinglePartition" not in plan


def test_sessions_partition_the_rows(spark):
    v = _visits(spark, [(k % 3, k * 700) for k in range(60)])
    s = gap_sessions(v, "ts", "event_id", 1800, key="visitor")
    assert s.count() == 60
    assert s.select("event_id").distinct().count() == 60


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 500).select((F.col("id") % 7).alias("a"), (F.col("id") * 13 % 101).alias("b"), "id")
    order = [F.col("a").asc(), F.col("b").desc(), F.col("id").asc()]
    got = {r.id: r.rn for r in global_row_number(df, order, num_partitions=6).collect()}
    want = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == want
