"""The streaming session twin equals the batch sessions (all of them in
complete mode, the watermark-closed ones in append mode)."""

import datetime as dt

from pyspark.sql import functions as F

from turnstile.operators.ordered import gap_sessions
from turnstile.session import scratch_dir
from turnstile.streaming.sessions import run_stream_sessions

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)
# (user, minutes after T0): user 1 has two sessions, user 2 one, user 3 a late one
EVENTS = [(1, 0), (1, 10), (1, 25), (1, 120), (1, 130), (2, 5), (2, 40), (3, 300), (3, 310)]


def _events(spark):
    return spark.createDataFrame(
        [(i, T0 + dt.timedelta(minutes=m), u, "view", float(m)) for i, (u, m) in enumerate(EVENTS)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")


def _batch_sessions(ev):
    s = gap_sessions(ev.withColumnRenamed("user_id", "visitor"), "ts", "event_id", 30 * 60 - 1e-6,
                     key="visitor")
    return {(r.visitor, r.first_ts, r.n) for r in s.groupBy("visitor", "session_id").agg(
        F.min("ts").alias("first_ts"), F.count(F.lit(1)).alias("n")).collect()}


def _run(spark, mode):
    ev = _events(spark)
    base = scratch_dir(spark, "stream-test")
    ev.write.parquet(f"{base}/src")
    out = run_stream_sessions(spark, f"{base}/src", ev.schema, f"{base}/sink", f"{base}/ckpt",
                              key="user_id", ts="ts", value="value", gap="30 minutes",
                              watermark="1 hour", mode=mode)
    return ev, {(r.user_id, r.first_ts, r.n_events) for r in out.collect()}, out


def test_complete_mode_equals_batch(spark):
    ev, got, _ = _run(spark, "complete")
    assert got == _batch_sessions(ev)


def test_append_mode_emits_closed_sessions_only(spark):
    ev, got, out = _run(spark, "append")
    max_ts = T0 + dt.timedelta(minutes=310)
    watermark = max_ts - dt.timedelta(hours=1)
    all_sessions = _batch_sessions(ev)
    assert got <= all_sessions
    # every emitted session ended (last event + gap) at or before the watermark
    for r in out.collect():
        assert r.session_end <= watermark
    assert got, "at least one session closes before the watermark"
    assert (3, T0 + dt.timedelta(minutes=300), 2) not in got   # still open
