"""Driver tables and the role bindings the queries use.

Each binding is a lazy DataFrame over the parquet scan, so Catalyst prunes the
columns it does not need and pushes filters into the scan.  Bindings keep the
reference's roles (reviews, visit log, waits, survey, ...) over the TPC-H-like
driver tables; the same bindings are written in SQL in ``plans.sqlbind``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Documents with only the needed columns."""
    d = table(spark, sf_dir, "documents")
    return d.select(*cols) if cols else d


def reviews(spark: SparkSession, sf_dir: str, date_range=None) -> DataFrame:
    """Reviews role: (review_id, written_date, branch, rating, polarity).
    ``date_range=(first, last)`` (dates) filters the raw order date so the
    predicate reaches the parquet scan (row-group / partition pruning)."""
    o = table(spark, sf_dir, "orders")
    if date_range is not None:
        import datetime as _dt
        lo, hi = date_range
        o = o.where((o.o_orderdate >= F.lit(_dt.datetime.combine(lo, _dt.time())).cast("timestamp_ntz"))
                    & (o.o_orderdate < F.lit(_dt.datetime.combine(hi + _dt.timedelta(days=1), _dt.time()))
                       .cast("timestamp_ntz")))
    return o.select(
        o.o_orderkey.alias("review_id"),
        F.to_date(o.o_orderdate).alias("written_date"),
        o.o_orderstatus.alias("branch"),
        (F.lit(1) + o.o_orderkey % 5).alias("rating"),
        ((o.o_totalprice % 200 - 100) / 100).alias("polarity"),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit-log role: (event_id, visitor, ts, ride, wait)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        e.event_id,
        e.user_id.alias("visitor"),
        e.ts,
        e.event_type.alias("ride"),
        e.value.alias("wait"),
    )


def waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ride-wait role: one row per (slot, ride) with the max wait of the hour."""
    v = visits(spark, sf_dir)
    # date_trunc yields a session-time-zone timestamp: cast back to wall-clock time
    return (v.groupBy(F.date_trunc("hour", v.ts).cast("timestamp_ntz").alias("slot"), "ride")
            .agg(F.max("wait").alias("wait")))


def attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance role on the visit calendar: distinct visitors per day and ride."""
    v = visits(spark, sf_dir)
    return (v.groupBy(F.to_date("ts").alias("day"), F.col("ride").alias("facility"))
            .agg(F.count_distinct("visitor").alias("attendance")))


def order_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance role on the order calendar: (day, facility, attendance)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.to_date(o.o_orderdate).alias("day"),
                    o.o_orderstatus.alias("facility"),
                    o.o_totalprice.alias("attendance"))


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey role: one respondent per customer with region / nation answers."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation and region are fixed-size dimensions (25 and 5 rows)
    dims = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    return (c.join(F.broadcast(dims), c.c_nationkey == dims.n_nationkey, "left")
            .select(c.c_custkey.alias("respondent"), c.c_mktsegment.alias("segment"),
                    c.c_acctbal.alias("score"), c.c_nationkey.alias("nationkey"),
                    F.col("n_name").alias("nation"), F.col("r_name").alias("region")))
