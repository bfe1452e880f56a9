"""Ordered work over a (possibly skewed) key: gap to the previous row (W1),
inactivity sessions (W2) and exact row numbers.

Rows of a key are never ordered in one task.  A session scan cuts every key into time buckets: gaps and
counts inside a bucket are plain JVM windows over ``(key, bucket)``, and one
summary row per ``(key, bucket)`` carries the last time and the number of
session starts to the next bucket.  The bucket width changes the split of the
work, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.session import scratch_dir


def _seconds(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", earlier, later) / 1e6


def gap_sessions(df: DataFrame, ts: str, tiebreak: str, gap_seconds: float,
                 key: str | None = None, gap_col: str = "gap_seconds", session_col: str = "session_id",
                 bucket_seconds: int = 86_400) -> DataFrame:
    """W1 + W2: add ``gap_col`` (seconds since the previous row of the same
    key in ``(ts, tiebreak)`` order, 0 for a key's first row) and
    ``session_col`` (0-based count of gaps ``> gap_seconds`` so far within the
    key).  ``key=None`` is one global timeline.  A gap of exactly
    ``gap_seconds`` stays in the session.

    NULL keys are one key.  NULL times come first in their key, with gap 0, and so
    has the row after them.  ``bucket_seconds`` is how a key is split."""
    # one struct column as the key: its NULL fields are equal to each other in joins
    bucket = F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts)) / bucket_seconds)
    of_key = F.struct((F.col(key) if key is not None else F.lit(0)).alias("key"))
    rows = df.withColumn("_part", F.struct(of_key.alias("k"), bucket.alias("b")))
    inside = Window.partitionBy("_part").orderBy(ts, tiebreak)
    rows = rows.withColumn("_gap", _seconds(F.col(ts), F.lag(ts).over(inside)))
    rows = rows.withColumn("_starts", F.sum(F.coalesce((F.col("_gap") > gap_seconds).cast("long"), F.lit(0))).over(
        inside.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_first", F.row_number().over(inside) == 1)

    # one row per (key, bucket)
    summary = rows.groupBy("_part").agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), F.max("_starts").alias("_n"))
    before = Window.partitionBy("_part.k").orderBy(F.col("_part.b").asc_nulls_first())
    summary = summary.withColumn("_carried", _seconds(F.col("_lo"), F.lag("_hi").over(before)))
    entry = F.coalesce((F.col("_carried") > gap_seconds).cast("long"), F.lit(0))
    summary = summary.withColumn("_offset", F.sum(F.col("_n") + entry).over(
        before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
    out = rows.join(summary.select("_part", "_carried", "_offset"), "_part")
    gap = F.coalesce(F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_gap")), F.lit(0.0))
    return out.select(*df.columns, gap.alias(gap_col), (F.col("_offset") + F.col("_starts")).cast("long").alias(session_col))


def global_row_number(df: DataFrame, order: list, out: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """Exact 1-based row number of ``df`` in ``order`` without a
    single-partition window: range-partitioned sort, a local index per
    partition, and per-partition offsets from the bounded partition-count
    summary.  ``order`` must be a total order (end with a unique key) so that
    recomputation gives the same numbering."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    # after the range shuffle and the in-partition sort, monotonically_increasing_id
    # is (partition << 33) + position in the partition: the local index, JVM-side
    local = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
             .withColumn("_mid", F.monotonically_increasing_id())
             .withColumn("_pid", F.shiftright(F.col("_mid"), 33).cast("int"))
             .withColumn("_lidx", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33) + 1)
             .drop("_mid"))
    path = scratch_dir(spark, "row-number")
    local.write.parquet(path)
    rows = spark.read.parquet(path)
    counts = rows.groupBy("_pid").agg(F.max("_lidx").alias("_cnt"))
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = rows.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")  # one row per partition
    return j.withColumn(out, F.col("_off") + F.col("_lidx")).select(*df.columns, out)
