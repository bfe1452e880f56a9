"""Inactivity sessions of a visit stream (Structured Streaming twin of
the batch gap sessions W2).

``session_window(ts, gap)`` grouped per visitor with a watermark: in
``append`` mode a session is emitted once the watermark passes its end and
its state is dropped (late rows behind the watermark are ignored); in
``complete`` mode every session is re-emitted each trigger and no state is
dropped.  Results go to a parquet table through ``foreachBatch`` and the
query keeps its checkpoint under the shared checkpoint folder, so a
restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def session_aggregate(stream: DataFrame, key: str, ts: str, value: str, gap: str, watermark: str,
                      ride: str | None = None, row_id: str | None = None, limits: DataFrame | None = None) -> DataFrame:
    """Sessions of a stream.  With ``ride`` (and ``row_id`` for ties): the rides in time order; with ``limits``
    (static, one ``threshold`` per ride): the share of waits below their ride's threshold."""
    # the watermark needs a TIMESTAMP column (timestamp_ntz is refused)
    s = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
    more = []
    if ride is not None:
        visit = F.struct(F.col(ts).alias("t"), F.col(row_id).alias("i"), F.col(ride).alias("r"))
        more.append(F.transform(F.array_sort(F.collect_list(visit)), lambda x: x["r"]).alias("rides"))
    if limits is not None:
        s = s.join(limits.select(ride, "threshold"), ride, "left")
        low = F.coalesce(F.col(value) < F.col("threshold"), F.lit(False))
        more.append(F.avg(low.cast("int")).alias("express_share"))
    out = s.groupBy(F.session_window("_ts", gap).alias("session"), F.col(key)).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.avg(value).alias("avg_value"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"), *more)
    return out.select(key, F.col("session.start").cast("timestamp_ntz").alias("session_start"),
                      F.col("session.end").cast("timestamp_ntz").alias("session_end"),
                      *[c for c in out.columns if c not in ("session", key)])


def run_stream_sessions(spark: SparkSession, source: str, schema: StructType, sink: str,
                        checkpoint: str, key: str, ts: str, value: str, gap: str = "30 minutes",
                        watermark: str = "1 hour", mode: str = "append",
                        file_glob: str | None = None, **columns) -> DataFrame:
    """Run the session stream over everything available in the ``source``
    folder (files matching ``file_glob``; an ``availableNow`` trigger) and
    return the sink table.  ``columns``: as in ``session_aggregate``."""
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    stream = reader.parquet(source)
    agg = session_aggregate(stream, key, ts, value, gap, watermark, **columns)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        # idempotent under replay: complete mode rewrites the whole table,
        # append mode overwrites the folder of its own epoch
        if mode == "complete":
            batch.write.mode("overwrite").parquet(sink)
        else:
            batch.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    q = (agg.writeStream.outputMode(mode).foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if mode == "complete":
        return spark.read.parquet(sink)
    if not _exists(spark, sink):
        return spark.createDataFrame([], agg.schema)
    return spark.read.parquet(sink).drop("epoch")


def _exists(spark: SparkSession, path: str) -> bool:
    from turnstile.sources.files import path_exists
    return path_exists(spark, path)
