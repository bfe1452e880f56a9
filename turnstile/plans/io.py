"""Source / sink queries (S1-S10) and the streaming session twin.

Every written table goes to a fresh folder under the session's checkpoint
folder and is read back; the checked rows are the read-back rows.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.plans.registry import register
from turnstile.session import scratch_dir
from turnstile.sources import files as IO
from turnstile.sources.tables import table
from turnstile.streaming.sessions import run_stream_sessions

_ORDERS_CSV_SCHEMA = "o_orderkey long, o_orderstatus string, o_totalprice string, o_orderdate date, note string"


@register("csv_roundtrip", """SELECT o_orderkey, o_orderstatus, printf('%.2f', o_totalprice) AS o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority || ', "' || o_orderstatus || '"' AS note FROM orders""")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S6: CSV sink (2-digit float format, quoted text with commas and
    quotes) and CSV scan with an explicit schema."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"),
        F.concat("o_orderpriority", F.lit(', "'), "o_orderstatus", F.lit('"')).alias("note"))
    path = scratch_dir(spark, "csv")
    IO.write_csv(o, path, float_digits=2)
    return IO.read_csv(spark, path, _ORDERS_CSV_SCHEMA, escape='"')


@register("dirty_csv", """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0
  THEN 'caf' || chr(65533) || ', "' || o_orderstatus || '"' ELSE 'a "quoted", ' || o_orderstatus END AS note
FROM orders WHERE o_orderpriority <> '5-LOW'""")
def dirty_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files with malformed (short) low-priority lines.  One is quoted and holds Latin-1 bytes that
    are no UTF-8; the other has stray quotes and backslash-escaped commas and is read by the retry."""
    o = table(spark, sf_dir, "orders")
    low = F.col("o_orderpriority") == "5-LOW"
    path = scratch_dir(spark, "dirty-csv")
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string")
    note = F.concat(F.lit('"caf\u00e9, \\"'), "o_orderstatus", F.lit('\\""'))
    quoted = F.when(low, F.concat_ws(",", key, F.lit("n/a"))).otherwise(F.concat_ws(",", key, price, note))
    (o.where("o_orderkey % 2 = 0").select(quoted.alias("value")).write.option("encoding", "ISO-8859-1").option("quote", "")
     .option("sep", "\u0001").option("escape", "").csv(f"{path}/quoted"))
    note = F.concat(F.lit('a "quoted"\\, '), "o_orderstatus")
    plain = F.when(low, F.concat_ws(",", key, F.lit("n/a"))).otherwise(F.concat_ws(",", key, price, note))
    o.where("o_orderkey % 2 <> 0").select(plain.alias("value")).write.text(f"{path}/plain")
    first = IO.read_dirty_csv(spark, f"{path}/quoted", "o_orderkey long, o_totalprice double, note string", header=False)
    retry = IO.read_unquoted_csv(spark, f"{path}/plain", [("o_orderkey", "long"), ("o_totalprice", "double"), ("note", "string")])
    return first.unionByName(retry)


_MONTH_SQL = """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, round(sum(o_totalprice), 2) AS total_sales,
  count(*) AS visitors FROM orders GROUP BY 1"""


@register("sheet_export", _MONTH_SQL)
def sheet_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 re-aimed: monthly sheet with 6 banner lines, a header, dates as
    ``yyyy年M月`` (some with a blank after 年) and a trailing empty column; the
    rows are kept by an anchored date pattern, the blank is removed and the
    date parsed (F7, F10, P10)."""
    o = table(spark, sf_dir, "orders")
    m = o.groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total_sales"), F.count(F.lit(1)).alias("visitors"))
    sep = F.when(F.month("month") % 2 == 0, F.lit("年 ")).otherwise(F.lit("年"))
    label = F.concat(F.year("month").cast("string"), sep, F.month("month").cast("string"), F.lit("月"))
    body = m.select(F.concat_ws(",", label, F.format_string("%.2f", "total_sales"),
                                F.col("visitors").cast("string"), F.lit("")).alias("value"))
    banner = spark.createDataFrame([(f"banner line {i}",) for i in range(6)] + [("date,total_sales,visitors,",)],
                                   "value string")
    path = scratch_dir(spark, "sheet")
    banner.unionByName(body).write.text(path)
    rows = IO.sheet_rows(spark, path, 3, r"^\d{4}年\s?\d{1,2}月$", ["date", "total_sales", "visitors"],
                         total_cols=4)
    d = F.regexp_replace("date", "年 ", "年")
    return rows.select(F.to_date(F.try_to_timestamp(d, F.lit("yyyy年M月"))).alias("month"),
                       F.col("total_sales").try_cast("double").alias("total_sales"),
                       F.col("visitors").try_cast("long").alias("visitors"))


@register("parquet_roundtrip", """SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'O'""")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot partitioned by status, read back with a pruned partition."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = scratch_dir(spark, "parquet")
    IO.write_parquet(o, path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path).where(F.col("o_orderstatus") == "O") \
        .select("o_orderkey", "o_totalprice", "o_orderstatus")


@register("model_roundtrip", "SELECT count(*) AS n, count(*) AS n_equal FROM lineitem")
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted pipeline saved, loaded and re-scored; the loaded model
    must give the same predictions."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                                                 "l_extendedprice")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features"),
                            LinearRegression(featuresCol="features", labelCol="l_extendedprice")])
    model = pipe.fit(li)
    path = scratch_dir(spark, "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    first = model.transform(li).withColumnRenamed("prediction", "p1").drop("features")
    both = loaded.transform(first).withColumnRenamed("prediction", "p2")  # both scores in the row itself
    return both.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("p1") == F.col("p2")).cast("long")).alias("n_equal"))


@register("cached_source", """SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders FROM orders GROUP BY 1""")
def cached_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first read computes and writes the daily table, the second
    finds it and reads it."""
    path = scratch_dir(spark, "cached")

    def compute():
        o = table(spark, sf_dir, "orders")
        return o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n_orders"))

    IO.cached_source(spark, path, compute)
    return IO.cached_source(spark, path, compute)


@register("optional_source", """SELECT o_orderkey AS review_id, o_orderstatus AS branch FROM orders""")
def optional_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of the present review sources; the missing optional one is
    skipped with a warning."""
    srcs = [IO.optional_source(spark, f"{sf_dir}/orders.parquet", lambda p: spark.read.parquet(p)),
            IO.optional_source(spark, f"{sf_dir}/no_such_reviews.parquet", lambda p: spark.read.parquet(p))]
    present = [s.select(F.col("o_orderkey").alias("review_id"), F.col("o_orderstatus").alias("branch"))
               for s in srcs if s is not None]
    out = present[0]
    for s in present[1:]:
        out = out.unionByName(s)
    return out


@register("preview", """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A returned preview in an explicit order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return IO.preview(o, [F.desc("o_totalprice"), "o_orderkey"])


# ------------------------------------------------------------------ streaming

STREAM_GAP_S = 6 * 3600
STREAM_WATERMARK_S = 6 * 3600


@register("stream_sessions", f"""WITH g AS (
  SELECT user_id, event_id, ts, event_type, value, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w), 0) / 1000000 AS gap
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CASE WHEN gap >= {STREAM_GAP_S} THEN 1 ELSE 0 END) OVER (
  PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g),
t AS (SELECT event_type, quantile_cont(value, 0.25) AS thr FROM events GROUP BY event_type),
j AS (SELECT s.*, coalesce(value < thr, false) AS low FROM s LEFT JOIN t USING (event_type))
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL {STREAM_GAP_S} SECOND AS session_end,
  count(*) AS n_events, round(avg(value), 6) AS avg_value, min(ts) AS first_ts, max(ts) AS last_ts,
  list(event_type ORDER BY ts, event_id) AS rides, round(avg(low::INTEGER), 6) AS express_share
FROM j GROUP BY user_id, sid
HAVING max(ts) + INTERVAL {STREAM_GAP_S} SECOND <= (SELECT max(ts) FROM events) - INTERVAL {STREAM_WATERMARK_S} SECOND""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 in append mode over the events table: every session that the watermark has closed, with its rides in
    order and the share of short waits (below the ride's first quartile).  State is dropped as sessions
    close.  Spark's session window closes a session when the next event is at least ``gap`` later."""
    from turnstile.operators.aggregates import group_quantiles
    events = table(spark, sf_dir, "events")
    limits = group_quantiles(events, ["event_type"], "value", [0.25], ["threshold"])
    base = scratch_dir(spark, "stream")
    out = run_stream_sessions(spark, sf_dir, events.schema, f"{base}/sink", f"{base}/ckpt", file_glob="events.parquet",
                              key="user_id", ts="ts", value="value", gap=f"{STREAM_GAP_S} seconds",
                              watermark=f"{STREAM_WATERMARK_S} seconds", mode="append", ride="event_type", row_id="event_id",
                              limits=limits)
    return out.select("user_id", "session_start", "session_end", "n_events", F.round("avg_value", 6).alias("avg_value"),
                      "first_ts", "last_ts", "rides", F.round("express_share", 6).alias("express_share"))
