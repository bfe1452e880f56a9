"""Staffing, IoT, calendar and queue-log queries (S3, J1-J3, G23, G29-G30,
G35, G38, G39, F12-F17, F22, F23, F26-F28, F36-F38).

Staffing role = ``lineitem`` (carried = quantity, park = line status, ride =
return flag, day = ship date) against ``orders`` (daily / monthly attendance
and sales).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnstile.functions import scalars as S
from turnstile.operators import aggregates as A
from turnstile.operators import sets as U
from turnstile.operators.joins import equi_join
from turnstile.plans.registry import register
from turnstile.plans.sqlbind import REVIEWS, SURVEY, VISITS, with_ctes
from turnstile.sources.tables import reviews, survey, table, visits

LINK_PARK = "Brand#1"
POPULAR_RIDES = ["view", "purchase"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

# The seasonal weather table (season, rainfall, air temperature,
# relative humidity, wind speed).
SEASONAL_WEATHER = [
    ("April - June", 0.0, 27.910353535353536, 86.72777777777777, 2.330833333333333),
    ("January - March", 0.001092896174863388, 27.13409090909091, 81.43444444444445, 4.568888888888889),
    ("July - September", 0.0, 27.970970695970692, 78.28211233211233, 2.646851851851852),
    ("October - December", 0.0, 27.033809523809524, 83.87087301587302, 2.2307359307359307),
]


def _t(spark, sf_dir, name):
    return table(spark, sf_dir, name)


# ------------------------------------------------------------------ link table / joins

@register("link_split_join", f"""WITH link AS (SELECT CAST(p_partkey AS VARCHAR) || ';' || p_brand AS raw FROM part),
s AS (SELECT CAST(split_part(raw, ';', 1) AS BIGINT) AS attraction, split_part(raw, ';', 2) AS park FROM link)
SELECT l.l_orderkey, l.l_linenumber, s.attraction, s.park
FROM lineitem l JOIN s ON l.l_partkey = s.attraction WHERE s.park = '{LINK_PARK}'""")
def link_split_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + J1: a one-column ``A;B`` link table split in two, inner-joined on
    differently named keys; the park filter written after the join is pushed
    below it by Catalyst."""
    p = _t(spark, sf_dir, "part")
    link = p.select(F.concat(F.col("p_partkey").cast("string"), F.lit(";"), "p_brand").alias("raw"))
    parts = F.split("raw", ";")
    link = link.select(parts.getItem(0).cast("long").alias("attraction"), parts.getItem(1).alias("park"))
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    j = equi_join(li, link, ["l_partkey"], ["attraction"], "inner")
    return j.where(F.col("park") == LINK_PARK).select("l_orderkey", "l_linenumber", "attraction", "park")


_DAILY_SQL = """carried AS (SELECT CAST(l_shipdate AS DATE) AS day, l_linestatus AS park, l_returnflag AS ride,
  sum(l_quantity) AS carried FROM lineitem GROUP BY 1, 2, 3),
att AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS facility, sum(o_totalprice) AS attendance
  FROM orders GROUP BY 1, 2)"""


def _carried(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.groupBy(F.to_date("l_shipdate").alias("day"), F.col("l_linestatus").alias("park"),
                      F.col("l_returnflag").alias("ride")).agg(F.sum("l_quantity").alias("carried"))


def _att(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("facility")) \
        .agg(F.sum("o_totalprice").alias("attendance"))


@register("attendance_right_join", with_ctes("""pc AS (SELECT day, park, sum(carried) AS carried FROM carried GROUP BY 1, 2)
SELECT a.day, a.facility, round(pc.carried, 6) AS carried, round(a.attendance, 4) AS attendance
FROM pc RIGHT JOIN att a ON pc.day = a.day AND pc.park = a.facility WHERE pc.carried > 0""", _DAILY_SQL))
def attendance_right_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right outer join on a composite key followed by a null-rejecting
    filter (Catalyst turns it into an inner join)."""
    pc = _carried(spark, sf_dir).groupBy("day", "park").agg(F.sum("carried").alias("carried"))
    a = _att(spark, sf_dir)
    j = pc.join(a, (pc.day == a.day) & (pc.park == a.facility), "right")
    return j.where(F.col("carried") > 0).select(a.day, "facility", F.round("carried", 6).alias("carried"),
                                                F.round("attendance", 4).alias("attendance"))


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("mean_floor", "SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag, l_linestatus, " + ", ".join(
    f"CAST(floor(avg({c})) AS BIGINT) AS {c}" for c in _NUM) + " FROM lineitem GROUP BY 1, 2, 3")
def mean_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of every numeric column per key, floored (generated agg)."""
    li = _t(spark, sf_dir, "lineitem")
    num = [f.name for f in li.schema.fields if f.name in _NUM]
    return li.groupBy(F.to_date("l_shipdate").alias("day"), "l_returnflag", "l_linestatus") \
        .agg(*[F.floor(F.avg(c)).cast("long").alias(c) for c in num])


@register("share_of_total", with_ctes("""t AS (SELECT day, park, sum(carried) AS park_total FROM carried GROUP BY 1, 2)
SELECT c.day, c.park, c.ride, round(c.carried / t.park_total, 6) AS share,
  round_even(c.carried / t.park_total * a.attendance, 0) AS est_attendance
FROM carried c JOIN t USING (day, park) LEFT JOIN att a ON c.day = a.day AND c.park = a.facility""", _DAILY_SQL))
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G30 + F37: share of the (day, park) total, scaled to the park's
    attendance and rounded half-even."""
    c = U.group_total(_carried(spark, sf_dir), ["day", "park"], "carried", "park_total")
    a = _att(spark, sf_dir).withColumnRenamed("facility", "park")
    j = c.join(a, ["day", "park"], "left")
    share = F.try_divide(F.col("carried"), F.col("park_total"))
    return j.select("day", "park", "ride", F.round(share, 6).alias("share"),
                    F.bround(share * F.col("attendance"), 0).alias("est_attendance"))


@register("staff_features", """WITH m AS (SELECT date_trunc('month', CAST(l_shipdate AS DATE)) AS month,
  sum(l_quantity) AS est FROM lineitem GROUP BY 1),
d AS (SELECT date_trunc('month', CAST(o_orderdate AS DATE)) AS month, count(*) AS visitors,
  round(sum(o_totalprice), 2) AS sales, count(DISTINCT o_custkey) AS workers,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS regular, count(*) FILTER (WHERE o_orderstatus = 'O') AS part_time
  FROM orders GROUP BY 1)
SELECT CAST(m.month AS DATE) AS month, m.est, d.visitors, d.sales, d.workers,
  round(m.est / nullif(d.visitors / d.sales, 0), 4) AS est_per_visit_ratio,
  CAST(ceil(m.est / nullif(d.visitors / d.workers, 0)) AS BIGINT) AS staff_needed,
  d.regular + d.part_time AS total_staff
FROM m LEFT JOIN d USING (month)""")
def staff_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F36 + J2: monthly features joined to the monthly dimension (month
    period = ``trunc(d, 'MM')``), ratios by ``try_divide``."""
    li = _t(spark, sf_dir, "lineitem")
    o = _t(spark, sf_dir, "orders")
    m = li.groupBy(F.trunc(F.to_date("l_shipdate"), "MM").alias("month")).agg(F.sum("l_quantity").alias("est"))
    d = o.groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("visitors"), F.round(F.sum("o_totalprice"), 2).alias("sales"),
        F.count_distinct("o_custkey").alias("workers"),
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("regular"),
        F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("part_time"))
    j = m.join(d, "month", "left")
    return j.select("month", "est", "visitors", "sales", "workers",
                    F.round(F.try_divide(F.col("est"), F.try_divide(F.col("visitors"), F.col("sales"))), 4)
                    .alias("est_per_visit_ratio"),
                    F.ceil(F.try_divide(F.col("est"), F.try_divide(F.col("visitors"), F.col("workers"))))
                    .cast("long").alias("staff_needed"),
                    (F.col("regular") + F.col("part_time")).alias("total_staff"))


@register("staff_per_ride", with_ctes("""t AS (SELECT day, park, sum(carried) AS park_total FROM carried GROUP BY 1, 2),
e AS (SELECT c.day, c.park, c.ride, round_even(c.carried / t.park_total * a.attendance, 0) AS est
  FROM carried c JOIN t USING (day, park) LEFT JOIN att a ON c.day = a.day AND c.park = a.facility),
m AS (SELECT date_trunc('month', CAST(o_orderdate AS DATE)) AS month, count(*) AS visitors, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) AS DOUBLE) AS admission,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (o_orderpriority = '3-MEDIUM') AS DOUBLE) AS restaurant,
  count(DISTINCT o_custkey) FILTER (o_orderstatus = 'F') AS regular, count(DISTINCT o_custkey) FILTER (o_orderstatus = 'O') AS part_time
  FROM orders GROUP BY 1)
SELECT day, park, ride, est AS est_attendance, est * total / visitors AS sale, est * admission / visitors AS adm_sale,
  est * restaurant / visitors AS rest_sale, CAST(ceil(round(est * regular / visitors, 6)) AS BIGINT) AS reg_worker,
  CAST(ceil(round(est * part_time / visitors, 6)) AS BIGINT) AS part_worker,
  CAST(ceil(round(est * regular / visitors, 6)) + ceil(round(est * part_time / visitors, 6)) AS BIGINT) AS staff_count
FROM e LEFT JOIN m ON date_trunc('month', e.day) = m.month""", _DAILY_SQL))
def staff_per_ride(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F36 per ride: estimated attendance turned into sales and workers by the month's ratios to its visitors;
    sales are amounts, workers are rounded up, staff is their sum.  Month roles on orders: admission = urgent and high
    priority, restaurant = medium, regular / part-time = customers of closed / open orders."""
    c = U.group_total(_carried(spark, sf_dir), ["day", "park"], "carried", "park_total")
    a = _att(spark, sf_dir).withColumnRenamed("facility", "park")
    est = F.bround(F.try_divide(F.col("carried"), F.col("park_total")) * F.col("attendance"), 0)
    rides = c.join(a, ["day", "park"], "left").select("day", "park", "ride", est.alias("est_attendance"), F.trunc("day", "MM").alias("month"))
    price, status, prio = F.col("o_totalprice"), F.col("o_orderstatus"), F.col("o_orderpriority")
    money = lambda c: F.sum(c.cast("decimal(18,2)")).cast("double")  # noqa: E731  exact in any order
    month = _t(spark, sf_dir, "orders").groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("visitors"), money(price).alias("total"),
        money(F.when(prio.isin("1-URGENT", "2-HIGH"), price)).alias("admission"),
        money(F.when(prio == "3-MEDIUM", price)).alias("restaurant"),
        F.count_distinct(F.when(status == "F", F.col("o_custkey"))).alias("regular"),
        F.count_distinct(F.when(status == "O", F.col("o_custkey"))).alias("part_time"))
    j = rides.join(month, "month", "left")
    of = lambda total: F.try_divide(F.col("est_attendance") * F.col(total), F.col("visitors"))
    workers = lambda total: F.ceil(F.round(of(total), 6)).cast("long")
    return j.select("day", "park", "ride", "est_attendance", of("total").alias("sale"), of("admission").alias("adm_sale"),
                    of("restaurant").alias("rest_sale"), workers("regular").alias("reg_worker"), workers("part_time").alias("part_worker"),
                    (workers("regular") + workers("part_time")).alias("staff_count"))


# ------------------------------------------------------------------ nested records (IoT)

_RECORDS_SCHEMA = "array<struct<Attraction:string,Queue_Time:double,k:int>>"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event, a Python-literal list of two visit records as text (single
    quotes, ``np.float64(..)`` wrappers), the form the IoT logs were stored in."""
    e = _t(spark, sf_dir, "events")
    k = F.from_json("props", "struct<k:int>")["k"]
    rec = F.format_string(
        "[{'Attraction': '%s', 'Queue_Time': np.float64(%s), 'k': %s}, "
        "{'Attraction': '%s-exit', 'Queue_Time': np.float64(0.0), 'k': %s}]",
        F.col("event_type"), F.col("value").cast("string"), k.cast("string"), F.col("event_type"),
        k.cast("string"))
    return e.select("event_id", rec.alias("attraction_times"))


def parse_records(col: str) -> F.Column:
    """strip the NumPy wrappers and parse the single-quoted literal."""
    clean = F.regexp_replace(F.col(col), r"np\.float64\(([^)]*)\)", "$1")
    return F.from_json(clean, _RECORDS_SCHEMA, {"allowSingleQuotes": "true"})


_RECORDS_SQL = """rec AS (
  SELECT event_id, event_type AS attraction, value AS queue_time, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
    0 AS pos FROM events
  UNION ALL
  SELECT event_id, event_type || '-exit', 0.0, CAST(json_extract(props, '$.k') AS INTEGER), 1 FROM events)"""


@register("nested_parse_explode", with_ctes("SELECT event_id, pos, attraction, queue_time, k FROM rec", _RECORDS_SQL))
def nested_parse_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F26 + F27: parse nested record text and explode the records (an
    empty list keeps its row through ``posexplode_outer``)."""
    r = _records(spark, sf_dir).select("event_id", parse_records("attraction_times").alias("recs"))
    x = r.select("event_id", F.posexplode_outer("recs").alias("pos", "r"))
    return x.select("event_id", F.col("pos").cast("int").alias("pos"), F.col("r.Attraction").alias("attraction"),
                    F.col("r.Queue_Time").alias("queue_time"), F.col("r.k").alias("k"))


@register("popular_flag", with_ctes("SELECT event_id, bool_or(attraction IN (" + ", ".join(
    f"'{r}'" for r in POPULAR_RIDES) + ")) AS popular FROM rec GROUP BY event_id", _RECORDS_SQL))
def popular_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """any record of the list names a popular attraction."""
    r = _records(spark, sf_dir).select("event_id", parse_records("attraction_times").alias("recs"))
    pop = F.array(*[F.lit(x) for x in POPULAR_RIDES])
    return r.select("event_id", F.exists("recs", lambda x: F.array_contains(pop, x["Attraction"])).alias("popular"))


# ------------------------------------------------------------------ encodings

@register("label_encode", """SELECT p_partkey,
  CAST(dense_rank() OVER (ORDER BY coalesce(p_type, 'nan')) - 1 AS BIGINT) AS type_idx,
  CAST(dense_rank() OVER (ORDER BY coalesce(p_brand, 'nan')) - 1 AS BIGINT) AS brand_idx FROM part""")
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sorted distinct labels -> 0..n-1 (NULL is the class 'nan'), numbered over the distinct
    labels only and joined back."""
    p = _t(spark, sf_dir, "part").na.fill("nan", subset=["p_type", "p_brand"]).select("p_partkey", "p_type", "p_brand")
    for label, idx in (("p_type", "type_idx"), ("p_brand", "brand_idx")):
        codes = p.select(label).distinct().withColumn(idx, (F.row_number().over(Window.orderBy(label)) - 1).cast("long"))
        p = p.join(codes, label)
    return p.select("p_partkey", "type_idx", "brand_idx")


def _onehot_name(r: str) -> str:
    return "region_" + r.replace(" ", "_")


@register("one_hot", with_ctes("SELECT respondent, " + ", ".join(
    f"CASE WHEN region = '{r}' THEN 1 ELSE 0 END AS {_onehot_name(r)}" for r in REGIONS[1:]) + " FROM survey",
    SURVEY))
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one-hot with the first category dropped, over the explicit
    category list (stable columns, no data-dependent schema)."""
    s = survey(spark, sf_dir)
    return s.select("respondent", *[F.when(F.col("region") == r, 1).otherwise(0).alias(_onehot_name(r))
                                    for r in REGIONS[1:]])


# Seasons and events of the synthetic visits with their shares.
SEASON_SHARES = {"January - March": 0.1, "April - June": 0.1, "July - September": 0.4, "October - December": 0.4}
EVENT_SHARES = {"None": 0.8, "Special Event": 0.2}


@register("weighted_category", """WITH u AS (SELECT c_custkey AS respondent,
  ('0x' || substr(md5(c_custkey || ':42'), 1, 8))::BIGINT / 4294967296.0 AS s,
  ('0x' || substr(md5(c_custkey || ':43'), 1, 8))::BIGINT / 4294967296.0 AS e FROM customer),
q AS (SELECT *, CASE WHEN s < 0.1 THEN 'January - March' WHEN s < 0.2 THEN 'April - June' WHEN s < 0.6 THEN 'July - September'
  ELSE 'October - December' END AS visit_quarter FROM u)
SELECT respondent, visit_quarter, CASE WHEN visit_quarter = 'October - December' THEN 'Special Event'
  WHEN e < 0.8 THEN 'None' ELSE 'Special Event' END AS event FROM q""")
def weighted_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seeded weighted season and event per respondent (hash draws, stable under
    repartitioning); the last quarter always has a special event."""
    s = survey(spark, sf_dir)
    q = S.weighted_choice("respondent", list(SEASON_SHARES), list(SEASON_SHARES.values()), 42)
    e = S.weighted_choice("respondent", list(EVENT_SHARES), list(EVENT_SHARES.values()), 43)
    return s.select("respondent", q.alias("visit_quarter"), e.alias("event")).withColumn(
        "event", F.when(F.col("visit_quarter") == "October - December", "Special Event").otherwise(F.col("event")))


# ------------------------------------------------------------------ calendar / weather

def _quarter_sql(month: str) -> str:
    parts = " ".join(f"WHEN {month} IN ({', '.join(map(str, ms))}) THEN '{lab}'" for lab, ms in S.QUARTER_SEASONS)
    return f"CASE {parts} END"


@register("calendar_features", f"""SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(isodow(ts) - 1 AS INTEGER) AS weekday, strftime(ts, '%B') AS month_name, strftime(ts, '%A') AS day_name,
  CAST(ts AS DATE) AS day, CAST(date_trunc('month', ts) AS DATE) AS month_start, strftime(ts, '%H:%M') AS hhmm,
  isodow(ts) >= 6 AS weekend, {_quarter_sql('month(ts)')} AS quarter,
  CASE WHEN contains(lower({_quarter_sql('month(ts)')}), 'jul') THEN 'Jul-Sep' ELSE 'Oct-Dec' END AS quarter_clean
FROM events""")
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar parts, weekday with Monday = 0, names, truncations,
    HH:MM text, weekend flag, quarter label and its clean-up rule."""
    e = _t(spark, sf_dir, "events")
    q = S.season_of_month(F.month("ts"), S.QUARTER_SEASONS)
    return e.select("event_id", F.year("ts").alias("year"), F.month("ts").alias("month"),
                    S.weekday_mon0("ts").alias("weekday"), F.date_format("ts", "MMMM").alias("month_name"),
                    F.date_format("ts", "EEEE").alias("day_name"), F.to_date("ts").alias("day"),
                    F.trunc(F.to_date("ts"), "MM").alias("month_start"), F.date_format("ts", "HH:mm").alias("hhmm"),
                    S.is_weekend("ts").alias("weekend"), q.alias("quarter"),
                    F.when(F.lower(q).contains("jul"), "Jul-Sep").otherwise("Oct-Dec").alias("quarter_clean"))


_WEATHER_SQL = "weather(season, rainfall, air_temperature, relative_humidity, wind_speed) AS (SELECT * FROM (VALUES " \
    + ", ".join(f"('{s}', {a!r}::DOUBLE, {b!r}::DOUBLE, {c!r}::DOUBLE, {d!r}::DOUBLE)"
                for s, a, b, c, d in SEASONAL_WEATHER) + ") t(season, rainfall, air_temperature, relative_humidity, wind_speed))"


@register("seasonal_weather_join", with_ctes(f"""r AS (SELECT {_quarter_sql('month(written_date)')} AS season,
  rating, polarity FROM reviews WHERE written_date IS NOT NULL)
SELECT r.season, count(*) AS n, round(avg(rating), 6) AS avg_rating, round(avg(polarity), 6) AS avg_polarity,
  round(avg(w.rainfall), 6) AS rainfall, round(avg(w.air_temperature), 6) AS air_temperature,
  round(avg(w.relative_humidity), 6) AS relative_humidity, round(avg(w.wind_speed), 6) AS wind_speed
FROM r LEFT JOIN weather w ON r.season = w.season GROUP BY r.season""", REVIEWS, _WEATHER_SQL))
def seasonal_weather_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + G35: reviews left-joined to the seasonal weather table (4 fixed
    rows, broadcast) and seasonal means of several measures."""
    w = spark.createDataFrame(SEASONAL_WEATHER, "season string, rainfall double, air_temperature double, "
                                                "relative_humidity double, wind_speed double")
    r = reviews(spark, sf_dir).where(F.col("written_date").isNotNull()) \
        .withColumn("season", S.season_of_month(F.month("written_date"), S.QUARTER_SEASONS))
    j = r.join(F.broadcast(w), "season", "left")  # fixed 4-row table
    return j.groupBy("season").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("rating"), 6).alias("avg_rating"),
                                   F.round(F.avg("polarity"), 6).alias("avg_polarity"),
                                   *[F.round(F.avg(c), 6).alias(c) for c in
                                     ["rainfall", "air_temperature", "relative_humidity", "wind_speed"]])


# ------------------------------------------------------------------ queue log

@register("queue_log_summary", with_ctes("""SELECT ride, count(*) AS n_visits, round(avg(wait), 6) AS avg_wait
FROM visits WHERE ride IS NOT NULL GROUP BY ride
UNION ALL SELECT 'ALL', count(*), round(sum(wait) / count(*), 6) FROM visits""", VISITS))
def queue_log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit-weighted mean wait per ride and overall (total wait over
    visits) from a visit log."""
    v = visits(spark, sf_dir)
    per = A.drop_null_keys(v, ["ride"]).groupBy("ride").agg(
        F.count(F.lit(1)).alias("n_visits"), F.round(F.avg("wait"), 6).alias("avg_wait"))
    tot = v.agg(F.lit("ALL").alias("ride"), F.count(F.lit(1)).alias("n_visits"),
                F.round(F.sum("wait") / F.count(F.lit(1)), 6).alias("avg_wait"))
    return per.unionByName(tot)


@register("scenario_compare", with_ctes("""v AS (SELECT *, CASE WHEN day(ts) <= 15 THEN 'A' ELSE 'B' END AS variant
  FROM visits WHERE ride IS NOT NULL)
SELECT ride, count(*) FILTER (WHERE variant = 'A') AS visits_a, count(*) FILTER (WHERE variant = 'B') AS visits_b,
  round(avg(wait) FILTER (WHERE variant = 'A'), 6) AS avg_wait_a, round(avg(wait) FILTER (WHERE variant = 'B'), 6)
  AS avg_wait_b, round(avg(wait) FILTER (WHERE variant = 'B') - avg(wait) FILTER (WHERE variant = 'A'), 6) AS diff
FROM v GROUP BY ride""", VISITS))
def scenario_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layouts (first / second half of the month) side by side in
    one conditional aggregate, with the difference."""
    v = A.drop_null_keys(visits(spark, sf_dir), ["ride"]).withColumn(
        "variant", F.when(F.dayofmonth("ts") <= 15, "A").otherwise("B"))
    a, b = F.col("variant") == "A", F.col("variant") == "B"
    wa, wb = F.avg(F.when(a, F.col("wait"))), F.avg(F.when(b, F.col("wait")))
    return v.groupBy("ride").agg(F.count(F.when(a, 1)).alias("visits_a"), F.count(F.when(b, 1)).alias("visits_b"),
                                 F.round(wa, 6).alias("avg_wait_a"), F.round(wb, 6).alias("avg_wait_b"),
                                 F.round(wb - wa, 6).alias("diff"))
