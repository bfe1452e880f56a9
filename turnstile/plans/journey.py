"""Journey queries.

Visit log = ``events`` (visitor = user_id, ride = event_type, wait = value);
waits = max wait per (hour slot, ride).  The session gap of the queries is 6
hours: with 30 minutes nearly every event of the driver data is its own
session (the unit tests use 1800 s).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.operators import journey as J
from turnstile.operators import sequences as S
from turnstile.operators.joins import maybe_broadcast
from turnstile.operators.ordered import gap_sessions
from turnstile.plans.registry import register
from turnstile.plans.sqlbind import ATTENDANCE, VISITS, with_ctes
from turnstile.session import snapshot
from turnstile.sources.tables import attendance, visits, waits

# Fixed values of the bindings.
SESSION_GAP_S = 6 * 3600
GLOBAL_GAP_S = 1800
FACILITY = "view"
REFERENCE_RIDE = "view"
COVID_DAYS = ["2024-01-13", "2024-01-14", "2024-01-15"]
TOP_RIDES = 3


# ------------------------------------------------------------------ shared

def covid_days(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in COVID_DAYS], "day date")


def day_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = visits(spark, sf_dir)
    cal = v.select(F.to_date("ts").alias("day")).distinct()
    return J.day_types(cal, attendance(spark, sf_dir), covid_days(spark), FACILITY)


def sessionized(spark: SparkSession, sf_dir: str, gap: float = SESSION_GAP_S,
                src: DataFrame | None = None) -> DataFrame:
    v = src if src is not None else visits(spark, sf_dir)
    return gap_sessions(v, "ts", "event_id", gap, key="visitor")


# Rides of one park: the pair tables (moves, transition matrix) are its square.
MAX_RIDES = 1000


def ride_list(spark: SparkSession, sf_dir: str) -> list[str]:
    """Distinct rides: a dimension (bounded by the park, checked), used as pivot values."""
    rides = [r[0] for r in visits(spark, sf_dir).select("ride").distinct()
             .where(F.col("ride").isNotNull()).limit(MAX_RIDES + 1).collect()]
    if len(rides) > MAX_RIDES:
        raise ValueError(f"more than {MAX_RIDES} rides: ride pairs are for one park")
    return sorted(rides)


_COVID_SQL = "covid AS (SELECT * FROM (VALUES " + ", ".join(
    f"(DATE '{d}')" for d in COVID_DAYS) + ") t(day))"

DAYS_SQL = ", ".join([VISITS, ATTENDANCE, _COVID_SQL, f"""daily AS (
  SELECT day, CAST(sum(attendance) AS BIGINT) AS total FROM attendance
  WHERE facility = '{FACILITY}' GROUP BY day),
qthr AS (SELECT quantile_cont(total, 0.75) AS busy, quantile_cont(total, 0.25) AS quiet FROM daily),
calendar AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM visits),
day_types AS (
  SELECT c.day, d.total,
         CASE WHEN d.total < q.quiet THEN 'quiet' WHEN d.total > q.busy THEN 'busy'
              WHEN cv.day IS NOT NULL THEN 'covid' ELSE 'normal' END AS day_type
  FROM calendar c LEFT JOIN daily d ON c.day = d.day LEFT JOIN covid cv ON c.day = cv.day
  CROSS JOIN qthr q)"""])


def _sess_sql(gap: int, src: str = "visits", name: str = "sess") -> str:
    return f"""{name}_g AS (
  SELECT *, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w), 0) / 1000000 AS gap_seconds
  FROM {src} WINDOW w AS (PARTITION BY visitor ORDER BY ts, event_id)),
{name} AS (
  SELECT *, CAST(sum(CASE WHEN gap_seconds > {gap} THEN 1 ELSE 0 END) OVER (
    PARTITION BY visitor ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id
  FROM {name}_g)"""


SESS_SQL = _sess_sql(SESSION_GAP_S)

WAITS_SQL = """waits AS (
  SELECT date_trunc('hour', ts) AS slot, ride, max(wait) AS wait FROM visits GROUP BY 1, 2)"""


# ------------------------------------------------------------------ sessions

@register("sessions", with_ctes("""SELECT event_id, visitor, ts, ride, wait,
  round(gap_seconds, 6) AS gap_seconds, session_id FROM sess""", VISITS, SESS_SQL))
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + W2 keyed by visitor (two-pass ordered scan, skew-safe)."""
    s = sessionized(spark, sf_dir)
    return s.select("event_id", "visitor", "ts", "ride", "wait",
                    F.round("gap_seconds", 6).alias("gap_seconds"), "session_id")


@register("sessions_global_scan", with_ctes(f"""g AS (
  SELECT event_id, ts, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w), 0) / 1000000 AS gap_seconds
  FROM visits WINDOW w AS (ORDER BY ts, event_id))
SELECT event_id, ts, round(gap_seconds, 6) AS gap_seconds,
  CAST(sum(CASE WHEN gap_seconds > {GLOBAL_GAP_S} THEN 1 ELSE 0 END) OVER (
    ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id FROM g""", VISITS))
def sessions_global_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 as in the reference: one global timeline with no key, 1800 s gap,
    run as the range-partitioned two-pass scan (no single-partition window)."""
    s = gap_sessions(visits(spark, sf_dir), "ts", "event_id", GLOBAL_GAP_S, key=None)
    return s.select("event_id", "ts", F.round("gap_seconds", 6).alias("gap_seconds"), "session_id")


# ------------------------------------------------------------------ day types / express

@register("day_type", with_ctes("SELECT day, total, day_type FROM day_types", DAYS_SQL))
def day_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F29 + F30 + J9."""
    return day_table(spark, sf_dir)


@register("express_row", with_ctes("""wd AS (
  SELECT w.slot, w.ride, w.wait, coalesce(d.day_type, 'normal') AS day_type
  FROM waits w LEFT JOIN day_types d ON CAST(w.slot AS DATE) = d.day),
t AS (SELECT ride, day_type, quantile_cont(wait, 0.3) AS thr FROM wd GROUP BY ride, day_type)
SELECT slot, ride, wait, day_type,
       coalesce(wait < coalesce(thr, CAST('inf' AS DOUBLE)), false) AS express
FROM wd LEFT JOIN t USING (ride, day_type)""", DAYS_SQL, WAITS_SQL))
def express_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F31 + G7 + J10: wait below the p30 of its (ride, day type); a missing
    threshold is +inf."""
    w = J.with_day_type(waits(spark, sf_dir), "slot", day_table(spark, sf_dir))
    w = snapshot(w.select("slot", "ride", "wait", "day_type"), "typed-waits")  # read by the threshold and the flag
    e = J.below_group_quantile(w, ["ride", "day_type"], "wait", 0.3, "express")
    return e.select("slot", "ride", "wait", "day_type", "express")


_VISIT_FLAG_SQL = """vd AS (
  SELECT s.*, coalesce(d.day_type, 'normal') AS day_type
  FROM sess s LEFT JOIN day_types d ON CAST(s.ts AS DATE) = d.day),
t AS (SELECT ride, day_type, quantile_cont(wait, 0.25) AS thr FROM vd GROUP BY ride, day_type),
flagged AS (
  SELECT vd.*, coalesce(wait < coalesce(thr, CAST('inf' AS DOUBLE)), false) AS low_wait
  FROM vd LEFT JOIN t USING (ride, day_type))"""


def typed_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits with the type of their day, written once: sessions and thresholds both read them."""
    v = J.with_day_type(visits(spark, sf_dir), "ts", day_table(spark, sf_dir))
    return snapshot(v.select("event_id", "visitor", "ts", "ride", "wait", "day_type"), "typed-visits")


def _flagged_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = typed_visits(spark, sf_dir)
    s = sessionized(spark, sf_dir, src=typed)
    return J.below_group_quantile(s, ["ride", "day_type"], "wait", 0.25, "low_wait", of=typed)


@register("express_visit", with_ctes("""SELECT visitor, session_id, count(*) AS n_rides,
  round(avg(CAST(low_wait AS INTEGER)), 6) AS low_wait_share,
  avg(CAST(low_wait AS INTEGER)) > 0.6 AS express
FROM flagged GROUP BY visitor, session_id""", DAYS_SQL, SESS_SQL, _VISIT_FLAG_SQL))
def express_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F32: visit is express when > 60 % of its rides waited less than the
    p25 of their (ride, day type)."""
    e = J.visit_express(_flagged_visits(spark, sf_dir), ["visitor", "session_id"], "low_wait")
    return e.select("visitor", "session_id", "n_rides",
                    F.round("low_wait_share", 6).alias("low_wait_share"), "express")


_CORR_SQL = f"""ref AS (SELECT slot, wait AS ref_wait FROM waits WHERE ride = '{REFERENCE_RIDE}'),
rc AS (
  SELECT w.ride, covar_pop(w.wait, r.ref_wait) / nullif(
    stddev_pop(CASE WHEN r.ref_wait IS NOT NULL THEN w.wait END) *
    stddev_pop(CASE WHEN w.wait IS NOT NULL THEN r.ref_wait END), 0) AS corr
  FROM waits w JOIN ref r USING (slot) GROUP BY w.ride),
rgroups AS (SELECT ride, corr, CASE WHEN corr >= 0.5 THEN 'youth' WHEN corr < 0.5 THEN 'family' END
  AS ride_group FROM rc)"""


@register("visit_summary", with_ctes("""SELECT f.visitor, f.session_id, count(*) AS n_rides,
  arg_min(f.day_type, (f.ts, f.event_id)) AS day_type,
  avg(CAST(f.low_wait AS INTEGER)) > 0.6 AS express,
  CASE WHEN count(*) FILTER (WHERE g.ride_group = 'family') > count(*) FILTER (WHERE g.ride_group = 'youth')
       THEN 'Family'
       WHEN count(*) FILTER (WHERE g.ride_group = 'youth') > count(*) FILTER (WHERE g.ride_group = 'family')
       THEN 'Youth' ELSE 'Mixed' END AS ride_type,
  list(f.ride ORDER BY f.ts, f.event_id) AS ride_sequence,
  round(coalesce(entropy(f.ride) * ln(2), 0), 6) AS entropy, len(list(f.ride)) AS length
FROM flagged f LEFT JOIN rgroups g ON f.ride = g.ride
GROUP BY f.visitor, f.session_id""", DAYS_SQL, SESS_SQL, _VISIT_FLAG_SQL, WAITS_SQL, _CORR_SQL))
def visit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M20 (G13, G14, G22, F24, F25, F32): one row per visit with ride count, first day
    type, express flag, Family / Youth / Mixed ride type, and the rides in order with
    their entropy and number."""
    f = _flagged_visits(spark, sf_dir)
    groups = J.ride_correlation(waits(spark, sf_dir), REFERENCE_RIDE).select("ride", "ride_group")
    j = f.join(maybe_broadcast(groups), "ride", "left")  # one row per ride
    fam = F.count(F.when(F.col("ride_group") == "family", 1))
    yth = F.count(F.when(F.col("ride_group") == "youth", 1))
    return j.groupBy("visitor", "session_id").agg(
        F.count(F.lit(1)).alias("n_rides"),
        J.first_by_order("day_type", "ts", "event_id").alias("day_type"),
        (F.avg(F.col("low_wait").cast("int")) > 0.6).alias("express"),
        F.when(fam > yth, "Family").when(yth > fam, "Youth").otherwise("Mixed").alias("ride_type"),
        J.ordered_collect("ride", "ts", "event_id").alias("ride_sequence"),
    ).select("*", F.round(J.array_entropy("ride_sequence"), 6).alias("entropy"),
             F.size("ride_sequence").cast("long").alias("length"))


@register("visit_sequences", with_ctes("""SELECT visitor, session_id,
  list(ride ORDER BY ts, event_id) AS ride_sequence FROM sess GROUP BY visitor, session_id""",
                                       VISITS, SESS_SQL))
def visit_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered ride list of each visit."""
    s = sessionized(spark, sf_dir)
    return s.groupBy("visitor", "session_id").agg(
        J.ordered_collect("ride", "ts", "event_id").alias("ride_sequence"))


@register("sequence_entropy", with_ctes("""c AS (SELECT visitor, session_id, ride, count(*) AS c
  FROM sess GROUP BY ALL),
n AS (SELECT visitor, session_id, sum(c) AS n FROM c GROUP BY ALL)
SELECT visitor, session_id, CAST(max(n) AS BIGINT) AS n_rides, round(-sum(c / n * ln(c / n)), 6) AS entropy
FROM c JOIN n USING (visitor, session_id) GROUP BY visitor, session_id""", VISITS, SESS_SQL))
def sequence_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G22 + F25 (length)."""
    e = J.sequence_entropy(sessionized(spark, sf_dir), ["visitor", "session_id"], "ride")
    return e.select("visitor", "session_id", "n_rides", F.round("entropy", 6).alias("entropy"))


@register("wait_tolerance", with_ctes(f"""top AS (
  SELECT ride FROM (SELECT ride, count(*) AS n FROM visits WHERE ride IS NOT NULL GROUP BY ride)
  ORDER BY n DESC, ride LIMIT {TOP_RIDES}),
sub AS (SELECT * FROM visits WHERE ride IN (SELECT ride FROM top)),
{_sess_sql(SESSION_GAP_S, 'sub', 'ss')}
SELECT ss.visitor, ss.session_id, coalesce(d.day_type, 'normal') AS day_type, round(avg(wait), 6) AS avg_wait
FROM ss LEFT JOIN day_types d ON CAST(ss.ts AS DATE) = d.day
GROUP BY ss.visitor, ss.session_id, coalesce(d.day_type, 'normal')""", DAYS_SQL))
def wait_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits re-sessionised on the top-3 rides only, mean wait per
    (visit, day type)."""
    v = visits(spark, sf_dir)
    top = (v.where(F.col("ride").isNotNull()).groupBy("ride").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "ride").limit(TOP_RIDES))
    sub = v.join(F.broadcast(top.select("ride")), "ride", "left_semi")  # <= 3 rows
    s = J.with_day_type(sessionized(spark, sf_dir, src=sub), "ts", day_table(spark, sf_dir))
    return s.groupBy("visitor", "session_id", "day_type").agg(F.round(F.avg("wait"), 6).alias("avg_wait"))


# ------------------------------------------------------------------ ride series

@register("median_by_slot", with_ctes("""SELECT strftime(slot, '%H:%M') AS deb_time, ride,
  round(median(wait), 6) AS median_wait FROM waits GROUP BY 1, 2""", VISITS, WAITS_SQL))
def median_by_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median wait per time of day and ride (long form of the pivot)."""
    from turnstile.operators.aggregates import group_quantiles
    w = waits(spark, sf_dir).withColumn("deb_time", F.date_format("slot", "HH:mm"))
    m = group_quantiles(w, ["deb_time", "ride"], "wait", [0.5], ["median_wait"])
    return m.select("deb_time", "ride", F.round("median_wait", 6).alias("median_wait"))


@register("ride_corr_groups", with_ctes("SELECT ride, round(corr, 6) AS corr, ride_group FROM rgroups",
                                        VISITS, WAITS_SQL, _CORR_SQL))
def ride_corr_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16."""
    c = J.ride_correlation(waits(spark, sf_dir), REFERENCE_RIDE)
    return c.select("ride", F.round("corr", 6).alias("corr"), "ride_group")


_CHANGES_SQL = """sidx AS (SELECT slot, dense_rank() OVER (ORDER BY slot) AS idx FROM (SELECT DISTINCT slot FROM waits)),
wi AS (SELECT w.*, s.idx FROM waits w JOIN sidx s USING (slot)),
changes AS (SELECT a.slot, a.ride, a.wait, a.idx, a.wait - b.wait AS change
  FROM wi a LEFT JOIN wi b ON a.ride = b.ride AND a.idx = b.idx + 1)"""


@register("ride_changes", with_ctes("SELECT slot, ride, round(change, 6) AS change FROM changes",
                                    VISITS, WAITS_SQL, _CHANGES_SQL))
def ride_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change against the previous slot of the whole table."""
    c = J.aligned_changes(waits(spark, sf_dir))
    return c.select("slot", "ride", F.round("change", 6).alias("change"))


_MOVES_SQL = """rides AS (SELECT DISTINCT ride FROM waits WHERE ride IS NOT NULL),
grid AS (SELECT a.ride AS from_ride, b.ride AS to_ride FROM rides a, rides b WHERE a.ride <> b.ride),
mv AS (SELECT f.ride AS from_ride, t.ride AS to_ride, count(*) AS moves
  FROM changes f JOIN changes t ON f.slot = t.slot AND f.ride <> t.ride
  WHERE f.change < 0 AND t.change > 0 GROUP BY 1, 2),
moves AS (SELECT g.from_ride, g.to_ride, coalesce(m.moves, 0) AS moves
  FROM grid g LEFT JOIN mv m USING (from_ride, to_ride)),
probs AS (SELECT from_ride, to_ride, moves,
  coalesce(moves / nullif(sum(moves) OVER (PARTITION BY from_ride), 0), 0) AS p FROM moves)"""


def _moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.co_movement(J.aligned_changes(waits(spark, sf_dir)), ride_list(spark, sf_dir))


@register("ride_moves", with_ctes("SELECT from_ride, to_ride, moves FROM moves",
                                  VISITS, WAITS_SQL, _CHANGES_SQL, _MOVES_SQL))
def ride_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M17 + J11: ordered ride pairs, counts of slots where from fell and to rose."""
    return _moves(spark, sf_dir)


@register("ride_outflow", with_ctes("""SELECT from_ride AS ride, CAST(sum(moves) AS BIGINT) AS outflow
FROM moves GROUP BY from_ride""", VISITS, WAITS_SQL, _CHANGES_SQL, _MOVES_SQL))
def ride_outflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M18."""
    return _moves(spark, sf_dir).groupBy(F.col("from_ride").alias("ride")) \
        .agg(F.sum("moves").cast("long").alias("outflow"))


@register("transition_matrix", with_ctes("SELECT from_ride, to_ride, round(p, 6) AS p FROM probs",
                                         VISITS, WAITS_SQL, _CHANGES_SQL, _MOVES_SQL))
def transition_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4."""
    p = J.transition_probs(_moves(spark, sf_dir))
    return p.select("from_ride", "to_ride", F.round("p", 6).alias("p"))


_STEADY_SQL = """lazy AS (
  SELECT from_ride AS i, to_ride AS j, 0.5 * p AS v FROM probs
  UNION ALL SELECT ride, ride, 0.5 FROM rides),
n AS (SELECT count(*) AS n FROM rides),
it(step, ride, pi) AS (
  SELECT 0, ride, CAST(1.0 AS DOUBLE) / (SELECT n FROM n) FROM rides
  UNION ALL
  SELECT step + 1, j, sum(pi * v) / sum(sum(pi * v)) OVER ()
  FROM it JOIN lazy ON it.ride = lazy.i WHERE step < 2000 GROUP BY step, j)"""


@register("steady_state", "WITH RECURSIVE " + with_ctes(
    "SELECT ride, round(pi, 6) AS pi FROM it WHERE step = 2000",
    VISITS, WAITS_SQL, _CHANGES_SQL, _MOVES_SQL, _STEADY_SQL)[len("WITH "):])
def steady_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stationary distribution of the ride transition chain."""
    rides = ride_list(spark, sf_dir)
    pi = J.steady_state(J.transition_probs(_moves(spark, sf_dir)), rides)
    return pi.select("ride", F.round("pi", 6).alias("pi"))


@register("sequence_similarity", with_ctes("""o AS (SELECT *, lead(ride) OVER (PARTITION BY visitor, session_id
  ORDER BY ts, event_id) AS nxt FROM flagged),
c AS (SELECT visitor, session_id, step, count(*) AS c FROM (
  SELECT visitor, session_id, coalesce(ride, '') AS step FROM o
  UNION ALL SELECT visitor, session_id, coalesce(ride, '') || ' > ' || nxt FROM o WHERE nxt IS NOT NULL) GROUP BY ALL),
ex AS (SELECT visitor, session_id, avg(CAST(low_wait AS INTEGER)) > 0.6 AS express FROM flagged GROUP BY ALL),
nrm AS (SELECT visitor, session_id, sqrt(sum(c * c)) AS norm FROM c GROUP BY ALL),
u AS (SELECT ex.express, c.step, sum(c.c / nrm.norm) AS s
  FROM c JOIN nrm USING (visitor, session_id) JOIN ex USING (visitor, session_id) GROUP BY ALL),
g AS (SELECT express, count(*) AS n FROM ex GROUP BY express),
ss AS (SELECT express, sum(s * s) AS s2 FROM u GROUP BY express)
SELECT g.express, g.n AS n_visits,
  round(CASE WHEN g.n > 1 THEN (ss.s2 - g.n) / (g.n * (g.n - 1)) END, 6) AS mean_similarity
FROM g JOIN ss USING (express)""", DAYS_SQL, SESS_SQL, _VISIT_FLAG_SQL))
def sequence_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G21 re-aimed: mean similarity over *all* pairs of visits within the
    express / other groups, computed exactly without forming pairs.  Each
    visit is the unit vector u_i of its rides and of its moves from one ride to the next, so the
    order counts; the mean pairwise cosine is (|sum u_i|^2 - n) / (n (n - 1)), so one
    aggregate per (group, step) replaces the quadratic pair loop (Ratcliff-Obershelp
    is not decomposable and would need every pair)."""
    f = _flagged_visits(spark, sf_dir)
    visit = f.groupBy("visitor", "session_id").agg(
        (F.avg(F.col("low_wait").cast("int")) > 0.6).alias("express"),
        J.ordered_collect("ride", "ts", "event_id", keep_nulls=True).alias("seq"))
    seq = F.col("seq")
    moves = F.transform(F.sequence(F.lit(1), F.size(seq)), lambda i: F.when(
        F.get(seq, i).isNotNull(), F.concat(F.coalesce(F.get(seq, i - 1), F.lit("")), F.lit(" > "), F.get(seq, i))))
    steps = F.concat(F.transform(seq, lambda x: F.coalesce(x, F.lit(""))), F.filter(moves, lambda x: x.isNotNull()))
    # a visit's steps and its norm stay in its row; only (group, step) sums are shuffled
    counts = F.transform(F.array_distinct("steps"), lambda x: F.struct(
        x.alias("step"), F.size(F.filter("steps", lambda y: y == x)).alias("c")))
    visit = visit.select("express", steps.alias("steps")).withColumn("counts", counts)
    norm = F.sqrt(F.aggregate("counts", F.lit(0.0), lambda a, x: a + x["c"] * x["c"]))
    rows = visit.select("express", norm.alias("norm"), F.explode("counts").alias("k"))
    u = rows.groupBy("express", "k.step").agg(F.sum(F.col("k.c") / F.col("norm")).alias("s"))
    s2 = u.groupBy("express").agg(F.sum(F.col("s") * F.col("s")).alias("s2"))
    n = visit.groupBy("express").agg(F.count(F.lit(1)).alias("n_visits"))
    nv = F.col("n_visits")
    return n.join(s2, "express").select("express", "n_visits", F.round(F.when(
        nv > 1, (F.col("s2") - nv) / (nv * (nv - 1))), 6).alias("mean_similarity"))


def _visit_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    visit = _flagged_visits(spark, sf_dir).groupBy("visitor", "session_id").agg(
        (F.avg(F.col("low_wait").cast("int")) > 0.6).alias("express"),
        J.ordered_collect("ride", "ts", "event_id", keep_nulls=True).alias("seq"))
    return S.sequence_classes(visit, "express", "seq", ["visitor", "session_id"])


@register("sequence_similarity_lsh")
def sequence_similarity_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits of like ride sequences within the express / other groups: pairs of distinct sequences (each
    named by its smallest visit, with its visits) whose matching-block ratio is 0.8 or more."""
    pairs = S.similar_sequences(_visit_classes(spark, sf_dir))
    return pairs.select(F.col("group").alias("express"), *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "ab" for c in ("visitor", "session_id")],
                        "n_a", "n_b", F.round("ratio", 6).alias("ratio"))


@register("wait_outflow_by_day_type", with_ctes(f"""wd AS (
  SELECT w.slot, w.ride, w.wait, coalesce(d.day_type, 'normal') AS day_type
  FROM waits w LEFT JOIN day_types d ON CAST(w.slot AS DATE) = d.day),
sidx AS (SELECT day_type, slot, dense_rank() OVER (PARTITION BY day_type ORDER BY slot) AS idx
  FROM (SELECT DISTINCT day_type, slot FROM wd)),
wi AS (SELECT wd.*, s.idx FROM wd JOIN sidx s USING (day_type, slot)),
chg AS (SELECT a.day_type, a.slot, a.ride, a.wait - b.wait AS change
  FROM wi a LEFT JOIN wi b ON a.day_type = b.day_type AND a.ride = b.ride AND a.idx = b.idx + 1),
dref AS (SELECT day_type, slot, wait AS ref_wait FROM wd WHERE ride = '{REFERENCE_RIDE}'),
drc AS (SELECT w.day_type, w.ride, covar_pop(w.wait, r.ref_wait) / nullif(
    stddev_pop(CASE WHEN r.ref_wait IS NOT NULL THEN w.wait END) *
    stddev_pop(CASE WHEN w.wait IS NOT NULL THEN r.ref_wait END), 0) AS corr
  FROM wd w JOIN dref r USING (day_type, slot) GROUP BY 1, 2),
kept AS (SELECT r.day_type, r.ride FROM (SELECT DISTINCT day_type, ride FROM wd) r
  LEFT JOIN drc c USING (day_type, ride) WHERE r.day_type = 'covid' OR c.corr < 0.5),
kc AS (SELECT c.* FROM chg c JOIN kept USING (day_type, ride)),
nr AS (SELECT day_type, slot, count(*) FILTER (WHERE change > 0) AS n_rise FROM kc GROUP BY 1, 2),
fo AS (SELECT c.day_type, c.ride, sum(nr.n_rise) AS o FROM kc c JOIN nr USING (day_type, slot)
  WHERE c.change < 0 GROUP BY 1, 2),
outflow AS (SELECT k.day_type, k.ride, coalesce(fo.o, 0) AS outflow FROM kept k LEFT JOIN fo USING (day_type, ride)),
top AS (SELECT ride FROM (SELECT ride, count(*) AS n FROM visits WHERE ride IS NOT NULL GROUP BY ride)
  ORDER BY n DESC, ride LIMIT {TOP_RIDES}),
ao AS (SELECT d.day_type, a.avg_outflow_top3 FROM (SELECT DISTINCT day_type FROM wd) d LEFT JOIN (
  SELECT day_type, avg(outflow) AS avg_outflow_top3 FROM outflow WHERE ride IN (SELECT ride FROM top)
  GROUP BY day_type) a USING (day_type)),
sub AS (SELECT * FROM visits WHERE ride IN (SELECT ride FROM top)),
{_sess_sql(SESSION_GAP_S, 'sub', 'ss')},
vw AS (SELECT ss.visitor, ss.session_id, coalesce(d.day_type, 'normal') AS day_type, avg(wait) AS avg_wait
  FROM ss LEFT JOIN day_types d ON CAST(ss.ts AS DATE) = d.day GROUP BY 1, 2, 3),
aw AS (SELECT day_type, avg(avg_wait) AS avg_wait_top3 FROM vw GROUP BY day_type)
SELECT aw.day_type, round(aw.avg_wait_top3, 6) AS avg_wait_top3, round(ao.avg_outflow_top3, 6) AS avg_outflow_top3
FROM aw JOIN ao USING (day_type)""", DAYS_SQL, WAITS_SQL))
def wait_outflow_by_day_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M18 + J5: per day type, the mean outflow of the top-3 rides (moves on
    that day type's own timeline, family rides only except on covid days)
    joined to the mean wait on the top-3 rides (M21)."""
    v = typed_visits(spark, sf_dir)
    # hourly waits: the hour of a visit lies in its day, so the day type is that of the visits
    w = v.groupBy("day_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slot"), "ride").agg(F.max("wait").alias("wait"))
    w = snapshot(w, "typed-waits")
    out = J.outflow_by_group(w, REFERENCE_RIDE)
    top = (v.where(F.col("ride").isNotNull()).groupBy("ride").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "ride").limit(TOP_RIDES).select("ride"))
    ao = (w.select("day_type").distinct()
          .join(out.join(F.broadcast(top), "ride", "left_semi").groupBy("day_type")  # <= 3 rides
                .agg(F.avg("outflow").alias("avg_outflow_top3")), "day_type", "left"))
    sub = v.join(F.broadcast(top), "ride", "left_semi")
    s = sessionized(spark, sf_dir, src=sub)
    vw = s.groupBy("visitor", "session_id", "day_type").agg(F.avg("wait").alias("avg_wait"))
    aw = vw.groupBy("day_type").agg(F.avg("avg_wait").alias("avg_wait_top3"))
    return aw.join(ao, "day_type").select("day_type", F.round("avg_wait_top3", 6).alias("avg_wait_top3"),
                                          F.round("avg_outflow_top3", 6).alias("avg_outflow_top3"))
