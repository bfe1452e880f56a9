"""Visitor-journey operators: day types, express flags, ride co-movement,
transition matrix and steady state (F29-F32, G9, G13, G22, M16-M21, W3, W4).

Rides and day types are dimensions (a park has tens of rides), so tables
keyed by them (thresholds, ride pairs, transition matrix) are small; each is
still broadcast only behind a size check.  Nothing here emits all pairs of
rows: co-movement is a matrix product computed as one join of a per-slot
"rising rides" vector, and the steady state is repeated squaring of the
ride x ride matrix with reliable checkpoints between steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions.scalars import safe_corr
from turnstile.operators.aggregates import group_quantiles, scalar_row
from turnstile.operators.joins import maybe_broadcast


# ------------------------------------------------------------------ day types

def day_types(calendar: DataFrame, attendance: DataFrame, covid_days: DataFrame | None,
              facility: str, busy_q: float = 0.75, quiet_q: float = 0.25) -> DataFrame:
    """F30 + F29: daily attendance of ``facility``; busy = total > p75, quiet
    = total < p25 (strict, exact linear quantiles); precedence quiet > busy >
    covid > normal.  ``calendar`` lists the days to tag (column ``day``)."""
    daily = (attendance.where(F.col("facility") == facility).groupBy("day")
             .agg(F.sum("attendance").alias("total")))
    q = scalar_row(daily, F.percentile("total", busy_q).alias("busy"),
                   F.percentile("total", quiet_q).alias("quiet"))
    tagged = calendar.join(daily, "day", "left")
    if covid_days is not None:
        tagged = tagged.join(covid_days.select("day").distinct()
                             .withColumn("_covid", F.lit(True)), "day", "left")
    else:
        tagged = tagged.withColumn("_covid", F.lit(None).cast("boolean"))
    busy = F.col("total") > F.lit(q["busy"]) if q["busy"] is not None else F.lit(False)
    quiet = F.col("total") < F.lit(q["quiet"]) if q["quiet"] is not None else F.lit(False)
    dt = (F.when(quiet, "quiet").when(busy, "busy")
          .when(F.coalesce(F.col("_covid"), F.lit(False)), "covid").otherwise("normal"))
    return tagged.select("day", "total", dt.alias("day_type"))


def with_day_type(df: DataFrame, ts: str, days: DataFrame) -> DataFrame:
    """Attach ``day_type`` by the calendar day of ``ts`` (days table is one row
    per calendar day)."""
    # one row per calendar day: bounded by the time span, not by the data
    d = maybe_broadcast(days.select("day", "day_type"), known_small=True)
    return df.withColumn("day", F.to_date(ts)).join(d, "day", "left") \
        .withColumn("day_type", F.coalesce("day_type", F.lit("normal")))


def below_group_quantile(df: DataFrame, group: Sequence[str], value: str, q: float,
                         out: str, of: DataFrame | None = None) -> DataFrame:
    """G7 + J10 (F31): ``value < quantile_q(value) of its group``; a group
    without a threshold means +inf (always True for a non-null value).  ``of``: a
    cheaper table with the same rows to take the quantiles from."""
    thr = group_quantiles(df if of is None else of, list(group), value, [q], ["_thr"])
    thr = thr.select(F.struct(*group).alias("_g"), "_thr")
    j = df.withColumn("_g", F.struct(*group)).join(thr, "_g", "left").drop("_g")
    flag = F.col(value) < F.coalesce(F.col("_thr"), F.lit(float("inf")))
    return j.withColumn(out, F.coalesce(flag, F.lit(False))).drop("_thr")


def visit_express(rows: DataFrame, visit_keys: Sequence[str], flag: str,
                  share: float = 0.6) -> DataFrame:
    """F32: a visit is express when more than ``share`` of its rides were
    below the threshold."""
    return rows.groupBy(*visit_keys).agg(
        F.count(F.lit(1)).alias("n_rides"),
        F.avg(F.col(flag).cast("int")).alias("low_wait_share"),
    ).withColumn("express", F.col("low_wait_share") > share)


def first_by_order(value: str, *order: str):
    """Value of the first row in ``order`` (min_by over a struct)."""
    return F.min_by(F.col(value), F.struct(*[F.col(o) for o in order]))


def ordered_collect(value: str, *order: str, keep_nulls: bool = True):
    """Values of a group as an array sorted by ``order``."""
    s = F.array_sort(F.collect_list(F.struct(*[F.col(o) for o in order], F.col(value).alias("_v"))))
    out = F.transform(s, lambda x: x["_v"])
    return out if keep_nulls else F.filter(out, lambda x: x.isNotNull())


def array_entropy(seq: str):
    """G22 of a sequence held in a row: natural-log entropy of its (non-null) items."""
    items = F.filter(F.col(seq), lambda x: x.isNotNull())
    n = F.size(items).cast("double")

    def part(x):
        p = F.size(F.filter(items, lambda y: y == x)) / n
        return -p * F.ln(p)
    return F.aggregate(F.transform(F.array_distinct(items), part), F.lit(0.0), lambda a, x: a + x)


def sequence_entropy(rows: DataFrame, visit_keys: Sequence[str], item: str) -> DataFrame:
    """Shannon entropy (natural log) of the item distribution of each
    visit, from long-form counts (no arrays)."""
    c = rows.groupBy(*visit_keys, item).agg(F.count(F.lit(1)).alias("_c"))
    tot = c.groupBy(*visit_keys).agg(F.sum("_c").alias("_n"))
    j = c.join(tot, list(visit_keys))
    p = F.col("_c") / F.col("_n")
    return j.groupBy(*visit_keys).agg(F.max("_n").alias("n_rides"),
                                      (-F.sum(p * F.log(p))).alias("entropy"))


# ----------------------------------------------------------------- ride moves

def ride_correlation(waits: DataFrame, reference: str, slot: str = "slot",
                     ride: str = "ride", value: str = "wait", by: Sequence[str] = ()) -> DataFrame:
    """Correlation of every ride's wait series with the reference ride
    on common slots (pairwise complete), optionally per ``by`` group.  The
    reference series has one row per slot, so the join is many-to-one and
    never multiplies rows."""
    by = list(by)
    ref = waits.where(F.col(ride) == reference).select(*by, F.col(slot), F.col(value).alias("_ref"))
    j = waits.join(ref, by + [slot])
    c = j.groupBy(*by, ride).agg(safe_corr(value, "_ref").alias("corr"))
    return c.withColumn("ride_group", F.when(F.col("corr") >= 0.5, "youth")
                        .when(F.col("corr") < 0.5, "family"))


def aligned_changes(waits: DataFrame, slot: str = "slot", ride: str = "ride",
                    value: str = "wait", by: Sequence[str] = ()) -> DataFrame:
    """Change of each ride against the previous slot *of the whole
    table* (not the ride's own previous row); NULL when the ride has no value
    in the previous slot.  Slots are numbered over the distinct slots (an
    aggregated, time-bounded table)."""
    by = list(by)
    slots = waits.select(*by, slot).distinct()
    idx = slots.withColumn("_idx", F.dense_rank().over(Window.partitionBy(*by).orderBy(slot)))
    w = waits.join(idx, by + [slot])
    prev = w.select(*[F.col(b).alias(f"_p_{b}") for b in by], F.col(ride).alias("_pr"),
                    (F.col("_idx") + 1).alias("_pidx"), F.col(value).alias("_pv"))
    cond = (w[ride] == prev["_pr"]) & (w["_idx"] == prev["_pidx"])
    for b in by:
        cond = cond & (w[b] == prev[f"_p_{b}"])
    j = w.join(prev, cond, "left")
    return j.select(*by, slot, ride, value, "_idx", (F.col(value) - F.col("_pv")).alias("change"))


def co_movement(changes: DataFrame, rides: Sequence[str], slot: str = "slot",
                ride: str = "ride") -> DataFrame:
    """For every ordered pair of distinct rides, the number of slots in
    which ``from`` fell and ``to`` rose.  Computed as F^T R without pairs of
    rows: each slot's rising rides become one row of 0/1 columns (pivot with
    the explicit ride list), the falling rows join it one-to-one by slot, and
    a sum by ``from`` yields the whole row of the count matrix."""
    rise = (changes.where(F.col("change") > 0).groupBy(slot)
            .pivot(ride, list(rides)).agg(F.max(F.lit(1))))
    rise = rise.na.fill(0, subset=list(rides))
    fall = changes.where(F.col("change") < 0).select(slot, F.col(ride).alias("from_ride"))
    j = fall.join(rise, slot)
    sums = j.groupBy("from_ride").agg(*[F.sum(F.col(f"`{r}`")).alias(f"n_{i}")
                                        for i, r in enumerate(rides)])
    stack = ", ".join(f"'{r}', n_{i}" for i, r in enumerate(rides))
    long = sums.selectExpr("from_ride", f"stack({len(rides)}, {stack}) as (to_ride, moves)")
    grid = (changes.sparkSession.createDataFrame([(a, b) for a in rides for b in rides if a != b],
                                                 "from_ride string, to_ride string"))
    return (grid.join(long, ["from_ride", "to_ride"], "left")
            .select("from_ride", "to_ride", F.coalesce(F.col("moves"), F.lit(0)).cast("long").alias("moves")))


def outflow_by_group(waits: DataFrame, reference: str, group: str = "day_type",
                     all_rides_group: str = "covid") -> DataFrame:
    """M17 + M18 per group (day type): each group has its own timeline of
    slots; moves are counted among the family rides (correlation with the
    reference ride < .5 within the group), among all rides in
    ``all_rides_group``.  A ride's outflow is the number of (slot, to) pairs
    where it fell and ``to`` rose, i.e. the sum over the slots where it fell
    of the number of kept rides that rose - no pairs are formed.  Kept rides
    without moves have outflow 0."""
    ch = aligned_changes(waits, by=[group])
    rc = ride_correlation(waits, reference, by=[group])
    rides = waits.select(group, "ride").distinct().join(rc, [group, "ride"], "left")
    kept = rides.where((F.col(group) == all_rides_group) | (F.col("corr") < 0.5)).select(group, "ride")
    kc = ch.join(kept, [group, "ride"], "left_semi")
    # a slot holds one row per ride
    risen = F.count(F.when(F.col("change") > 0, 1)).over(Window.partitionBy(group, "slot"))
    fo = (kc.withColumn("n_rise", risen).where(F.col("change") < 0)
          .groupBy(group, "ride").agg(F.sum("n_rise").alias("_o")))
    return kept.join(fo, [group, "ride"], "left").select(
        group, "ride", F.coalesce(F.col("_o"), F.lit(0)).cast("long").alias("outflow"))


def transition_probs(moves: DataFrame) -> DataFrame:
    """Row-normalised move counts; a ride without outflow keeps a zero
    row."""
    tot = F.sum("moves").over(Window.partitionBy("from_ride"))
    return moves.withColumn("p", F.coalesce(F.try_divide(F.col("moves").cast("double"), tot), F.lit(0.0)))


def steady_state(probs: DataFrame, rides: Sequence[str], tol: float = 1e-13,
                 max_doublings: int = 256) -> DataFrame:
    """Stationary distribution of the lazy chain L = (P + I) / 2 from a
    uniform start (same leading vector as P, no periodic cycling).  The
    matrix is squared until the normalised column sums stop moving; it is
    checkpointed (reliable) after every few squarings so the lineage stays
    short.  Squaring doubles the number of steps, so a chain that has not settled after
    ``max_doublings`` never will: that raises instead of returning the last vector."""
    spark = probs.sparkSession
    eye = spark.createDataFrame([(r, r, 0.5) for r in rides], "i string, j string, v double")
    half = probs.select(F.col("from_ride").alias("i"), F.col("to_ride").alias("j"),
                        (F.col("p") * 0.5).alias("v"))
    m = half.unionByName(eye).groupBy("i", "j").agg(F.sum("v").alias("v")).where("v <> 0").checkpoint()

    def pi_of(mat):
        col_sums = mat.groupBy("j").agg(F.sum("v").alias("s"))
        return col_sums.select(F.col("j").alias("ride"),
                               (F.col("s") / F.sum("s").over(Window.partitionBy())).alias("pi"))

    def square(mat):
        a, b = mat.alias("a"), mat.alias("b")
        sq = (a.join(b, F.col("a.j") == F.col("b.i"))
              .groupBy(F.col("a.i").alias("i"), F.col("b.j").alias("j"))
              .agg(F.sum(F.col("a.v") * F.col("b.v")).alias("v")))
        # rescale (direction is what matters) so a leaky chain never underflows
        return sq.withColumn("v", F.col("v") / F.sum("v").over(Window.partitionBy()))

    prev = pi_of(m)
    for _ in range(0, max_doublings, 4):
        for _ in range(4):
            m = square(m)
        m = m.checkpoint()
        cur = pi_of(m)
        delta = scalar_row(cur.join(prev, "ride", "full_outer"),
                           F.max(F.abs(F.coalesce(cur["pi"], F.lit(0.0))
                                       - F.coalesce(prev["pi"], F.lit(0.0)))).alias("d"))["d"]
        prev = cur
        if delta is None or delta < tol:
            return prev
    raise RuntimeError(f"the chain has not settled: last change {delta}")
