"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of ``block_rows`` rows.  With weight w (its share of the slots),
block k of a source is released at floor(k / w) and due at ceil((k + 1) / w).  Earliest deadline
first over the released blocks gives every slot to one block, meets all deadlines (the weights
sum to one), and so keeps each source less than one block away from w times the slots so far.
Weights are whole shares q of a period of Q slots, so the schedule repeats: one period is
scheduled by a fold over its slots, and block k runs in slot (k div q) * Q + pattern[k mod q].
With ``carried`` the shares are taken anew for each period instead: at its end every source has
its given weight times the slots so far, rounded up or down, so what one period rounds is carried
into the next.  Periods are then scheduled apart, and no source is ever two blocks away from its
given weight (less than one by the rounding at the ends of the period, less than one inside).
Rows are numbered inside a source by hash buckets with prefix sums, so a hot source never meets
in one task.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.common import stored


def whole_shares(weights: DataFrame, period: int) -> DataFrame:
    """``source, weight`` (positive; a null, zero or negative weight counts as the smallest share)
    -> ``source, share, period``: whole slots by largest remainder, at least one each.

    The period is raised to the number of sources if it is smaller."""
    w = weights.groupBy("source").agg(F.greatest(F.coalesce(F.sum("weight"), F.lit(0.0)), F.lit(0.0)).alias("weight"))
    every = Window.partitionBy(F.lit(0))
    w = (w.withColumn("total", F.sum("weight").over(every)).withColumn("n", F.count("*").over(every))
         .withColumn("period", F.greatest(F.lit(period).cast("long"), F.col("n"))))
    # one slot each, the rest in proportion
    exact = F.when(F.col("total") > 0, F.col("weight") / F.col("total")).otherwise(1 / F.col("n")) * (F.col("period") - F.col("n"))
    w = w.withColumn("exact", exact).withColumn("low", F.floor("exact"))
    rank = F.row_number().over(every.orderBy(F.desc(F.col("exact") - F.col("low")), F.asc_nulls_first("source")))
    left = F.col("period") - F.col("n") - F.sum("low").over(every)
    return w.withColumn("rank", rank).withColumn("left", left).select(
        "source", (1 + F.col("low") + F.when(F.col("rank") <= F.col("left"), 1).otherwise(0)).cast("long").alias("share"), "period")


def _earliest_first(s: Column, q: Column) -> Column:
    """Array of structs with ``share`` (positive, summing to ``q``) -> array of ``i, k, t``: block k of struct i in slot t."""
    zero = F.struct(F.transform(s, lambda x: F.lit(0).cast("long")).alias("next"),
                    F.array().cast("array<struct<i:int,k:bigint,t:bigint>>").alias("out"))

    def slot(a: Column, t: Column) -> Column:
        ready = F.filter(F.transform(s, lambda x, i: F.struct(
            F.floor(((F.get(a["next"], i) + 1) * q + x["share"] - 1) / x["share"]).alias("due"), i.alias("i"),
            F.floor(F.get(a["next"], i) * q / x["share"]).alias("from"), F.get(a["next"], i).alias("k"))),
            lambda j: (j["from"] <= t) & (j["k"] < F.get(s, j["i"])["share"]))
        # bound once by a transform: the state names it for every source
        return F.get(F.transform(F.array(F.array_min(ready)), lambda first: F.struct(
            F.transform(a["next"], lambda k, i: F.when(i == first["i"], k + 1).otherwise(k)).alias("next"),
            F.concat(a["out"], F.array(F.struct(first["i"].alias("i"), first["k"].alias("k"), t.alias("t")))).alias("out"))), F.lit(0))

    def part(a: Column, start: Column) -> Column:  # slots are gathered in parts: long periods are not copied slot by slot
        one = F.aggregate(F.sequence(start, F.least(start + 511, q - 1)), F.struct(a["next"].alias("next"), zero["out"].alias("out")), slot)
        return F.get(F.transform(F.array(one), lambda x: F.struct(
            x["next"].alias("next"), F.concat(a["out"], F.array(x["out"])).alias("out"))), F.lit(0))

    none = F.struct(zero["next"].alias("next"), F.array().cast("array<array<struct<i:int,k:bigint,t:bigint>>>").alias("out"))
    return F.flatten(F.aggregate(F.sequence(F.lit(0).cast("long"), q - 1, F.lit(512).cast("long")), none, part, lambda a: a["out"]))


def pfair_pattern(shares: DataFrame) -> DataFrame:
    """``source, share, period`` -> ``source, share, period, offset, slot``: the slot of each block of
    one period, earliest deadline first among the released (ties: the source's rank by name)."""
    row = shares.agg(F.sort_array(F.collect_list(F.struct("source", "share"))).alias("s"), F.max("period").alias("period"))
    # collect_list skips nothing here: the struct is never null, a null source sorts first
    done = row.select("s", "period", F.explode(_earliest_first(F.col("s"), F.col("period"))).alias("o"))
    return done.select(
        F.get(F.col("s"), F.col("o")["i"])["source"].alias("source"), F.get(F.col("s"), F.col("o")["i"])["share"].alias("share"),
        "period", F.col("o")["k"].alias("offset"), F.col("o")["t"].alias("slot"))


def exact_targets(weights: DataFrame, period: int) -> DataFrame:
    """``source, weight`` -> ``source, part, whole, period``: the target is part / whole, in whole numbers.

    Sources without a positive weight get one slot of ``period`` each.  The period is raised to the number
    of sources and to one slot for the smallest target."""
    w = weights.groupBy("source").agg(F.greatest(F.coalesce(F.sum("weight"), F.lit(0.0)), F.lit(0.0)).alias("weight"))
    every = Window.partitionBy(F.lit(0))
    scaled = F.greatest(F.round(F.col("weight") / F.col("most") * 1e15), F.lit(1.0)).cast("decimal(20,0)")
    w = (w.withColumn("most", F.max("weight").over(every)).withColumn("n", F.count("*").over(every))
         .withColumn("free", F.sum(F.when(F.col("weight") > 0, 0).otherwise(1)).over(every))
         .withColumn("period", F.greatest(F.lit(period).cast("long"), F.col("n")))
         .withColumn("part", F.when(F.col("weight") > 0, scaled)))
    total = F.sum("part").over(every).cast("decimal(30,0)")
    part = (F.when(F.col("most") == 0, F.lit(1)).when(F.col("free") == 0, F.col("part"))
            .when(F.col("weight") > 0, F.col("part") * (F.col("period") - F.col("free"))).otherwise(total))
    w = w.withColumn("part", part.cast("decimal(24,0)"))
    w = w.withColumn("whole", F.sum("part").over(every).cast("decimal(26,0)"))
    longest = F.max(F.ceil(F.col("whole").cast("double") / F.col("part").cast("double"))).over(every)
    return w.select("source", "part", "whole", F.greatest("period", longest.cast("long") + 1).alias("period"))


def carried_schedule(targets: DataFrame) -> DataFrame:
    """``source, part, whole, period, periods`` -> ``source, turn, block, slot, release, deadline``: every block of the
    first ``periods`` periods (turns), each with the shares that lead from the rounded targets at its start to those at
    its end.  A period holds at least one slot of each target, so the rounded targets never fall."""
    step = 256
    turns = (targets.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("periods") - 1, F.lit(step).cast("long"))))
             .repartition("from")
             .withColumn("turn", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + step - 1, F.col("periods") - 1)))))
    together = Window.partitionBy("turn")
    for side, t in (("a", F.col("turn") * F.col("period")), ("b", (F.col("turn") + 1) * F.col("period"))):
        turns = (turns.withColumn("t", t.cast("decimal(13,0)"))
                 .withColumn("low", F.expr("part * t div whole")).withColumn("rest", F.expr("part * t % whole"))
                 .withColumn("left", t - F.sum("low").over(together))
                 .withColumn("rank", F.row_number().over(together.orderBy(F.desc("rest"), F.asc_nulls_first("source"))))
                 .withColumn(side, F.col("low") + F.when(F.col("rank") <= F.col("left"), 1).otherwise(0)))
    turns = turns.withColumn("share", F.col("b") - F.col("a")).where(F.col("share") > 0)
    each = turns.groupBy("turn").agg(F.sort_array(F.collect_list(F.struct("source", "share", "a"))).alias("s"), F.max("period").alias("q"))
    each = each.select("turn", "s", "q", F.explode(_earliest_first(F.col("s"), F.col("q"))).alias("o"))
    each = each.select("turn", "q", F.get("s", F.col("o.i")).alias("x"), F.col("o.k").alias("k"), F.col("o.t").alias("t"))
    start, k, q, share = F.col("turn") * F.col("q"), F.col("k"), F.col("q"), F.col("x.share")
    return each.select(F.col("x.source").alias("source"), "turn", (F.col("x.a") + k).alias("block"), (start + F.col("t")).alias("slot"),
                       (start + F.floor(k * q / share)).alias("release"),
                       (start + F.floor(((k + 1) * q + share - 1) / share)).alias("deadline"))


def size_weights(docs: DataFrame, source_col: str = "source", text_col: str = "text", power: float = 0.5) -> DataFrame:
    """Target weights ``source, weight``: the source's characters to a power below one, so small
    sources are heard more than their size."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(
        F.pow(1.0 + F.sum(F.coalesce(F.length(text_col), F.lit(0))), F.lit(power)).alias("weight"))


def _carried_places(sizes: DataFrame, starts: DataFrame, present: DataFrame, targets: DataFrame, block_rows: int) -> DataFrame:
    """``__group, __start, __blocks, __plan``: per bucket of a source its blocks in the schedule (up to the period
    in which the first source runs out), and how the later ones go on: by the first period, over and over."""
    every = Window.partitionBy(F.lit(0))
    targets = targets.join(present, "source").withColumn("blocks", F.ceil(F.col("n") / block_rows))
    out_of = F.ceil((F.col("blocks") + 1) * F.col("whole").cast("double") / (F.col("part").cast("double") * F.col("period")))
    # one more than needed: the quotient is not exact
    targets = targets.withColumn("periods", (F.min(out_of).over(every) + 1).cast("long"))
    schedule = stored(carried_schedule(targets.select("source", "part", "whole", "period", "periods")), "mix-schedule")
    again = schedule.where(F.col("turn") == 0).groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("slot", "release", "deadline"))).alias("again"))
    reach = schedule.groupBy("source").agg((F.max("block") + 1).alias("scheduled"))
    end = targets.select("source", F.col("blocks").alias("block")).join(schedule, ["source", "block"]).agg(F.min("slot").alias("end"))
    plan = targets.select("source", "period", "periods").join(again, "source").join(reach, "source").crossJoin(end).select(
        "source", F.struct("period", "periods", "again", "scheduled", "end").alias("__plan"))
    group = starts.join(sizes, ["source", "bucket"])
    blocks = group.select("source", "bucket", F.explode(F.sequence(
        F.floor(F.col("__start") / block_rows), F.floor((F.col("__start") + F.col("n") - 1) / block_rows))).alias("block"))
    blocks = blocks.join(schedule, ["source", "block"]).groupBy("source", "bucket").agg(
        F.sort_array(F.collect_list(F.struct("slot", "release", "deadline"))).alias("__blocks"))
    return group.join(plan, "source").join(blocks, ["source", "bucket"], "left").select(
        F.concat("bucket", "source").alias("__group"), "__start", "__blocks", "__plan")


def mix_sources(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                block_rows: int = 8, period: int = 400, prefix: int = 3, carried: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` plus ``block`` (number inside the source), ``slot`` (place of the
    block in the mix), ``release``, ``deadline`` and ``in_mix``: before the first slot that a source
    with no blocks left would have had.  Up to there every source is less than one block from its
    target in whole shares of ``period`` (``carried``: less than two blocks from its given weight, for
    ever); later rows are kept in order behind it, none is dropped or repeated.

    Rows go by the MD5 of their id inside a source (ties by id, then by row hash); ``prefix`` hex digits
    of it split a source into buckets and never change the order.  A null source is a source; a
    source without a weight gets the smallest share; weights of sources without rows are ignored.
    Empty table: empty result.  Columns that clash with the added names are replaced."""
    docs = docs.drop(*[c for c in ("block", "slot", "release", "deadline", "in_mix") if c not in (id_col, source_col)])
    source = F.col(source_col).cast("string")
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    name = F.coalesce(F.concat(F.lit("="), source), F.lit(""))  # a null source has a name of its own
    rows = docs.withColumn("__md5", digest).withColumn("__group", F.concat(F.substring("__md5", 1, prefix), name))

    sizes = (docs.select(name.alias("source"), F.substring(digest, 1, prefix).alias("bucket"))
             .groupBy("source", "bucket").agg(F.count("*").alias("n")))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    present = sizes.groupBy("source").agg(F.sum("n").alias("n"))
    wanted = weights.select(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source"),
                            F.col("weight").cast("double").alias("weight"))
    order = [F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind])]
    local = Window.partitionBy("__group").orderBy("__md5", id_col, *order)
    numbered = rows.withColumn("__local", F.row_number().over(local))
    if carried:
        targets = exact_targets(present.select("source").join(wanted, "source", "left"), period)
        place = _carried_places(sizes, starts, present, targets, block_rows)
        out = numbered.join(place, "__group").withColumn("block", F.floor((F.col("__start") + F.col("__local") - 1) / block_rows))
        tail, block = F.col("block") - F.col("__plan.scheduled"), F.col("block")
        share, length, first = F.size("__plan.again").cast("long"), F.col("__plan.period"), F.floor(F.col("__start") / block_rows)
        inside, again = F.get("__blocks", (block - first).cast("int")), F.get("__plan.again", (tail % share).cast("int"))
        shift = (F.col("__plan.periods") + F.floor(tail / share)) * length
        for name in ("slot", "release", "deadline"):
            out = out.withColumn(name, F.when(tail < 0, inside[name]).otherwise(shift + again[name]))
        return out.withColumn("in_mix", F.col("slot") < F.col("__plan.end")).drop(
            "__md5", "__group", "__local", "__start", "__plan", "__blocks")

    shares = whole_shares(present.select("source").join(wanted, "source", "left"), period)
    plan = pfair_pattern(shares).groupBy("source", "share", "period").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("offset", "slot"))), lambda x: x["slot"]).alias("slots"))

    def slot_of(block: Column) -> Column:
        return F.floor(block / F.col("share")) * F.col("period") + F.get("slots", (block % F.col("share")).cast("int"))

    last = slot_of(F.floor((F.col("n") + block_rows - 1) / block_rows))
    plan = plan.join(present, "source").withColumn("end", F.min(last).over(Window.partitionBy(F.lit(0))))
    # the schedule meets the rows on the key of their numbering: one shuffle of the rows for both
    place = starts.join(plan, "source").select(
        F.concat("bucket", "source").alias("__group"), "__start",
        F.struct("share", "period", "slots", "end").alias("__plan"))
    out = numbered.join(place, "__group")
    out = out.withColumn("block", F.floor((F.col("__start") + F.col("__local") - 1) / block_rows))
    share, length, block = F.col("__plan.share"), F.col("__plan.period"), F.col("block")
    return (out.withColumn("slot", F.floor(block / share) * length + F.get(F.col("__plan.slots"), (block % share).cast("int")))
            .withColumn("release", F.floor(block * length / share))
            .withColumn("deadline", F.floor(((block + 1) * length + share - 1) / share))
            .withColumn("in_mix", F.col("slot") < F.col("__plan.end"))
            .drop("__md5", "__group", "__local", "__start", "__plan"))
