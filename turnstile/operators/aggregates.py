"""Aggregate operators (G*) as single ``groupBy().agg`` passes.

Every group aggregate here is partial-aggregated map-side by Spark (hash
aggregate with partial/final stages), so a hot group costs one partial row
per task, not one task for the whole group.  Scalars (global quantiles,
min/max) come back as a one-row finaliser and enter later plans as literals.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions.scalars import safe_corr
from turnstile.session import snapshot


def scalar_row(df: DataFrame, *aggs: Column):
    """One-row global aggregate returned to the driver (size 1 by construction)."""
    return df.agg(*aggs).first()


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """pandas ``groupby`` drops NULL keys; Spark keeps a NULL group."""
    return df.na.drop(subset=list(keys))


def relative_frequency(df: DataFrame, key: str, count_col: str = "count",
                       share_col: str = "share") -> DataFrame:
    """Value counts normalised over non-null values.  The window runs over
    the aggregated frame (one row per distinct value)."""
    counts = drop_null_keys(df, [key]).groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
    return counts.withColumn(share_col, F.col(count_col) / F.sum(count_col).over(Window.partitionBy()))


def mode_of(c: str) -> Column:
    """Most frequent value, ties to the lowest value."""
    return F.mode(F.col(c), True)


def corr_matrix_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All pairwise-complete correlations in one aggregate, long form.
    Only the upper triangle is aggregated (corr is symmetric); the diagonal
    is 1 where the column varies."""
    aggs = []
    for i, a in enumerate(cols):
        aggs.append(F.when(F.stddev_pop(a) > 0, F.lit(1.0)).alias(f"{a}__{a}"))
        for b in cols[i + 1:]:
            aggs.append(F.round(safe_corr(a, b), 6).alias(f"{a}__{b}"))
    wide = df.agg(*aggs)
    pairs = [(a, b) for a in cols for b in cols]

    def src(a, b):
        return f"{a}__{b}" if cols.index(a) <= cols.index(b) else f"{b}__{a}"
    stack = ", ".join(f"'{a}', '{b}', `{src(a, b)}`" for a, b in pairs)
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) as (col_a, col_b, corr)")


def box_summary(df: DataFrame, key: str, value: str) -> DataFrame:
    """Quartiles, 1.5 IQR fences, whiskers (extreme values inside the
    fences) and outlier count per group.  Quartiles are exact and linear
    (pandas / ``quantile_cont``); the per-group stats are joined back on the
    group key (one row per group)."""
    counts = value_counts_by(drop_null_keys(df, [key]), [key], value)  # the rows are read once, all else comes from here
    q = quantiles_of_counts(counts, [0.25, 0.5, 0.75], ["q1", "median", "q3"]) \
        .withColumn("iqr", F.col("q3") - F.col("q1")) \
     .withColumn("lo_fence", F.col("q1") - 1.5 * F.col("iqr")) \
     .withColumn("hi_fence", F.col("q3") + 1.5 * F.col("iqr"))
    inside = F.col("_v").between(F.col("lo_fence"), F.col("hi_fence"))
    return counts.join(q, "_g").groupBy(F.col(f"_g.{key}").alias(key), "q1", "median", "q3", "iqr", "lo_fence", "hi_fence").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_hi"),
        F.coalesce(F.sum(F.when(~inside, F.col("_c"))), F.lit(0)).alias("n_outliers"),
        F.sum("_c").alias("n"),
    )


def histogram(df: DataFrame, value: str, lo: float, hi: float, width: float) -> DataFrame:
    """Fixed-width bins ``[lo + i*w, lo + (i+1)*w)``, last bin closed."""
    nbins = int(round((hi - lo) / width))
    b = F.floor((F.col(value) - F.lit(lo)) / F.lit(width)).cast("long")
    b = F.when(F.col(value) == F.lit(hi), F.lit(nbins - 1)).otherwise(b)
    inside = F.col(value).between(lo, hi)
    return (df.where(inside).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("bin_lo", F.round(F.lit(lo) + F.col("bin") * F.lit(width), 6)))


def nps(answer: str, yes: str = "Yes", no: str = "No") -> Column:
    """(yes - no) / answered * 100."""
    a = F.col(answer)
    return F.try_divide((F.count(F.when(a == yes, 1)) - F.count(F.when(a == no, 1))) * 100.0,
                        F.count(a).cast("double"))


def with_ordered_image(df: DataFrame, value: str, out: str) -> DataFrame:
    """``df`` with a bigint ``out`` that orders like the double ``value`` and differs wherever it does: the IEEE bits,
    negated for negative values.  The exponent comes from a logarithm and is set right by comparing with its power, so
    the result is exact for every double; -0.0 is 0.0, NaN is above infinity, NULL stays NULL."""
    v = F.col(value)
    df = df.withColumn("_a", F.abs(v))
    normal = (F.col("_a") >= 2.0 ** -1022) & (F.col("_a") <= sys.float_info.max)
    df = df.withColumn("_n", F.when(normal, F.col("_a")).otherwise(1.0))
    df = df.withColumn("_x", F.greatest(F.lit(-1022), F.least(F.lit(1023), F.floor(F.log2("_n")))).cast("bigint"))
    power = F.pow(F.lit(2.0), F.col("_x").cast("double"))
    df = df.withColumn("_x", F.col("_x") - (F.col("_n") < power).cast("bigint") + (F.col("_n") / power >= 2.0).cast("bigint"))
    bits = (F.col("_x") + 1023) * (1 << 52) + ((F.col("_n") / F.pow(F.lit(2.0), F.col("_x").cast("double")) - 1.0) * float(1 << 52)).cast("bigint")
    top = F.lit(2047 << 52)
    whole = (F.when(normal, bits).when(F.isnan("_a"), top + (1 << 51)).when(F.col("_a") == float("inf"), top)
             .when(F.col("_a").isNotNull(), (F.when(normal, 0.0).otherwise(F.when(F.col("_a") < 1.0, F.col("_a")).otherwise(0.0))
                                             * 2.0 ** 537 * 2.0 ** 537).cast("bigint")))
    return df.withColumn(out, F.when(v < 0, -whole).otherwise(whole)).drop("_a", "_n", "_x")


def value_counts_by(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """``_g, _v, _c, _k``: rows per (group, value), written once: struct of the group's columns, the value as a double, its
    number and its ordered image.  NULL values are left out, a NULL group is a group.  A hot group moves one row
    per task and distinct value."""
    keys = F.struct(*[F.col(c) for c in group]).alias("_g")  # NULL fields are equal to each other
    counts = (df.where(F.col(value).isNotNull()).groupBy(keys, F.col(value).cast("double").alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c")))
    return snapshot(with_ordered_image(counts, "_v", "_k"), "value-counts")


def quantiles_of_counts(counts: DataFrame, qs: Sequence[float], names: Sequence[str], buckets: int = 1 << 16) -> DataFrame:
    """``_g`` and the exact, linearly interpolated quantiles ``names`` of a ``value_counts_by`` table.

    The 64 bits of the ordered image are read digit by digit from the top: counts per digit find the digit that holds
    each target rank, and only values that share all digits so far are looked at for the next.  After the last digit
    one value is left.  However the values spread, no task orders more than one digit's values; ``buckets`` (rounded to a
    power of two from 2^13 to 2^16) sets how many those are, never the result."""
    bits = min(16, max(13, int(buckets).bit_length() - 1))
    shifts = list(range(64 - bits, -bits, -bits))
    shifts[-1] = 0
    digits = counts
    targets = None
    taken = 64
    for step, shift in enumerate(shifts):
        # the sign bit stays with the top digit: an arithmetic shift keeps the order
        here = digits.withColumn("_p", F.shiftright("_k", taken)) if targets is not None else digits.withColumn("_p", F.lit(0).cast("bigint"))
        here = here.withColumn("_d", F.shiftright("_k", shift))
        if targets is not None:
            here = here.join(targets.select("_g", "_p").distinct(), ["_g", "_p"])
        sums = here.groupBy("_g", "_p", "_d").agg(F.sum("_c").alias("_n"), F.max("_v").alias("_v"))
        upto = Window.partitionBy("_g", "_p").orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("_end", F.sum("_n").over(upto))
        if targets is None:
            total = F.sum("_n").over(Window.partitionBy("_g", "_p"))
            ranks = F.array(*[F.struct(F.lit(i).alias("q"), h.alias("h"), end(h).cast("long").alias("rank")) for i, q in enumerate(qs)
                              for h in [(F.col("_total") - 1) * F.lit(float(q))] for end in (F.floor, F.ceil)])
            found = sums.withColumn("_total", total).withColumn("_t", F.explode(F.array_distinct(ranks))).select(
                "_g", "_d", "_n", "_end", "_v", F.col("_t.q").alias("_q"), F.col("_t.h").alias("_h"), F.col("_t.rank").alias("_rank"))
        else:  # ranks count from the first value of their prefix
            found = sums.join(targets, ["_g", "_p"])
        found = found.where((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_n")))
        targets = found.select("_g", F.col("_d").alias("_p"), "_q", "_h", (F.col("_rank") - F.col("_end") + F.col("_n")).alias("_rank"), "_v")
        if step < len(shifts) - 1:
            targets = targets.drop("_v")
        taken = shift
    # the two neighbours of the target position, weighted by nearness
    both = targets.groupBy("_g", "_q", "_h").agg(F.min("_v").alias("_v0"), F.max("_v").alias("_v1"))
    k0, k1, h = F.floor("_h"), F.ceil("_h"), F.col("_h")
    value_at = F.when(k0 == k1, F.col("_v0")).otherwise((k1 - h) * F.col("_v0") + (h - k0) * F.col("_v1"))
    return both.groupBy("_g").agg(*[F.max(F.when(F.col("_q") == i, value_at)).alias(n) for i, n in enumerate(names)])


def group_quantiles(df: DataFrame, group: Sequence[str], value: str, qs: Sequence[float],
                    names: Sequence[str], buckets: int = 1 << 16) -> DataFrame:
    """Exact, linearly interpolated quantiles per group (the
    pandas / ``quantile_cont`` definition) from one stored table of (group, value) counts; NULL values are left out, a
    NULL group is a group.  One path for every size and spread of the values."""
    found = quantiles_of_counts(value_counts_by(df, group, value), qs, names, buckets)
    return found.select(*[F.col(f"_g.{c}").alias(c) for c in group], *names)
