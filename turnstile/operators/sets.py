"""Set, rank and group-window operators.

Per-group windows are avoided where one group may hold a third of the
rows: group totals come from a partial aggregate joined back, and top-k per
group is computed in two levels over salted sub-groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.operators.ordered import global_row_number


def union_all(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Union by column name; missing columns become NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=allow_missing)
    return out


def surrogate_ids(df: DataFrame, order: list, offset: int, out: str = "sid") -> DataFrame:
    """Consecutive ids ``offset + 1 ..`` in a stable order (no gaps,
    unlike ``monotonically_increasing_id``)."""
    r = global_row_number(df, order, out="_rn")
    return r.withColumn(out, F.col("_rn") + F.lit(offset)).drop("_rn")


def group_total(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """The group's total attached to every row, as a partial aggregate
    joined back (a hot group is one partial row per task, and AQE splits a
    skewed join partition) instead of a window that holds the group in one
    task."""
    tot = df.groupBy(*keys).agg(F.sum(value).alias(out))
    return df.join(tot, list(keys), "left")


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: list[Column], k: int,
                    salt_col: str, salts: int = 32, out: str = "rnk") -> DataFrame:
    """Exact top-k rows per group.  Level 1 ranks inside (group, salt)
    sub-groups, where salt = hash(salt_col) mod ``salts``, so a hot group is
    split across ``salts`` tasks; level 2 ranks the <= salts * k survivors of
    each group.  ``order`` must be a total order."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_col)), F.lit(salts)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    lvl1 = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return (lvl1.withColumn(out, F.row_number().over(w2).cast("long")).where(F.col(out) <= k)
            .drop("_salt", "_r1"))


def pair_product_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """J12 without forming pairs: per group, the number of unordered pairs of
    rows and the mean product of their values over all pairs,
    sum_{i<j} x_i x_j = ((sum x)^2 - sum x^2) / 2."""
    g = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"),
        F.sum(F.col(value) * F.col(value)).alias("_s2"))
    pairs = F.col("_n") * (F.col("_n") - 1) / 2
    return g.select(*keys, pairs.cast("long").alias("n_pairs"),
                    F.try_divide((F.col("_s") * F.col("_s") - F.col("_s2")) / 2, pairs)
                    .alias("mean_pair_product"))
