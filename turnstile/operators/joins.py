"""Join operators (J*).

Tables whose size is fixed by construction (literal dimension maps, calendars)
are broadcast.  Everything else is an equi-join left to AQE, which broadcasts
a side whose measured bytes are under the session's threshold and splits
skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def maybe_broadcast(df: DataFrame, known_small: bool = False) -> DataFrame:
    """Broadcast hint for a side whose size is bounded by construction
    (literal tables, calendars, dimension lists); any other side is left to
    AQE and its byte threshold."""
    return F.broadcast(df) if known_small else df


def equi_join(left: DataFrame, right: DataFrame, left_on: Sequence[str],
              right_on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join with different key names on each side."""
    cond = [left[a] == right[b] for a, b in zip(left_on, right_on, strict=True)]
    return left.join(right, cond, how)


def lookup(df: DataFrame, key: str | Column, mapping: Mapping, out: str,
           default=None) -> DataFrame:
    """Dictionary look-up of a literal map, ``default`` when missing."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    m = F.create_map(*pairs)
    k = F.col(key) if isinstance(key, str) else key
    val = m[k]
    if default is not None:
        val = F.coalesce(val, F.lit(default))
    return df.withColumn(out, val)


def interval_join(points: DataFrame, intervals: DataFrame, point_col: str,
                  start_col: str, end_col: str, how: str = "inner",
                  shuffle: bool = False) -> DataFrame:
    """Rows of ``points`` whose date lies in the closed interval
    ``[start, end]`` of a row of ``intervals``.

    Each interval is exploded to the months it covers, the points are keyed
    by their month and the join is an equi-join on the month plus the
    residual ``between``.  The plan is left to Catalyst and AQE; ``shuffle``
    asks for the sort-merge form (both sides shuffled on the month, AQE splits
    a hot month).  Intervals with a NULL bound match nothing.
    """
    bucketed = intervals.withColumn(
        "_bucket",
        F.explode(F.sequence(F.trunc(F.col(start_col), "MM"),
                             F.trunc(F.col(end_col), "MM"),
                             F.expr("INTERVAL 1 MONTH"))),
    ).where(F.col(start_col) <= F.col(end_col))
    side = bucketed.hint("merge") if shuffle else bucketed
    p = points.withColumn("_pbucket", F.trunc(F.col(point_col), "MM"))
    cond = ((p["_pbucket"] == side["_bucket"])
            & p[point_col].between(side[start_col], side[end_col]))
    return p.join(side, cond, how).drop("_pbucket", "_bucket")


def semi_join(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in a computed key set."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def threshold_lookup(df: DataFrame, thresholds: DataFrame, on: Sequence[str],
                     value: str, threshold: str, out: str) -> DataFrame:
    """``value < threshold`` with a missing threshold meaning +inf."""
    j = df.join(thresholds, list(on), "left")
    cond = F.col(value) < F.coalesce(F.col(threshold), F.lit(float("inf")))
    return j.withColumn(out, F.coalesce(cond, F.lit(False))).drop(threshold)
