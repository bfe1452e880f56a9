"""Similar sequences by matching blocks (Ratcliff-Obershelp), without comparing all pairs.

Equal sequences are one class.  The ratio is 2 M / (|a| + |b|) with M matched elements, which are a common
subsequence.  Candidates come in three ways, by the lengths of a pair:

* Two sequences of up to ``SHORT`` elements meet on a common subsequence as long as the ratio asks for.  Every
  subsequence of that length is a key, so no pair is missed, and few meet that are not alike: on few distinct
  elements short multisets are nearly all alike, their order is not.
* If the standard matcher leaves out every element of the second sequence (``autojunk``: 200 or more elements,
  each of them over 1 %), it matches the common prefix alone.  Such pairs meet on a prefix; none is missed.
* The rest meet in MinHash bands.  M is at most the common part of both multisets, so a ratio of t means a Jaccard
  similarity of at least t / (2 - t) of the sets of numbered elements (first, second, ... occurrence): a pair of
  ``bands`` bands of ``rows`` rows is missed with probability (1 - J^rows)^bands at most, 0.03 % for the
  defaults at t = 0.8.

Candidates whose lengths exclude the ratio go before their sequences are fetched; of the rest, those whose longest
common subsequence allows it get their exact ratio.
"""

from __future__ import annotations

import sys
from itertools import combinations

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.session import snapshot

# the ratio travels with the tasks: executors need no copy of the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Pairs of sequences of up to so many elements meet on common subsequences: 1067 keys of one of 12 elements at t = 0.8.
SHORT = 12


def common_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, one bit an element of ``a``."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full  # a zero is a step of the longest common subsequence so far
    for y in b:
        met = free & places.get(y, 0)
        free = (free + met | free - met) & full
    return len(a) - free.bit_count()


def block_ratio(threshold: float, autojunk: bool = True):
    """Column function of two arrays: the matching-block ratio, null where the longest common subsequence keeps it under
    ``threshold``.  ``autojunk`` leaves out elements that make up over 1 % of a second sequence of 200 or more, as the
    standard matcher does unless told otherwise."""

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        def one(x: list, y: list) -> float | None:
            if 2.0 * common_length(x, y) / (len(x) + len(y)) < threshold:
                return None
            return SequenceMatcher(None, x, y, autojunk).ratio()

        return pd.Series([one(list(x), list(y)) for x, y in zip(a, b, strict=True)], dtype="float64")

    return ratio


def sequence_classes(visits: DataFrame, group: str, seq: str, ids: list[str]) -> DataFrame:
    """``group, seq, class, n``: one row per distinct sequence of a group, named by its smallest ids, with its rows.
    A null group is a group; rows without a sequence (null or empty) have no class."""
    return visits.where(F.size(F.col(seq)) > 0).groupBy(F.col(group).alias("group"), F.col(seq).alias("seq")).agg(
        F.min(F.struct(*ids)).alias("class"), F.count("*").alias("n"))


def sequence_bands(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """``group, class, length, band``: ``bands`` MinHash keys of each class, over its numbered elements."""
    items = classes.select("group", "class", F.size("seq").alias("length"), F.explode("seq").alias("item"))
    counted = items.groupBy("group", "class", "length", "item").agg(F.count("*").alias("times"))
    each = counted.select("group", "class", "length", F.col("item").isNull().alias("none"), "item",
                          F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("nth"))
    least = each.groupBy("group", "class", "length").agg(
        *[F.min(F.xxhash64(F.lit(k), "none", "item", "nth")).alias(f"m{k}") for k in range(bands * rows)])
    keys = F.array(*[F.xxhash64(F.lit(b), *[f"m{b * rows + i}" for i in range(rows)]) for b in range(bands)])
    return least.select("group", "class", "length", F.explode(keys).alias("band"))


def _matched(lo: int, hi: int, threshold: float) -> int | None:
    """The fewest matched elements with which sequences of these lengths reach the ratio."""
    return next((m for m in range(lo + 1) if 2.0 * m / (lo + hi) >= threshold), None)


def _oriented(left: str, right: str) -> list[Column]:
    """Two classes as ``a`` (the smaller) and ``b``."""
    first = F.col(left) < F.col(right)
    return [F.when(first, F.col(left)).otherwise(F.col(right)).alias("a"), F.when(first, F.col(right)).otherwise(F.col(left)).alias("b")]


def _hashes(seq: str | Column) -> Column:
    """One number an element (the hash of an array passes over nulls)."""
    return F.transform(seq, lambda x: F.xxhash64(x.isNull(), x))


def short_pairs(classes: DataFrame, threshold: float, short: int) -> DataFrame:
    """``group, a, b``: pairs of classes of up to ``short`` elements with a common subsequence that allows the ratio."""
    picks = []
    for lo in range(1, short + 1):
        for hi in range(lo, short + 1):
            m = _matched(lo, hi, threshold)
            # equal lengths matched in full are equal sequences, which are one class
            if m is not None and not (lo == hi == m):
                picks += [(n, lo, hi, [list(at) for at in combinations(range(n), m)]) for n in sorted({lo, hi})]
    # a fixed table: one row per pair of lengths
    picks = F.broadcast(classes.sparkSession.createDataFrame(picks, "length int, lo int, hi int, picks array<array<int>>"))
    rows = classes.withColumn("length", F.size("seq")).where(F.col("length") <= short).withColumn("items", _hashes("seq")).join(picks, "length")
    keys = F.array_distinct(F.transform("picks", lambda at: F.xxhash64(
        "group", "lo", "hi", F.transform(at, lambda i: F.get(F.col("items"), i)))))
    keyed = rows.select("group", "class", "length", "lo", "hi", F.explode(keys).alias("key"))
    # the shorter meet the longer ones; two of the same length meet once
    left = keyed.where(F.col("length") == F.col("lo")).select("group", F.col("class").alias("l"), "lo", "hi", "key")
    right = keyed.where(F.col("length") == F.col("hi")).select(
        F.col("group").alias("group_r"), F.col("class").alias("r"), F.col("lo").alias("lo_r"), F.col("hi").alias("hi_r"), "key")
    met = left.join(right, "key").where(
        F.col("group").eqNullSafe(F.col("group_r")) & (F.col("lo") == F.col("lo_r")) & (F.col("hi") == F.col("hi_r"))
        & ((F.col("lo") < F.col("hi")) | (F.col("l") < F.col("r"))))
    return met.select("group", *_oriented("l", "r"))


def _prefix_only(seq: str) -> Column:
    """The matcher finds nothing but a common prefix for such a second sequence: each of its elements makes up over 1 %."""
    n, items = F.size(seq), F.array_distinct(seq)
    times = lambda x: F.size(F.filter(seq, lambda y: y.eqNullSafe(x)))
    return F.when((n >= 200) & (F.size(items) < 100), F.forall(items, lambda x: times(x) > F.floor(n / 100) + 1)).otherwise(False)


def prefix_pairs(classes: DataFrame, threshold: float, short: int) -> DataFrame:
    """``group, a, b``: pairs with a ``prefix`` class as b, and as long a common prefix as a power of two allows that is
    at most the matched elements of any pair of that b."""
    n, share = F.size("seq"), threshold / (2 - threshold)  # of the longer sequence, at least, is the shorter one
    powers = F.array(*[F.lit(1 << k) for k in range(31)])
    key = F.xxhash64("group", "p", _hashes(F.slice("seq", 1, F.col("p")))).alias("key")
    fits = lambda p, least: (p <= n) & (p > F.floor(n * least))
    last = classes.where("prefix").withColumn("p", F.array_max(F.filter(powers, lambda p: p <= F.greatest(F.lit(1), F.floor(n * share)))))
    first = classes.where(n > 0).withColumn("p", F.explode(F.filter(powers, lambda p: fits(p, share * share / 2 * 0.99))))
    first = first.select("group", F.col("class").alias("a"), n.alias("length"), "p", key)
    last = last.select(F.col("group").alias("group_b"), F.col("class").alias("b"), n.alias("length_b"), F.col("p").alias("p_b"), key)
    return first.join(last, "key").where(
        F.col("group").eqNullSafe(F.col("group_b")) & (F.col("p") == F.col("p_b")) & (F.col("a") < F.col("b"))
        & _lengths_allow(threshold)).select("group", "a", "b")


def _lengths_allow(threshold: float) -> Column:
    """2 min(|a|, |b|) / (|a| + |b|) bounds the ratio."""
    return 2.0 * F.least("length", "length_b") / (F.col("length") + F.col("length_b")) >= threshold


def long_pairs(classes: DataFrame, threshold: float, short: int, bands: int, rows: int) -> DataFrame:
    """``group, a, b``: pairs with a sequence of more than ``short`` elements that meet in a band."""
    size = F.size("seq")
    near = classes.where(size * (2.0 - threshold) / threshold * 1.01 > short)
    band = sequence_bands(near, bands, rows).join(
        near.select(F.col("group").alias("group_n"), F.col("class").alias("class_n"), "prefix"),
        F.col("group").eqNullSafe(F.col("group_n")) & (F.col("class") == F.col("class_n"))).drop("group_n", "class_n")
    band = snapshot(band, "sequence-bands")
    left = band.where(F.col("length") > short).withColumnRenamed("class", "l").withColumnRenamed("prefix", "prefix_l")
    right = band.select(F.col("group").alias("group_r"), F.col("class").alias("r"), F.col("length").alias("length_b"), "band", "prefix")
    last_is_prefix = F.when(F.col("l") < F.col("r"), F.col("prefix")).otherwise(F.col("prefix_l"))
    met = left.join(right, "band").where(
        F.col("group").eqNullSafe(F.col("group_r")) & ((F.col("length_b") <= short) | (F.col("l") < F.col("r")))
        & _lengths_allow(threshold) & ~last_is_prefix)
    return met.select("group", *_oriented("l", "r"))


def similar_sequences(classes: DataFrame, threshold: float = 0.8, bands: int = 24, rows: int = 3, autojunk: bool = True,
                      short: int = SHORT) -> DataFrame:
    """``group, a, b, n_a, n_b, ratio``: pairs of classes (a before b) of one group whose ratio, taken from a to b, is
    ``threshold`` or more; their rows follow from the classes.  Null elements equal each other.  Empty table: no rows."""
    classes = snapshot(classes.withColumn("prefix", _prefix_only("seq") if autojunk else F.lit(False)), "sequence-classes")
    met = short_pairs(classes, threshold, short).unionByName(prefix_pairs(classes, threshold, short)).unionByName(
        long_pairs(classes, threshold, short, bands, rows))
    pairs = met.distinct()
    side = lambda s: classes.select(F.col("group").alias(f"group_{s}"), F.col("class").alias(s), F.col("seq").alias(f"seq_{s}"),
                                    F.col("n").alias(f"n_{s}"))
    pairs = pairs.join(side("a"), "a").where(F.col("group").eqNullSafe(F.col("group_a"))).join(side("b"), "b").where(
        F.col("group").eqNullSafe(F.col("group_b")))
    return pairs.withColumn("ratio", block_ratio(threshold, autojunk)("seq_a", "seq_b")).where(F.col("ratio") >= threshold).select(
        "group", "a", "b", "n_a", "n_b", "ratio")
