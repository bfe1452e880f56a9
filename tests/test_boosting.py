"""Boosted folds against one-fold fits and a plain numpy version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnstile.operators import boosting as B


def table(spark, n=900, seed=4):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 9, n), rng.normal(0, 1, n).round(1), rng.integers(0, 2, n)
    y = 3.0 * a + 5 * np.sin(b) * c + rng.normal(0, 0.5, n)
    rows = [(int(i % 3), float(x), float(z), int(w), float(v)) for i, (x, z, w, v) in enumerate(zip(a, b, c, y))]
    return spark.createDataFrame(rows, "fold int, a double, b double, c int, y double"), rows


def plain(rows, edges, left_out, trees, depth, rate, reg):
    """Greedy trees on the binned values, one node at a time: (mean squared error of the left-out rows)."""
    x = np.array([[sum(v > e for e in edges[k]) for k, v in zip("abc", r[1:4])] for r in rows])
    y, train = np.array([r[4] for r in rows]), np.array([r[0] != left_out for r in rows])
    now = np.full(len(y), y[train].mean())

    def grow(inside, level):
        rest, used = y - now, inside & train
        g, h = rest[used].sum(), used.sum()
        best = None
        if level < depth:
            for f in range(3):
                for cut in range(x[:, f].max() + 1):
                    lo = used & (x[:, f] <= cut)
                    hi = used & (x[:, f] > cut)
                    if lo.sum() and hi.sum():
                        gain = rest[lo].sum() ** 2 / (lo.sum() + reg) + rest[hi].sum() ** 2 / (hi.sum() + reg) - g * g / (h + reg)
                        if gain > 1e-9 * (1 + g * g / (h + reg)) and (best is None or gain > best[0] + 1e-9 * abs(best[0])):
                            best = gain, f, cut
        if best is None:
            return np.where(inside, rate * g / (h + reg), 0.0)
        _, f, cut = best
        return grow(inside & (x[:, f] <= cut), level + 1) + grow(inside & (x[:, f] > cut), level + 1)

    for _ in range(trees):
        now = now + grow(np.ones(len(y), dtype=bool), 0)
    return float(((y - now)[~train] ** 2).mean())


def test_folds_together_equal_folds_alone_and_plain_python(spark, monkeypatch):
    monkeypatch.setattr(B, "CELLS_A_BLOCK", 100)  # several blocks
    df, rows = table(spark)
    options = dict(trees=12, depth=3, rate=0.3, bins=16, cut=5)
    together = B.boost_folds(df, ["a", "b", "c"], "y", "fold", [0, 1, 2], **options)
    assert {f: n for f, (n, _) in together.errors.items()} == {0: 300, 1: 300, 2: 300}
    for fold in range(3):
        alone = B.boost_folds(df, ["a", "b", "c"], "y", "fold", [fold], **options)
        assert alone.errors[fold] == pytest.approx(together.errors[fold], rel=1e-9)
        want = plain(rows, together.edges, fold, 12, 3, 0.3, 1.0)
        assert together.errors[fold][1] == pytest.approx(want, rel=1e-6)
        rows_of = together.predict(df.where(F.col("fold") == fold), fold)
        assert rows_of.agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0] == pytest.approx(together.errors[fold][1], rel=1e-9)


def test_more_trees_fit_closer_and_many_blocks_sum_alike(spark, monkeypatch):
    df, _ = table(spark, 1500)
    few = B.boost_folds(df, ["a", "b", "c"], "y", "fold", [0], trees=3, depth=2)
    more = B.boost_folds(df, ["a", "b", "c"], "y", "fold", [0], trees=20, depth=2)
    assert more.errors[0][1] < few.errors[0][1]
    monkeypatch.setattr(B, "CELLS_A_BLOCK", 10)  # above 32 blocks: summed on the executors
    tree = B.boost_folds(df, ["a", "b", "c"], "y", "fold", [0], trees=3, depth=2)
    assert tree.errors[0] == pytest.approx(few.errors[0], rel=1e-9)


def test_edges(spark):
    rows = [(0, None, 1.0), (0, 2.0, None), (1, 3.0, 4.0), (1, None, 4.0), (1, 3.0, 4.0)]
    df = spark.createDataFrame(rows, "fold int, a double, y double")
    m = B.boost_folds(df, ["a"], "y", "fold", [0, 1, 7], trees=2, depth=2)
    assert m.errors[0] == (1, pytest.approx(9.0))  # all labels of the other fold are 4
    assert m.errors[1] == (3, pytest.approx(9.0))
    assert 7 not in m.errors
    lone = B.boost_folds(df.where("fold = 1"), ["a"], "y", "fold", [1], trees=2, depth=2)
    assert lone.base == [0.0] and lone.errors[1] == (3, pytest.approx(16.0))  # no training rows: 0
    none = B.boost_folds(df.limit(0), ["a"], "y", "fold", [0], trees=1, depth=1)
    assert none.errors == {} and none.base == [0.0]
    assert B.bin_edges(df, ["a"])["a"] == [2.0]


def test_driver_gets_a_histogram_of_left_nodes_a_task(spark, monkeypatch):
    """Not one per block, not of all folds' rows, and no padding to the widest feature."""
    from pyspark.rdd import RDD

    got, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: got.append(collect(self)) or got[-1])
    monkeypatch.setattr(B, "CELLS_A_BLOCK", 40)
    df, _ = table(spark, 1200)
    model = B.boost_folds(df, ["a", "b", "c"], "y", "fold", [0, 1, 2], trees=2, depth=3)
    bins = sum(len(e) + 1 for e in model.edges.values())
    hists = [x for x in got if x and isinstance(x[0], np.ndarray) and x[0].ndim == 4]
    assert len(hists) == 6  # one job a level
    for level, found in enumerate(hists):
        assert len(found) <= max(B.GATHERED, spark.sparkContext.defaultParallelism)
        assert {h.shape for h in found} == {(3, 2, max(1, 1 << (level % 3) >> 1), bins)}
