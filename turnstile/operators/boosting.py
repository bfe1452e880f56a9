"""Boosted regression trees of several folds grown together.

Trees on binned features and squared error see a row only through its bins: the prediction is a function of the
bin combination, so rows of one combination count through their number, sum and sum of squares inside and outside of
each fold.  One aggregate reduces the table to these cells; after it the work no longer depends on the rows.

Boosting needs one global sum per tree level whatever the engine.  Here one job sums the histograms
(fold, node, feature, bin) of all folds' ensembles at once, so five folds cost as many jobs as one fit.  Cells are
numpy blocks in a persisted RDD (a DataFrame job per level would spend its time on planning): a block holds its
cells' current predictions, each finished tree updates them in place of the next level's scan, and a reliable
checkpoint cuts the lineage every ``cut`` trees, so a lost executor costs a few trees of its blocks.  What
comes to the driver per level is a histogram per task, of which there are ``GATHERED`` at most (more are summed in
a tree on the executors first): folds x nodes x bins of all features, two numbers each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.session import ensure_checkpoint_dir, snapshot

CELLS_A_BLOCK = 1 << 15
GATHERED = 12  # histograms a level that the driver sums itself


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 64) -> dict[str, list[float]]:
    """At most ``bins - 1`` cut values per feature from the quantiles of all rows; a feature with fewer distinct
    values is cut between all of them."""
    at = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), at, 100 * bins).alias(c) for c in features],
                 *[F.max(F.col(c).cast("double")).alias(f"{c}__max") for c in features]).first()
    return {c: [e for e in sorted(set(row[c] or [])) if e < row[f"{c}__max"]] for c in features}


def bin_column(value: Column, edges: Sequence[float]) -> Column:
    """Number of edges below the value; null and the smallest values share bin 0."""
    steps = [F.coalesce((value > e).cast("int"), F.lit(0)) for e in edges]
    return reduce(lambda a, b: a + b, steps, F.lit(0)).cast("smallint")


def _blocks(cells: DataFrame, n_features: int, n_folds: int):
    """The cells as numpy blocks, one row per block: bins (cells, features), the numbers and sums of training rows
    (folds, cells), and of left-out rows their numbers, sums and sums of squares."""
    import pickle

    import pyarrow as pa

    parts = max(1, -(-cells.count() // CELLS_A_BLOCK))

    def pack(batches):
        found = [b for b in batches if b.num_rows]
        if found:
            t = pa.Table.from_batches(found)
            # a feature's bins lie side by side, as the histograms read them
            bins = np.stack([t.column(f"b{i}").to_numpy() for i in range(n_features)]).astype(np.int16).T
            each = [np.stack([t.column(f"{c}{e}").to_numpy() for e in range(n_folds)]).astype(np.float64)
                    for c in ("n", "y", "own_n", "own_y", "own_yy")]
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(x)], pa.binary()) for x in ((bins, *each[:2]), (bins, *each[2:]))],
                                             names=["train", "own"])

    return snapshot(cells.repartition(parts).mapInArrow(pack, "train binary, own binary"), "boost-blocks")


def _leaf_of(bins, tree, levels: int):
    """Node reached by every cell after ``levels`` splits of one ensemble's tree."""
    node = np.zeros(len(bins), dtype=np.int64)
    every = np.arange(len(bins))
    for feature, cut in tree[:levels]:
        node = 2 * node + (bins[every, feature[node]] > cut[node])
    return node


def _best_splits(hist, reg: float, min_rows: float):
    """Per node of a summed histogram (nodes, features, bins, 2): feature, last bin of the left side, and (sum, rows)
    of both sides; a node without a gain keeps all on the left."""
    total = hist[:, 0].sum(axis=1)  # (nodes, 2)
    left = hist.cumsum(axis=2)
    right = total[:, None, None] - left
    score = lambda x: x[..., 0] ** 2 / (x[..., 1] + reg)
    gain = score(left) + score(right) - score(total)[:, None, None]
    gain[(left[..., 1] < min_rows) | (right[..., 1] < min_rows)] = -np.inf
    flat = gain.reshape(len(hist), -1)
    pick = flat.argmax(axis=1)
    feature, cut = np.divmod(pick, hist.shape[2])
    nodes = np.arange(len(hist))
    none = ~(flat[nodes, pick] > 1e-9 * (1 + score(total)))
    feature[none], cut[none] = 0, hist.shape[2]
    sides = np.stack([left[nodes, feature, np.minimum(cut, hist.shape[2] - 1)], right[nodes, feature, np.minimum(cut, hist.shape[2] - 1)]], axis=1)
    sides[none, 0], sides[none, 1] = total[none], 0.0
    return feature, cut, sides


def _added(a, b):
    return b if a is None else a if b is None else a + b


class BoostedFolds:
    """Ensembles by left-out fold: ``base``, ``trees`` (levels of (feature, cut) per node, leaf values), bin edges."""

    def __init__(self, features: Sequence[str], edges: dict[str, list[float]], folds: Sequence[int]):
        self.features, self.edges, self.folds = list(features), edges, list(folds)
        self.base: list[float] = []
        self.trees: list[list] = []  # per tree: per fold (levels, leaves)
        self.errors: dict[int, tuple[int, float]] = {}  # left-out fold -> (rows, mean squared error)

    def predict(self, df: DataFrame, fold: int, into: str = "prediction") -> DataFrame:
        """``df`` with the prediction of the ensemble that left ``fold`` out."""
        e = self.folds.index(fold)
        base, trees, leaf_of = self.base[e], [t[e] for t in self.trees], _leaf_of

        @F.pandas_udf("double")
        def score(bins: pd.DataFrame) -> pd.Series:
            b = bins.to_numpy()
            out = np.full(len(b), base)
            for levels, leaves in trees:
                out += leaves[leaf_of(b, levels, len(levels))]
            return pd.Series(out)

        return df.withColumn(into, score(F.struct(*[bin_column(F.col(c).cast("double"), self.edges[c]).alias(f"b{i}")
                                                    for i, c in enumerate(self.features)])))


def boost_folds(df: DataFrame, features: Sequence[str], label: str, fold_col: str, folds: Sequence[int], trees: int = 500,
                depth: int = 4, rate: float = 0.1, reg: float = 1.0, min_rows: float = 1.0, bins: int = 64, cut: int = 50) -> BoostedFolds:
    """One ensemble per entry of ``folds``, trained on the rows of all other folds and scored on its own: squared
    error, the mean of the training labels as the start, leaves ``rate * sum / (rows + reg)``.

    Rows with a null label are left out; a null feature goes with the smallest values.  Equal gains go to the first
    feature and the lowest cut.  A fold without rows has no error; a fold that holds all rows predicts 0."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    src = df.where(F.col(label).isNotNull())
    edges = bin_edges(src, features, bins)
    y = F.col(label).cast("double")
    fold = F.col("fold")
    zero = F.lit(0.0)
    sums = []
    for e, f in enumerate(folds):  # a row without a fold is left out by none
        own = fold.eqNullSafe(F.lit(f))
        sums += [F.count(F.when(~own, 1)).alias(f"n{e}"), F.sum(F.when(own, zero).otherwise(F.col("y"))).alias(f"y{e}"),
                 F.count(F.when(own, 1)).alias(f"own_n{e}"), F.sum(F.when(own, F.col("y")).otherwise(zero)).alias(f"own_y{e}"),
                 F.sum(F.when(own, F.col("y") * F.col("y")).otherwise(zero)).alias(f"own_yy{e}")]
    binned = src.select(*[bin_column(F.col(c).cast("double"), edges[c]).alias(f"b{i}") for i, c in enumerate(features)],
                        F.col(fold_col).cast("int").alias("fold"), y.alias("y"))
    cells = snapshot(binned.groupBy(*[f"b{i}" for i in range(len(features))]).agg(*sums), "boost-cells")
    model = BoostedFolds(features, edges, folds)
    widths = [len(edges[c]) + 1 for c in features]
    starts = np.cumsum([0, *widths])  # bins of all features in one row
    width, every = max(widths, default=1), int(starts[-1])
    n_folds, n_features, leaf_of = len(folds), len(features), _leaf_of
    totals = cells.agg(*[F.sum(f"{c}{e}").alias(f"{c}{e}") for e in range(n_folds) for c in "yn"]).first() if n_folds else {}
    model.base = [totals[f"y{e}"] / totals[f"n{e}"] if totals[f"n{e}"] else 0.0 for e in range(n_folds)]
    base = np.array(model.base)

    def unpack(row):
        import pickle

        bins, n, total = pickle.loads(row.train)
        return bins, n, total, np.repeat(base[:, None], len(bins), axis=1)

    def update(tree):
        def one(block):
            bins, now = block[0], block[-1].copy()
            for e, (levels, leaves) in enumerate(tree):
                now[e] += leaves[leaf_of(bins, levels, len(levels))]
            return (*block[:-1], now)
        return one

    def level_sums(partial, level):
        """Histograms of the root, or of the left nodes of a level: the right ones are the rest of their parents."""
        nodes = 1 << max(level - 1, 0)

        def some(blocks):
            hist = None
            for bins, n, total, now in blocks:
                if hist is None:
                    hist = np.zeros((n_folds, 2, nodes, every))
                for e in range(n_folds):
                    node = leaf_of(bins, partial[e], level)
                    left = np.flatnonzero(node % 2 == 0)
                    node = node[left] // 2 * every
                    rows = n[e][left]
                    rest = total[e][left] - rows * now[e][left]
                    for f in range(n_features):
                        at = node + bins[:, f][left]
                        inside = slice(starts[f], starts[f + 1])
                        for k, w in enumerate((rest, rows)):
                            sums = np.bincount(at, weights=w, minlength=nodes * every).reshape(-1, every)
                            hist[e, k, :, inside] += sums[:, :widths[f]]
            return [] if hist is None else [hist]
        return some

    def by_feature(hist):
        """(nodes, features, bins, 2) of (2, nodes, bins of all features)."""
        out = np.zeros((hist.shape[1], n_features, width, 2))
        for f in range(n_features):
            out[:, f, :widths[f]] = np.moveaxis(hist[:, :, starts[f]:starts[f + 1]], 0, -1)
        return out

    blocks = _blocks(cells, n_features, n_folds)
    state = blocks.select("train").rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
    parts = state.getNumPartitions()
    old = []
    for t in range(trees):
        grown: list[list] = [[] for _ in folds]
        sides = [None] * n_folds
        for level in range(depth):
            sums = state.mapPartitions(level_sums(grown, level))
            if parts > GATHERED:
                sums = sums.treeAggregate(None, _added, _added, depth=2)
                sums = [] if sums is None else [sums]
            else:
                sums = sums.collect()
            left = sum(sums, np.zeros((n_folds, 2, 1 << max(level - 1, 0), every)))
            if level:
                above, hist = hist, np.empty((n_folds, 2, 1 << level, every))
                hist[:, :, 0::2], hist[:, :, 1::2] = left, above - left
            else:
                hist = left
            for e in range(n_folds):
                feature, at, sides[e] = _best_splits(by_feature(hist[e]), reg, min_rows)
                grown[e].append((feature, at))
        for r in old:
            r.unpersist()
        tree = [(grown[e], rate * sides[e][..., 0].ravel() / (sides[e][..., 1].ravel() + reg)) for e in range(n_folds)]
        model.trees.append(tree)
        old = [state]
        state = state.map(update(tree)).persist(StorageLevel.MEMORY_AND_DISK)
        if (t + 1) % cut == 0:
            state.checkpoint()

    grown_trees = model.trees

    def held_out(row):
        import pickle

        bins, n, total, square = pickle.loads(row.own)
        out = np.zeros((n_folds, 2))
        for e in range(n_folds):
            own = n[e] > 0
            box, p = bins[own], np.full(own.sum(), base[e])
            for tree in grown_trees:
                levels, leaves = tree[e]
                p += leaves[leaf_of(box, levels, len(levels))]
            rows = n[e][own]
            out[e] = rows.sum(), (square[e][own] - 2 * p * total[e][own] + rows * p * p).sum()
        return out

    for f, (n, err) in zip(folds, blocks.select("own").rdd.map(held_out).fold(np.zeros((n_folds, 2)), np.add)):
        if n:
            model.errors[f] = (int(n), float(err / n))
    for r in [*old, state]:
        r.unpersist()
    return model
