"""M6: density clusters by distance (DBSCAN) in the plane, without pairs of all points.

Cells have a diagonal of ``eps``, so points of one cell are neighbours of each other: a cell with enough
points needs no distance at all, and a point of any other cell, of which there are fewer than ``min_pts``,
is compared with the points of the 25 cells around it.  Two neighbouring cells belong together if some core
point of one is within ``eps`` of one of the other.  That is decided on bounding boxes, refined four ways a
level: boxes wholly within reach decide for their cells, boxes wholly out of it go, and what is left is
compared point by point only where the two boxes hold few points.  Points are distinct coordinates with
their number of rows, so copies cost nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.session import snapshot

#: points beyond so many cells from the origin are noise: there a double no longer tells cells apart
FARTHEST = float(1 << 50)


def cell_side(eps: float) -> float:
    """Side of a cell whose diagonal is ``eps``, rounding included."""
    return eps / math.sqrt(2.0) * (1 - 1e-9)


def _cell(x: Column, y: Column, side: float) -> Column:
    return F.struct(F.floor(x / side).alias("cx"), F.floor(y / side).alias("cy"))


def _around(df: DataFrame, cell: str, into: str) -> DataFrame:
    """Every row once for each of the 25 cells that its own cell can reach."""
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in range(-2, 3) for dy in range(-2, 3)])
    return df.withColumn("_step", F.explode(steps)).withColumn(into, F.struct(
        (F.col(f"{cell}.cx") + F.col("_step.dx")).alias("cx"), (F.col(f"{cell}.cy") + F.col("_step.dy")).alias("cy"))).drop("_step")


def _seen(points: DataFrame) -> DataFrame:
    """Points as ``ax, ay``, once for each cell they can reach."""
    return _around(points.select(F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("cell").alias("home")), "home", "cell").drop("home")


def _near(ax: str, ay: str, bx: str, by: str, eps: float) -> Column:
    dx, dy = F.col(ax) - F.col(bx), F.col(ay) - F.col(by)
    return dx * dx + dy * dy <= eps * eps


def _boxes(core: DataFrame, side: float, level: int) -> DataFrame:
    """``cell, sub, n, x0, x1, y0, y1``: tight boxes of the core points in the parts of a cell, halved ``level`` times."""
    return core.groupBy("cell", _cell(F.col("x"), F.col("y"), side / (1 << level)).alias("sub")).agg(
        F.count("*").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))


def _sided(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])


def _box_gap(lo_a: str, hi_a: str, lo_b: str, hi_b: str) -> tuple[Column, Column]:
    """Least and greatest distance of two intervals."""
    least = F.greatest(F.lit(0.0), F.col(lo_a) - F.col(hi_b), F.col(lo_b) - F.col(hi_a))
    most = F.greatest(F.col(hi_a) - F.col(lo_b), F.col(hi_b) - F.col(lo_a))
    return least, most


def linked_cells(core: DataFrame, side: float, eps: float, few: int = 4096, deepest: int = 40) -> DataFrame:
    """``a, b``: neighbouring cells (a before b) that hold core points within ``eps`` of each other.

    ``few`` bounds the comparisons of a pair of boxes; boxes of 2^-``deepest`` of a cell are compared whatever they hold.
    Neither changes the result."""
    boxes = _boxes(core, side, 0)
    names = boxes.select(F.col("cell").alias("a_cell"))
    pairs = _around(names, "a_cell", "b_cell").where(F.col("a_cell") < F.col("b_cell"))
    open_pairs = pairs.join(_sided(boxes, "a"), "a_cell").join(_sided(boxes, "b"), "b_cell")
    found = None
    for level in range(deepest + 1):
        (dx0, dx1), (dy0, dy1) = _box_gap("a_x0", "a_x1", "b_x0", "b_x1"), _box_gap("a_y0", "a_y1", "b_y0", "b_y1")
        kind = (F.when(dx1 * dx1 + dy1 * dy1 <= eps * eps, "linked").when(dx0 * dx0 + dy0 * dy0 > eps * eps, "apart")
                .when((F.col("a_n") * F.col("b_n") <= few) | F.lit(level == deepest), "few").otherwise("many"))
        judged = snapshot(open_pairs.withColumn("kind", kind).where(F.col("kind") != "apart")
                          .select("a_cell", "b_cell", "a_sub", "b_sub", "kind"), "density-boxes")
        ends = ["a_cell", "b_cell"]
        linked = judged.where(F.col("kind") == "linked").select(*ends).distinct()
        few_pairs = judged.where(F.col("kind") == "few").join(linked, ends, "left_anti")
        parts = core.select("cell", _cell(F.col("x"), F.col("y"), side / (1 << level)).alias("sub"), "x", "y")
        each = few_pairs.join(_sided(parts, "a"), ["a_cell", "a_sub"]).join(_sided(parts, "b"), ["b_cell", "b_sub"])
        linked = snapshot(linked.unionByName(each.where(_near("a_x", "a_y", "b_x", "b_y", eps)).select(*ends)).distinct(), "density-links")
        found = linked if found is None else found.unionByName(linked)
        many = judged.where(F.col("kind") == "many").join(linked, ends, "left_anti").select(*ends, "a_sub", "b_sub")
        if level == deepest or many.isEmpty():
            break
        many = snapshot(many, "density-open")
        busy = many.select(F.explode(F.array("a_cell", "b_cell")).alias("cell")).distinct()
        halves = _boxes(core.join(busy, "cell", "left_semi"), side, level + 1)
        up = lambda s: F.struct(F.shiftright(F.col(s)["cx"], 1).alias("cx"), F.shiftright(F.col(s)["cy"], 1).alias("cy"))
        many = many.withColumnsRenamed({"a_sub": "a_up", "b_sub": "b_up"})
        open_pairs = (many.join(_sided(halves, "a").withColumn("a_up", up("a_sub")), ["a_cell", "a_up"])
                      .join(_sided(halves, "b").withColumn("b_up", up("b_sub")), ["b_cell", "b_up"]))
    return found.distinct().withColumnsRenamed({"a_cell": "a", "b_cell": "b"})


def smallest_reachable(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node of each node's component.  Labels move along the links and then
    jump to the label of their label, so long chains take few rounds."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = snapshot(both.unionByName(nodes.select(F.col("node").alias("a"), F.col("node").alias("b"))), "density-graph")
    labels = nodes.select("node", F.col("node").alias("label"))
    while True:
        step = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("label"))
        step = snapshot(step.withColumnRenamed("a", "node"), "density-step")
        hop = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = snapshot(step.join(hop, "label").select("node", F.col("further").alias("label")), "density-labels")
        if new.join(labels.withColumnRenamed("label", "old"), "node").where(F.col("label") != F.col("old")).isEmpty():
            return new
        labels = new


def density_clusters(df: DataFrame, x: str, y: str, eps: float = 0.5, min_pts: int = 10, few: int = 4096) -> DataFrame:
    """``df`` with ``cluster`` (a column of that name is replaced).  A row with ``min_pts`` rows within ``eps``, itself
    included, is core; core rows within ``eps`` of each other share a cluster, named ``cx:cy`` by its smallest cell;
    any other row within ``eps`` of a core row joins the least of the clusters it touches; the rest is noise (NULL).

    Null, NaN, infinite and unreachably far coordinates are noise and nobody's neighbour.  Empty table: empty result."""
    side = cell_side(eps)
    px, py = F.col(f"`{x}`").cast("double"), F.col(f"`{y}`").cast("double")
    pts = df.select(px.alias("x"), py.alias("y")).where(
        (F.abs(F.col("x")) < FARTHEST * side) & (F.abs(F.col("y")) < FARTHEST * side))
    pts = pts.groupBy("x", "y").agg(F.count("*").alias("n")).withColumn("cell", _cell(F.col("x"), F.col("y"), side))
    pts = snapshot(pts, "density-points")
    full = pts.groupBy("cell").agg(F.sum("n").alias("rows")).where(F.col("rows") >= min_pts).select("cell")
    full = snapshot(full, "density-full")
    sparse = snapshot(pts.join(full, "cell", "left_anti"), "density-sparse")  # fewer than min_pts rows a cell
    enough = (_seen(sparse).join(pts, "cell").where(_near("ax", "ay", "x", "y", eps)).groupBy("ax", "ay")
              .agg(F.sum("n").alias("rows")).where(F.col("rows") >= min_pts).select(F.col("ax").alias("x"), F.col("ay").alias("y")))
    enough = snapshot(enough, "density-enough")
    core = pts.join(full, "cell", "left_semi").select("x", "y", "cell").unionByName(
        sparse.join(enough, ["x", "y"], "left_semi").select("x", "y", "cell"))
    core = snapshot(core, "density-core")
    cells = core.select(F.col("cell").alias("node")).distinct()
    labels = smallest_reachable(cells, linked_cells(core, side, eps, few)).withColumnRenamed("node", "cell")
    # points of full cells have the label of their cell; only those of other cells are looked up by place
    inner = sparse.join(enough, ["x", "y"], "left_semi").join(labels, "cell").select("x", "y", "label")
    rest = _seen(sparse.join(enough, ["x", "y"], "left_anti"))
    border = (rest.join(core.join(labels, "cell").select("x", "y", "cell", "label"), "cell")
              .where(_near("ax", "ay", "x", "y", eps)).groupBy("ax", "ay").agg(F.min("label").alias("label")))
    of = inner.unionByName(border.select(F.col("ax").alias("x"), F.col("ay").alias("y"), "label"))
    # stored, so that their sizes are known before the join: small tables are sent to the rows, which stay where they are
    of = snapshot(of.select(F.col("x").alias("__x"), F.col("y").alias("__y"), F.col("label").alias("__label")), "density-places")
    whole = snapshot(labels.join(full, "cell", "left_semi").select(
        F.col("cell.cx").alias("__cx"), F.col("cell.cy").alias("__cy"), F.col("label").alias("__whole")), "density-whole")
    rows = df.drop("cluster") if "cluster" not in (x, y) else df
    near = (F.abs(px) < FARTHEST * side) & (F.abs(py) < FARTHEST * side)
    at = lambda v: F.when(near, F.floor(v / side))
    out = rows.join(whole, (at(px) == F.col("__cx")) & (at(py) == F.col("__cy")), "left").join(
        of, (px == F.col("__x")) & (py == F.col("__y")), "left")
    label = F.coalesce("__whole", "__label")
    name = F.when(label.isNotNull(), F.concat_ws(":", label["cx"].cast("string"), label["cy"].cast("string")))
    return out.withColumn("cluster", name).drop("__x", "__y", "__cx", "__cy", "__whole", "__label")
