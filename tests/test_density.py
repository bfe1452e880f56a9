"""Density clusters against the definition, point by point."""

import random

import pytest
from pyspark.sql import functions as F

from turnstile.operators import density as D
from turnstile.plans import models as PM
from turnstile.sources.tables import table

SF_SMALL = "/root/testdata/sf0.001"


def brute(points, eps=0.5, min_pts=10):
    side = D.cell_side(eps)
    near = lambda p, q: (p[0] - q[0]) * (p[0] - q[0]) + (p[1] - q[1]) * (p[1] - q[1]) <= eps * eps
    around = [[j for j, q in enumerate(points) if near(p, q)] for p in points]
    core = [len(a) >= min_pts for a in around]
    cell = [(int(p[0] // side), int(p[1] // side)) for p in points]
    group = [None] * len(points)
    for i in range(len(points)):
        if not core[i] or group[i] is not None:
            continue
        todo, members = [i], []
        group[i] = i
        while todo:
            k = todo.pop()
            members.append(k)
            for j in around[k]:
                if core[j] and group[j] is None:
                    group[j] = i
                    todo.append(j)
        name = min(cell[k] for k in members)
        for k in members:
            group[k] = name
    for i, a in enumerate(around):
        if not core[i]:
            group[i] = min((group[j] for j in a if core[j]), default=None)
    return [None if g is None else "%d:%d" % g for g in group]


def clusters(spark, points, **options):
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "id int, x double, y double")
    got = {r.id: r.cluster for r in D.density_clusters(df, "x", "y", **options).collect()}
    return [got[i] for i in range(len(points))]


@pytest.mark.parametrize("seed,few", [(1, 4096), (2, 1)])
def test_equals_the_definition(spark, seed, few):
    rng = random.Random(seed)
    points = [(rng.gauss(cx, s), rng.gauss(cy, s)) for cx, cy, s, n in
              ((0, 0, .4, 60), (1.6, 0, .3, 40), (5, 5, .2, 30), (-3, 2, .9, 50)) for _ in range(n)]
    points += [(rng.uniform(-6, 8), rng.uniform(-5, 8)) for _ in range(60)]
    points += points[:25]  # repeated rows
    want = brute(points)
    assert clusters(spark, points, few=few) == want
    assert len(set(want)) >= 3 and None in want  # two clusters at least, and noise


def test_cells_that_face_each_other_across_a_gap(spark):
    """Full neighbouring cells whose core points are a hair within, or out of, reach."""
    for gap, names in ((0.5, {"0:0"}), (0.5000001, {"0:0", "1:0"})):
        points = [(0.05, 0.01 * i) for i in range(12)] + [(0.05 + gap, 0.01 * i) for i in range(12)]
        assert clusters(spark, points, few=1) == brute(points)
        assert set(brute(points)) == names


def test_long_chain_border_and_odd_values(spark):
    chain = [(k * 0.5 + 0.125, 0.125) for k in range(60) for _ in range(10)]
    assert set(clusters(spark, chain)) == {"0:0"} == set(brute(chain))  # steps of exactly eps
    nan, inf = float("nan"), float("inf")
    points = [(0.1, 0.1)] * 10 + [(0.55, 0.1), (1.2, 0.1), (nan, 0.1), (inf, 0.0), (1e300, 0.1)] + [(-0.0, 0.1)]
    assert clusters(spark, points) == ["0:0"] * 11 + [None] * 4 + ["0:0"]
    df = spark.createDataFrame([(None, 1.0, "a")], "x double, y double, cluster string")
    assert [(r.x, r.cluster) for r in D.density_clusters(df, "x", "y").collect()] == [(None, None)]
    assert D.density_clusters(df.limit(0), "x", "y").count() == 0


def test_customers_in_their_components_equal_the_definition(spark):
    points = PM._pca(spark, SF_SMALL).select("c_custkey", "pc1", "pc2")
    rows = points.collect()
    got = {r.c_custkey: r.cluster for r in D.density_clusters(points, "pc1", "pc2").collect()}
    assert [got[r.c_custkey] for r in rows] == brute([(r.pc1, r.pc2) for r in rows])
    assert len(got) == table(spark, SF_SMALL, "customer").count()


def test_registered_query_takes_every_line(spark):
    got = PM.density_clusters(spark, SF_SMALL)
    assert got.count() == table(spark, SF_SMALL, "lineitem").count()
    assert got.where(F.col("cluster").isNotNull()).count() > 0


def test_rows_of_full_cells_are_named_without_a_shuffle(spark):
    """Cells name their rows: the rows are not dealt by their coordinates, however many distinct points there are."""
    rng = random.Random(5)
    points = [(rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(20000)] + [(9.0 + i, 9.0) for i in range(20)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, x double, y double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        got = D.density_clusters(df, "x", "y")
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
        assert {r.cluster for r in got.where("id >= 20000").collect()} == {None}
        assert got.where("id < 20000 and abs(x) < 2 and abs(y) < 2").where("cluster is null").isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
