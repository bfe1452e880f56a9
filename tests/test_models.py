"""MLlib jobs: monotone SSE, metric bounds, reproducibility."""

from pyspark.sql import functions as F

from turnstile.operators import boosting as B
from turnstile.operators import models as M
from turnstile.plans import models as PM

from turnstile.sources.tables import table

from .conftest import SF_SMALL


def test_elbow_sse_decreases(spark):
    pts = PM._cluster_points(spark, SF_SMALL).cache()
    sse = [s for _, s in M.elbow(pts, [2, 4, 8], n_init=2)]
    assert sse[0] >= sse[1] >= sse[2]


def test_forest_metrics_bounds_and_seed(spark):
    st = PM.staff_table(spark, SF_SMALL)
    train, test = M.split_by_hash(st, "staff_key")
    pipe = M.forest_pipeline(PM.STAFF_FEATURES, "carried", trees=10, depth=4)
    m1 = M.regression_metrics(pipe.fit(train).transform(test), "carried").first()
    m2 = M.regression_metrics(pipe.fit(train).transform(test), "carried").first()
    assert m1.rmse >= 0 and m1.mae >= 0 and m1.r2 <= 1
    assert m1 == m2


def test_leave_one_out_contribution_is_exact(spark):
    model = PM.complaint_classifier(spark, SF_SMALL)
    d = table(spark, SF_SMALL, "documents").select("doc_id", "text").limit(30)
    scored = M.score_texts(model, d)
    contrib = M.word_contributions(model, scored, threshold=0.0)
    row = contrib.where(F.col("contribution") != 0).orderBy("doc_id", "pos").first()
    if row is None:
        return
    text = d.where(F.col("doc_id") == row.doc_id).first().text
    import re
    toks = re.findall(r"\w\w+", text.lower())
    assert toks[row.pos] == row.word
    # rescoring the document with that one occurrence removed gives the same probability change
    words = [m for m in re.finditer(r"\w\w+", text.lower())]
    cut = words[row.pos]
    rest = text.lower()[:cut.start()] + " " + text.lower()[cut.end():]
    p0 = M.score_texts(model, spark.createDataFrame([(text,)], "text string")).first().p_negative
    p1 = M.score_texts(model, spark.createDataFrame([(rest,)], "text string")).first().p_negative
    assert abs((p0 - p1) - row.contribution) < 1e-9


def test_forest_folds_run_beside_the_boosted_trees(spark, monkeypatch):
    import threading
    both = threading.Barrier(2, timeout=60)  # broken if one waits for the other's end

    def forest(*a, **k):
        both.wait()
        return [(0, 0.5)]

    def boosted(*a, **k):
        both.wait()
        model = B.BoostedFolds([], {}, [0])
        model.errors[0] = (3, 2.0)
        return model

    monkeypatch.setattr(PM.M, "kfold_scores", forest)
    monkeypatch.setattr(PM.B, "boost_folds", boosted)
    assert sorted(map(tuple, PM.cv_scores(spark, SF_SMALL).collect())) == [("boosted_neg_mse", 0, -2.0), ("forest_r2", 0, 0.5)]


def test_cv_scores_fold_the_demand_model_over_all_rows(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(M, "kfold_scores", lambda *a, **k: [(0, 1.0)])
    grow = B.boost_folds

    def few(df, *a, trees, **k):
        seen.update(trees=trees, model=grow(df, *a, trees=2, **k))
        return seen["model"]
    monkeypatch.setattr(B, "boost_folds", few)
    rows = PM.cv_scores(spark, SF_SMALL).collect()
    assert seen["trees"] == PM.BOOSTED_TREES == 500
    assert sum(n for n, _ in seen["model"].errors.values()) == table(spark, SF_SMALL, "lineitem").count()
    assert sorted(r.fold for r in rows if r.score == "boosted_neg_mse") == list(range(5))
    assert all(r.value < 0 for r in rows if r.score == "boosted_neg_mse")


def test_density_segments_equal_brute_force_over_all_customers(spark):
    got = {r.c_custkey: r.cluster for r in PM.density_segments(spark, SF_SMALL).collect()}
    cell = {r.c_custkey: (int(r.pc1 // 0.5), int(r.pc2 // 0.5)) for r in PM._pca(spark, SF_SMALL).collect()}
    assert set(got) == set(cell) and len(got) == table(spark, SF_SMALL, "customer").count()
    around = lambda c: [(c[0] + x, c[1] + y) for x in (-1, 0, 1) for y in (-1, 0, 1)]
    cells = list(cell.values())
    count = {c: cells.count(c) for c in set(cells)}
    core = {c for c in count if sum(count.get(n, 0) for n in around(c)) >= 10}
    label = {}
    for start in sorted(core):
        todo = [] if start in label else [start]
        while todo:
            c = todo.pop()
            if label.setdefault(c, start) == start:
                todo += [n for n in around(c) if n in core and n not in label]
    for k, c in cell.items():
        near = [label[c]] if c in core else sorted(label[n] for n in around(c) if n in core)
        assert got[k] == ("%d:%d" % near[0] if near else None)
    assert len(core) > 1


def test_elbow_fits_read_points_that_are_not_cached(spark, monkeypatch):
    """MLlib keeps its own vectors of an uncached frame; over cached rows each iteration decodes every row again."""
    levels, plain = [], M.KMeans

    class Seen(plain):
        def fit(self, df):
            levels.append(df.storageLevel)
            return super().fit(df)
    monkeypatch.setattr(M, "KMeans", Seen)
    monkeypatch.setattr(PM, "KMEANS_STARTS", 1)
    rows = PM.kmeans_elbow(spark, SF_SMALL).collect()
    assert [r.k for r in rows] == list(range(2, 11)) and len(levels) == 9
    assert not any(x.useMemory or x.useDisk for x in levels)


def test_cluster_points_have_no_more_tasks_than_their_size_asks_for(spark):
    """A k-means run has hundreds of jobs: tasks of every shuffle partition would flood the driver with results."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pts = PM._cluster_points(spark, SF_SMALL)
        assert pts.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
        assert pts.count() == table(spark, SF_SMALL, "customer").count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_classifier_and_contributions_read_each_text_once(spark, monkeypatch):
    """The folds read stored counts, the words and their weights stored texts with their score: no pass over the documents."""
    seen = []

    class Stop(Exception):
        pass

    class Fits:
        def fit(self, train):
            seen.extend(train.inputFiles())
            raise Stop
    monkeypatch.setattr(PM, "_FITTED", {})
    with monkeypatch.context() as m:
        m.setattr(M, "text_classifier", Fits)
        try:
            PM.complaint_classifier(spark, SF_SMALL)
        except Stop:
            pass
    assert seen and all("/labelled-terms-" in f for f in seen)
    texts = [(i, f"{'bad awful' if i % 2 else 'good nice'} ride {i % 5}", float(i % 2)) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id int, text string, label double")
    model = M.text_classifier(reg_params=[0.01], folds=2).fit(M.hash_terms(docs)).bestModel
    contrib = M.word_contributions(model, M.score_texts(model, docs))
    files = contrib.inputFiles()
    assert files and all("/negative-texts-" in f for f in files)
    rows = contrib.collect()
    assert {r.doc_id for r in rows} == {i for i, _, label in texts if label} and len(rows) == 30 * 3
    assert all((r.contribution > 0) == (r.word in ("bad", "awful")) for r in rows if r.word != "ride")


def test_grid_density_joins_only_the_points(spark, monkeypatch):
    """Cells are summed around each other, not joined with each other in every step; labels and noise by brute force."""
    chain = [(0.5 * i + 0.1, 0.1) for i in range(23) for _ in range(4)]  # longer than two rounds of label steps
    blob = [(0.1, 20.1)] * 10 + [(0.6, 20.6), (1.6, 20.6)]  # one cell beside the core, one too far from it
    rows = [*chain, *blob, (50.1, 50.1), (None, 0.1), (0.1, None), (None, None)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "id int, x double, y double").repartition(3)
    joins, kind = [], type(df)
    monkeypatch.setattr(kind, "join", lambda self, *a, f=kind.join, **b: joins.append(a) or f(self, *a, **b))
    got = {r.id: r.cluster for r in M.grid_density_clusters(df, "x", "y").collect()}
    assert len(joins) == 1
    cells = {}
    for i, (x, y) in enumerate(rows):
        if x is not None and y is not None:
            cells.setdefault((int(x // 0.5), int(y // 0.5)), []).append(i)
    near = {c: [d for d in cells if abs(c[0] - d[0]) <= 1 and abs(c[1] - d[1]) <= 1] for c in cells}
    core = {c: c for c in cells if sum(len(cells[d]) for d in near[c]) >= 10}
    for _ in core:
        core = {c: min(core[d] for d in near[c] if d in core) for c in core}
    want = dict.fromkeys(range(len(rows)))
    for c, ids in cells.items():
        if found := core.get(c) or min((core[d] for d in near[c] if d in core), default=None):
            want |= dict.fromkeys(ids, f"{found[0]}:{found[1]}")
    assert got == want and set(want.values()) == {"1:0", "0:40", None}


def test_cluster_compare_evaluates_stored_named_points(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(PM, "KMEANS_STARTS", 1)
    monkeypatch.setattr(M, "silhouette", lambda pred: seen.append((pred.inputFiles(), pred.select("prediction", "features").dropna().count())) or 0.0)
    rows = PM.cluster_compare(spark, SF_SMALL).collect()
    assert [r.model for r in rows] == ["kmeans", "bisecting_kmeans", "grid_density"]
    files, n = seen[-1]
    assert files and all("/density-named-" in f for f in files)
    assert 0 < n <= seen[0][1]
