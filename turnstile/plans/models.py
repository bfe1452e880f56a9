"""Model queries.

Customer features = account balance + order count + spend; demand = line
price from line features; staffing = daily carried per (day, park, ride);
review classifier = documents with the ``toxic`` label.  All but
``standardize`` and ``model_metrics`` are rows-only in the oracle.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnstile.operators import boosting as B
from turnstile.operators import density as D
from turnstile.operators import models as M
from turnstile.operators.density import cell_side
from turnstile.plans.registry import register
from turnstile.session import snapshot
from turnstile.sources.tables import table

CUST_FEATURES = ["c_acctbal", "n_orders", "spend"]
LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "rf_idx", "ls_idx", "ship_month"]
# Sizes of the models (tests lower them).
BOOSTED_TREES, FOREST_TREES, KMEANS_STARTS = 500, 100, 10
CV_TREES = BOOSTED_TREES  # the folds score the model of M11, not a smaller one
STAFF_FEATURES = ["attendance", "n_lines", "avg_discount", "park_idx", "ride_idx", "weekday"]

# the last fitted review classifier, by the state of its input files
_FITTED: dict = {}


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("spend"))
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    return j.select("c_custkey", "c_acctbal", F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
                    F.coalesce("spend", F.lit(0.0)).alias("spend"))


def _scaled(spark, sf_dir):
    # joined and summed once: the moments, the components and the projection all read it
    z = M.standardize(snapshot(customer_features(spark, sf_dir), "customer-features"), CUST_FEATURES)
    return M.assemble(z, [c + "_z" for c in CUST_FEATURES])


def _pca(spark, sf_dir):
    return M.pca(_scaled(spark, sf_dir), k=2)


@register("standardize", """WITH o AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS spend FROM orders GROUP BY 1),
cf AS (SELECT c.c_custkey, c.c_acctbal, coalesce(o.n, 0) AS n_orders, coalesce(o.spend, 0.0) AS spend
  FROM customer c LEFT JOIN o ON c.c_custkey = o.o_custkey)
SELECT c_custkey, """ + ", ".join(
    f"round(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0), 6) AS {c}_z"
    for c in CUST_FEATURES) + " FROM cf")
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: population-std z-scores (global moments as a one-row finaliser)."""
    z = M.standardize(customer_features(spark, sf_dir), CUST_FEATURES)
    return z.select("c_custkey", *[F.round(c + "_z", 6).alias(c + "_z") for c in CUST_FEATURES])


@register("pca2")
def pca2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: two principal components of the standardised features."""
    return _pca(spark, sf_dir).select("c_custkey", "pc1", "pc2")


@register("kmeans_elbow")
def kmeans_elbow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: SSE for k = 2..10, best of 10 seeded fits each."""
    rows = M.elbow(_cluster_points(spark, sf_dir), range(2, 11), n_init=KMEANS_STARTS)
    return spark.createDataFrame(rows, "k int, sse double")


def _cluster_points(spark, sf_dir):
    """The points of the segmentations, written once.  The scan deals them by size over about as many tasks as there are
    cores, however many tasks the joins before had; each fit keeps its own vectors, so this frame is not to be cached
    (fits over cached rows decode every row in every iteration)."""
    return snapshot(_pca(spark, sf_dir).select("c_custkey", "pc1", "pc2"), "cluster-points").transform(
        lambda d: M.assemble(d, ["pc1", "pc2"]))


@register("cluster_compare")
def cluster_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: silhouette of k-means (k=4), bisecting k-means (k=4) and the grid
    density clusters."""
    pts = _cluster_points(spark, sf_dir)
    km = M.kmeans_best_of(pts, 4, n_init=KMEANS_STARTS).transform(pts)
    bk = M.bisecting(pts, 4)
    dn = M.grid_density_clusters(pts.drop("features"), "pc1", "pc2").where(F.col("cluster").isNotNull())  # noise is no cluster
    # each joined once and written: the evaluation reads its points many times
    dn = snapshot(dn.select("pc1", "pc2", "cluster"), "density-points")
    names = dn.select("cluster").distinct().withColumn("prediction", F.row_number().over(Window.orderBy("cluster")))
    dn = M.assemble(snapshot(dn.join(names, "cluster").select("pc1", "pc2", "prediction"), "density-named"), ["pc1", "pc2"])
    rows = []
    for name, pred in (("kmeans", km), ("bisecting_kmeans", bk), ("grid_density", dn)):
        n = pred.select("prediction").distinct().count()
        rows.append((name, int(n), float(M.silhouette(pred))))
    return spark.createDataFrame(rows, "model string, n_clusters int, silhouette double")


@register("bisecting_clusters")
def bisecting_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 (re-aimed Ward)."""
    return M.bisecting(_cluster_points(spark, sf_dir), 4).select(
        "c_custkey", F.col("prediction").alias("cluster"))


_DENSITY_SQL = f"""p AS (SELECT x, y, CAST(floor(x / {cell_side(0.5)!r}) AS BIGINT) AS cx, CAST(floor(y / {cell_side(0.5)!r}) AS BIGINT) AS cy,
  count(*) AS n FROM (SELECT l_quantity / 4.0 AS x, l_extendedprice / 5000.0 AS y FROM lineitem) GROUP BY ALL),
o AS (SELECT unnest(range(-2, 3)) AS d),
a AS (SELECT p.*, cx + o1.d AS nx, cy + o2.d AS ny FROM p, o o1, o o2),
core AS (SELECT a.x, a.y, a.cx, a.cy FROM a JOIN p b ON a.nx = b.cx AND a.ny = b.cy
  WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.25 GROUP BY ALL HAVING sum(b.n) >= 10),
links AS (SELECT DISTINCT a.cx AS fx, a.cy AS fy, b.cx AS tx, b.cy AS ty
  FROM (SELECT core.*, cx + o1.d AS nx, cy + o2.d AS ny FROM core, o o1, o o2) a JOIN core b ON a.nx = b.cx AND a.ny = b.cy
  WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.25),
walk(cx, cy, lx, ly) AS (SELECT DISTINCT cx, cy, cx, cy FROM core
  UNION SELECT l.tx, l.ty, w.lx, w.ly FROM walk w JOIN links l ON w.cx = l.fx AND w.cy = l.fy),
named AS (SELECT cx, cy, min({{'cx': lx, 'cy': ly}}) AS label FROM walk GROUP BY 1, 2),
inner_points AS (SELECT x, y, label FROM core JOIN named USING (cx, cy)),
outer_points AS (SELECT a.x, a.y, min(named.label) AS label FROM (SELECT * FROM a ANTI JOIN core USING (x, y)) a
  JOIN core b ON a.nx = b.cx AND a.ny = b.cy JOIN named ON named.cx = b.cx AND named.cy = b.cy
  WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.25 GROUP BY 1, 2),
placed AS (SELECT * FROM inner_points UNION ALL SELECT * FROM outer_points)"""


@register("density_clusters", f"WITH RECURSIVE {_DENSITY_SQL}" + """
SELECT l_orderkey, l_linenumber, label.cx || ':' || label.cy AS cluster
FROM lineitem LEFT JOIN placed ON l_quantity / 4.0 = x AND l_extendedprice / 5000.0 = y""")
def density_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 (eps .5, min 10, noise NULL) of all lines in the plane of quantity and price."""
    pts = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") / 4.0).alias("x"), (F.col("l_extendedprice") / 5000.0).alias("y"))
    return D.density_clusters(pts, "x", "y").select("l_orderkey", "l_linenumber", "cluster")


@register("density_segments")
def density_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 of all customers in the plane of their two principal components, the points of the other segmentations."""
    return M.grid_density_clusters(_pca(spark, sf_dir).select("c_custkey", "pc1", "pc2"), "pc1", "pc2").select("c_custkey", "cluster")


# ------------------------------------------------------------------ regression models

def line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    rf = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    ls = F.when(F.col("l_linestatus") == "F", 0).otherwise(1)
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                     rf.cast("double").alias("rf_idx"), ls.cast("double").alias("ls_idx"),
                     F.month("l_shipdate").cast("double").alias("ship_month"), "l_extendedprice",
                     (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_key"))


@register("demand_model")
def demand_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 + T9 + G36: boosted trees (500 x depth 4, rate .1) on a hash
    hold-out, test metrics."""
    lines = line_features(spark, sf_dir).withColumn("fold", M.hash_split("line_key", 42).cast("int"))  # 1: training rows
    model = B.boost_folds(lines, LINE_FEATURES, "l_extendedprice", "fold", [0], trees=BOOSTED_TREES)
    return M.regression_metrics(model.predict(lines.where("fold = 0"), 0), "l_extendedprice")


def staff_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = li.groupBy(F.to_date("l_shipdate").alias("day"), F.col("l_linestatus").alias("park"),
                   F.col("l_returnflag").alias("ride")).agg(
        F.sum("l_quantity").alias("carried"), F.count(F.lit(1)).cast("double").alias("n_lines"),
        F.avg("l_discount").alias("avg_discount"))
    a = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("attendance"))
    j = c.join(a, "day", "left").na.fill(0.0, subset=["attendance"])
    return j.select("*", F.when(F.col("park") == "F", 0.0).otherwise(1.0).alias("park_idx"),
                    F.when(F.col("ride") == "A", 0.0).when(F.col("ride") == "N", 1.0).otherwise(2.0)
                    .alias("ride_idx"), F.weekday("day").cast("double").alias("weekday"),
                    F.concat_ws("|", F.col("day").cast("string"), "park", "ride").alias("staff_key"))


@register("staff_model")
def staff_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 + M14 (+ S7): random forest (100 trees) on daily carried, saved
    and loaded back; the loaded model scores the hold-out, predictions rounded
    up to whole staff, with metrics."""
    from pyspark.ml import PipelineModel
    from turnstile.session import scratch_dir
    train, test = M.split_by_hash(staff_table(spark, sf_dir), "staff_key")
    path = scratch_dir(spark, "staff-model")
    M.forest_pipeline(STAFF_FEATURES, "carried", trees=FOREST_TREES).fit(train).write().overwrite().save(path)
    model = PipelineModel.load(path)
    pred = model.transform(test).withColumn("staff", F.ceil("prediction"))
    met = M.regression_metrics(pred, "carried")
    return met.withColumn("staff_total", F.lit(pred.agg(F.sum("staff")).first()[0]))


@register("cv_scores")
def cv_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 hash-assigned folds: R2 of the staffing forest over the training rows, and the negated mean squared
    error of the boosted demand trees of M11 over all rows, the five ensembles grown together."""
    staff, _ = M.split_by_hash(staff_table(spark, sf_dir), "staff_key")
    lines = line_features(spark, sf_dir)
    folds = lines.withColumn("fold", M.fold_of("line_key", 5))
    # the boosted trees are many short jobs one after another: the forests run beside them
    with ThreadPoolExecutor(max_workers=1) as beside:
        r2 = beside.submit(M.kfold_scores, staff, "staff_key", M.forest_pipeline(STAFF_FEATURES, "carried", trees=FOREST_TREES), "carried")
        boosted = B.boost_folds(folds, LINE_FEATURES, "l_extendedprice", "fold", range(5), trees=CV_TREES)
        rows = [("forest_r2", i, v) for i, v in r2.result()] + [("boosted_neg_mse", i, -v) for i, (_, v) in boosted.errors.items()]
    return spark.createDataFrame(rows, "score string, fold int, value double")


@register("model_metrics", """SELECT count(*) AS n,
  round(sqrt(avg(pow(l_extendedprice - 1000 * l_quantity, 2))), 6) AS rmse,
  round(avg(abs(l_extendedprice - 1000 * l_quantity)), 6) AS mae,
  round(avg(pow(l_extendedprice - 1000 * l_quantity, 2)), 2) AS mse,
  round(1 - sum(pow(l_extendedprice - 1000 * l_quantity, 2)) /
        sum(pow(l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem), 2)), 6) AS r2
FROM lineitem""")
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G36 on a fixed linear prediction (price = 1000 x quantity)."""
    li = table(spark, sf_dir, "lineitem").withColumn("prediction", F.col("l_quantity") * 1000.0)
    m = M.regression_metrics(li, "l_extendedprice")
    return m.select("n", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"),
                    F.round("mse", 2).alias("mse"), F.round("r2", 6).alias("r2"))


@register("feature_corr")
def feature_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15 + L5: correlation of each feature with the forest's predictions on
    the hold-out, sorted."""
    from turnstile.functions.scalars import safe_corr
    train, test = M.split_by_hash(staff_table(spark, sf_dir), "staff_key")
    pred = M.forest_pipeline(STAFF_FEATURES, "carried", trees=FOREST_TREES).fit(train).transform(test)
    wide = pred.agg(*[F.round(safe_corr(c, "prediction"), 6).alias(c) for c in STAFF_FEATURES])
    long = wide.unpivot([], STAFF_FEATURES, "feature", "corr")
    return long.withColumn("rnk", F.row_number().over(Window.orderBy(F.desc_nulls_last("corr"), "feature")).cast("long"))


@register("weather_regression")
def weather_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M23 (optional in the reference): reviews joined to the seasonal
    weather on season, forest on weather features, hold-out metrics."""
    from turnstile.plans.staffing import SEASONAL_WEATHER
    from turnstile.functions.scalars import QUARTER_SEASONS, season_of_month
    from turnstile.sources.tables import reviews
    w = spark.createDataFrame(SEASONAL_WEATHER, "season string, rainfall double, air_temperature double, "
                                                "relative_humidity double, wind_speed double")
    r = reviews(spark, sf_dir).withColumn("season", season_of_month(F.month("written_date"), QUARTER_SEASONS))
    j = r.join(F.broadcast(w), "season").withColumn("rating_d", F.col("rating").cast("double"))
    feats = ["rainfall", "air_temperature", "relative_humidity", "wind_speed"]
    train, test = M.split_by_hash(j, "review_id")
    model = M.forest_pipeline(feats, "rating_d", trees=20, depth=5).fit(train)
    return M.regression_metrics(model.transform(test), "rating_d")


# ------------------------------------------------------------------ review classifier

def labelled_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, tf, label``: the texts become counts before they meet their labels."""
    from turnstile.sources.tables import documents
    terms = M.hash_terms(documents(spark, sf_dir, "doc_id", "text")).select("doc_id", "tf")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))
    return terms.join(lab, "doc_id")


def _state(spark: SparkSession, sf_dir: str, *names: str) -> tuple:
    """Files, sizes and times behind some tables: changes with the data."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = [spark.sparkContext.applicationId]
    for name in names:
        for f in sorted(table(spark, sf_dir, name).inputFiles()):
            path = jvm.org.apache.hadoop.fs.Path(f)
            status = path.getFileSystem(conf).getFileStatus(path)
            out.append((f, status.getLen(), status.getModificationTime()))
    return tuple(out)


def complaint_classifier(spark: SparkSession, sf_dir: str):
    """T5: the last fitted model is reused by T6-T8 as long as its input files are the same."""
    key = _state(spark, sf_dir, "documents", "labels")
    if key not in _FITTED:
        train, _ = M.split_by_hash(labelled_terms(spark, sf_dir), "doc_id")
        # counted once: every fold and fit reads it; the scan deals it by size, so an iteration adds up few dense gradients
        train = snapshot(train, "labelled-terms")
        _FITTED.clear()
        _FITTED[key] = M.text_classifier().fit(train).bestModel
    return _FITTED[key]


@register("complaint_model")
def complaint_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 + T6 + T9 + G37: hold-out predictions with the negative-class
    probability and the hold-out flag."""
    model = complaint_classifier(spark, sf_dir)
    from turnstile.functions.scalars import hash_split
    s = M.score_terms(model, labelled_terms(spark, sf_dir).withColumn("is_train", hash_split("doc_id", 42)))
    return s.select("doc_id", "label", "prediction", F.round("p_negative", 6).alias("p_negative"), "is_train")


def _contributions(spark, sf_dir):
    model = complaint_classifier(spark, sf_dir)
    from turnstile.sources.tables import documents
    scored = M.score_texts(model, documents(spark, sf_dir, "doc_id", "text"))
    return M.word_contributions(model, scored)


@register("word_importance")
def word_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 + G34: mean leave-one-out contribution per word over documents
    scored negative, words seen at least 3 times, top 20."""
    c = _contributions(spark, sf_dir)
    g = c.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.avg("contribution").alias("mean_contribution"))
    top = g.where(F.col("n") >= 3).orderBy(F.desc("mean_contribution"), "word").limit(20)
    return top.withColumn("rnk", F.row_number().over(Window.orderBy(F.desc("mean_contribution"), "word")).cast("long"))


@register("review_explanations")
def review_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per negative-scored document: predicted class, confidence, and
    its 5 words with the largest positive contribution (ranked per
    document, so at most 5 per row)."""
    c = _contributions(spark, sf_dir).where(F.col("contribution") > 0)
    w = Window.partitionBy("doc_id").orderBy(F.desc("contribution"), "pos")
    top = c.withColumn("r", F.row_number().over(w)).where(F.col("r") <= 5)
    return top.groupBy("doc_id", "p_negative").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("r", "word"))), lambda x: x["word"]).alias("top_words")
    ).select("doc_id", F.lit(1).alias("predicted_class"), F.round("p_negative", 6).alias("confidence"), "top_words")
