"""MLlib-backed operators.

Everything trains through ``pyspark.ml`` on DataFrames; features are built
with expressions and ``VectorAssembler``.  Splits and folds come from key
hashes (stable under repartitioning), never ``randomSplit``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, RegressionEvaluator
from pyspark.ml.feature import IDF, PCA, HashingTF, RegexTokenizer, StopWordsRemover, VectorAssembler
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions.scalars import hash_split
from turnstile.operators.aggregates import scalar_row
from turnstile.session import snapshot


# ------------------------------------------------------------------ scaling / projection

def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """M1: (x - mean) / population std (as scikit-learn); zero std -> 0."""
    stats = scalar_row(df, *[F.avg(c).alias(f"m_{c}") for c in cols],
                       *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])
    out = df
    for c in cols:
        m, s = stats[f"m_{c}"], stats[f"s_{c}"]
        z = (F.col(c) - F.lit(m)) / F.lit(s) if s else F.lit(0.0)
        out = out.withColumn(c + suffix, z)
    return out


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def pca(df: DataFrame, features: str = "features", k: int = 2) -> DataFrame:
    """M2: principal components of (already centred) features."""
    model = PCA(k=k, inputCol=features, outputCol="_pca").fit(df)
    arr = vector_to_array("_pca")
    return model.transform(df).select("*", *[arr[i].alias(f"pc{i + 1}") for i in range(k)]).drop("_pca")


# ------------------------------------------------------------------ clustering

def _kmeans_fits(df: DataFrame, ks: Sequence[int], seed: int, n_init: int, features: str) -> dict[int, list]:
    """``n_init`` k-means fits for each k, seeds seed..seed+n-1."""
    from concurrent.futures import ThreadPoolExecutor

    def fit(start):
        k, i = start
        return KMeans(k=k, seed=seed + i, featuresCol=features).fit(df)

    # independent fits are submitted concurrently, also those of different k; each is a distributed job
    starts = [(k, i) for k in ks for i in range(n_init)]
    with ThreadPoolExecutor(max_workers=max(1, min(len(starts), 8))) as ex:
        models = list(ex.map(fit, starts))
    return {k: models[j * n_init:(j + 1) * n_init] for j, k in enumerate(ks)}


def _best(models: list):
    return min(models, key=lambda m: (m.summary.trainingCost, models.index(m)))


def kmeans_best_of(df: DataFrame, k: int, seed: int = 42, n_init: int = 10,
                   features: str = "features"):
    """M3: best of ``n_init`` k-means fits (lowest SSE), seeds seed..seed+n-1."""
    return _best(_kmeans_fits(df, [k], seed, n_init, features)[k])


def elbow(df: DataFrame, ks: Sequence[int], seed: int = 42, n_init: int = 10,
          features: str = "features") -> list[tuple[int, float]]:
    """M3: SSE for each k (every fit is a distributed MLlib job)."""
    fits = _kmeans_fits(df, ks, seed, n_init, features)
    return [(k, float(_best(fits[k]).summary.trainingCost)) for k in ks]


def silhouette(pred: DataFrame, prediction: str = "prediction", features: str = "features") -> float:
    """M4: MLlib silhouette (squared Euclidean; linear-time formulation); 0 with fewer than two clusters."""
    if pred.select(prediction).distinct().limit(2).count() < 2:
        return 0.0
    return ClusteringEvaluator(predictionCol=prediction, featuresCol=features,
                               distanceMeasure="squaredEuclidean").evaluate(pred)


def bisecting(df: DataFrame, k: int = 4, seed: int = 42, features: str = "features") -> DataFrame:
    """M5 (re-aimed Ward): divisive k-means."""
    return BisectingKMeans(k=k, seed=seed, featuresCol=features).fit(df).transform(df)


def _around(cells: DataFrame, *cols: str) -> DataFrame:
    """``cols`` of every cell at each of the 9 cells around it (``cx``, ``cy``), itself (``own``) included."""
    around = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    e = cells.withColumn("_o", F.explode(around))
    return e.select((F.col("cx") + F.col("_o.dx")).alias("cx"), (F.col("cy") + F.col("_o.dy")).alias("cy"),
                    ((F.col("_o.dx") == 0) & (F.col("_o.dy") == 0)).alias("own"), *cols)


def _nearest_labels(labels: DataFrame) -> DataFrame:
    """Every cell next to a labelled one: the smallest ``label`` around it and its own one before (``old``, else NULL)."""
    return _around(labels, "label").groupBy("cx", "cy").agg(
        F.min("label").alias("label"), F.max(F.when(F.col("own"), F.col("label"))).alias("old"))


def grid_density_clusters(df: DataFrame, x: str, y: str, eps: float = 0.5, min_pts: int = 10,
                          checkpoint_every: int = 4) -> DataFrame:
    """M6 (re-aimed DBSCAN): points are binned into square cells of side
    ``eps``; an occupied cell whose 9-cell neighbourhood holds at least
    ``min_pts`` points is a core cell; core cells that touch (8-neighbourhood)
    form one cluster, named by its smallest cell (``cx:cy``); points of
    other cells next to a core cell join the smallest adjacent cluster; the rest
    are noise (NULL).  Works on the table of occupied cells, never on pairs
    of points; labels spread until none changes.  Cells send what they hold to
    the cells around them and are summed there, so only the points are joined."""
    pts = df.withColumn("cx", F.floor(F.col(x) / eps)).withColumn("cy", F.floor(F.col(y) / eps))
    cells = pts.where("cx IS NOT NULL AND cy IS NOT NULL").groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"))
    near = _around(cells, "n").groupBy("cx", "cy").agg(F.sum("n").alias("n9"), F.max("own").alias("occupied"))
    core = near.where(F.col("occupied") & (F.col("n9") >= min_pts)).select("cx", "cy")
    labels = core.withColumn("label", F.struct("cx", "cy")).checkpoint()
    while True:
        for _ in range(checkpoint_every):
            spread = _nearest_labels(labels).where(F.col("old").isNotNull())  # core cells only
            labels = spread.select("cx", "cy", "label")
        spread = spread.checkpoint()
        labels = spread.select("cx", "cy", "label")
        if spread.where(F.col("label") != F.col("old")).isEmpty():
            break
    placed = _nearest_labels(labels).select("cx", "cy", F.coalesce("old", "label").alias("_c"))
    out = pts.join(placed, ["cx", "cy"], "left")
    c = F.col("_c")
    name = F.when(c.isNotNull(), F.concat_ws(":", c["cx"].cast("string"), c["cy"].cast("string")))
    return out.withColumn("cluster", name).drop("_c", "cx", "cy")


# ------------------------------------------------------------------ regression

def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE, MSE and R2 in one aggregate."""
    d = F.col(label) - F.col(prediction)
    p = pred.select(label, prediction)
    g = p.agg(F.count(F.lit(1)).alias("n"), F.avg(d * d).alias("mse"), F.avg(F.abs(d)).alias("mae"),
              F.sum(d * d).alias("sse"), F.avg(label).alias("ybar"),
              F.sum(F.col(label) * F.col(label)).alias("syy"))
    sst = F.col("syy") - F.col("n") * F.col("ybar") * F.col("ybar")
    return g.select("n", F.sqrt("mse").alias("rmse"), "mae", "mse",
                    (F.lit(1.0) - F.try_divide(F.col("sse"), sst)).alias("r2"))


def split_by_hash(df: DataFrame, key: str, seed: int = 42, train_pct: int = 80):
    """Stable hold-out split."""
    flag = hash_split(key, seed, train_pct)
    return df.where(flag), df.where(~flag)


def forest_pipeline(features: Sequence[str], label: str, trees: int = 100, depth: int = 10,
                    seed: int = 42) -> Pipeline:
    """Random forest regression."""
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"),
                            RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees,
                                                  maxDepth=depth, seed=seed)])


def fold_of(key: str, folds: int, seed: int = 42):
    """Fold of a row, stable under recomputation."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(folds))


def kfold_scores(df: DataFrame, key: str, pipeline: Pipeline, label: str, folds: int = 5,
                 metric: str = "r2", seed: int = 42) -> list[tuple[int, float]]:
    """Per-fold scores with hash-assigned folds."""
    from concurrent.futures import ThreadPoolExecutor

    f = df.withColumn("_fold", fold_of(key, folds, seed)).cache()
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)

    def score(i):
        m = pipeline.fit(f.where(F.col("_fold") != i))
        return i, float(ev.evaluate(m.transform(f.where(F.col("_fold") == i))))

    with ThreadPoolExecutor(max_workers=folds) as ex:
        out = list(ex.map(score, range(folds)))
    f.unpersist()
    return out


# ------------------------------------------------------------------ text classifier

TOKEN_PATTERN = r"(?U)\w\w+"
TERM_SLOTS = 1 << 18


def _term_stages(features: int) -> list:
    return [RegexTokenizer(inputCol="text", outputCol="tokens", pattern=TOKEN_PATTERN, gaps=False, toLowercase=True),
            StopWordsRemover(inputCol="tokens", outputCol="words"),
            HashingTF(inputCol="words", outputCol="tf", numFeatures=features)]


def hash_terms(df: DataFrame, features: int = TERM_SLOTS) -> DataFrame:
    """Column ``tf``: hashed term counts of ``text``.  Nothing is fitted, so this runs beside the scan and a join
    that follows moves counts, not texts.  Every term counts: there is no vocabulary to cut."""
    return PipelineModel(_term_stages(features)).transform(df).drop("tokens", "words")


def text_classifier(reg_params: Sequence[float] = (0.01, 0.1), folds: int = 3, seed: int = 42) -> CrossValidator:
    """T5 (re-aimed BERT): hashed counts ``tf`` -> idf -> logistic regression on ``label``,
    regularisation chosen by cross-validation on area under ROC."""
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=50)
    pipe = Pipeline(stages=[IDF(inputCol="tf", outputCol="features"), lr])
    grid = ParamGridBuilder().addGrid(lr.regParam, list(reg_params)).build()
    # the folds x grid fits are independent jobs: evaluate them concurrently
    return CrossValidator(estimator=pipe, estimatorParamMaps=grid, numFolds=folds, seed=seed,
                          evaluator=BinaryClassificationEvaluator(labelCol="label"), parallelism=4)


def score_terms(model: PipelineModel, df: DataFrame) -> DataFrame:
    """T6 on hashed counts: class, probability and log odds of the positive (negative-review) class."""
    s = model.transform(df)
    return s.withColumn("p_negative", vector_to_array("probability")[1]).withColumn(
        "logit", vector_to_array("rawPrediction")[1]).drop("tf", "features", "rawPrediction", "probability")


def score_texts(model: PipelineModel, df: DataFrame) -> DataFrame:
    """T6 on texts."""
    return score_terms(model, hash_terms(df))


def term_weights(model: PipelineModel, words: DataFrame) -> DataFrame:
    """``word`` -> ``word, w``: the log odds that one occurrence adds, i.e. those of the one-word text without
    the intercept (0 for stop words).  One row per distinct word, scored by the model itself."""
    one = words.withColumn("tokens", F.array("word"))
    for stage in [*_term_stages(TERM_SLOTS)[1:], *model.stages]:
        one = stage.transform(one)
    return one.select("word", (vector_to_array("rawPrediction")[1] - F.lit(float(model.stages[-1].intercept))).alias("w"))


def word_contributions(model: PipelineModel, scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Leave-one-word-out importance, exact for this linear model:
    removing one occurrence of term t lowers the logit by w_t, so
    contribution = p - sigmoid(logit - w_t).  Stop words contribute 0.  Only
    documents with p > threshold."""
    pos = scored.where(F.col("p_negative") > threshold).select("doc_id", "p_negative", "logit", "text")
    pos = snapshot(pos, "negative-texts")  # scored once: the words and their weights both come from it
    toks = pos.select("doc_id", "p_negative", "logit", F.posexplode(
        F.regexp_extract_all(F.lower(F.col("text")), F.lit(TOKEN_PATTERN), 0)).alias("pos", "word"))
    weights = term_weights(model, toks.select("word").distinct())
    j = toks.join(weights, "word")
    # the sigmoid without overflow, from the log odds (p itself may round to 1)
    p_without = 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("logit") - F.col("w")))))
    return j.select("doc_id", "p_negative", "pos", "word",
                    (F.col("p_negative") - p_without).alias("contribution"))
