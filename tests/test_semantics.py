"""Rules that the oracle's data do not reach: context of valences, wait answers, noise, caches, plans, bounds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from turnstile.functions import text as X
from turnstile.operators import journey as J
from turnstile.operators import models as M
from turnstile.plans import basics, campaign
from turnstile.plans import models as PM
from turnstile.session import drop_snapshots, ensure_checkpoint_dir, scratch_dir, snapshot
from turnstile.sources import files as IO

from .conftest import SF_SMALL


def valence(spark, text):
    return X.with_valence(spark.createDataFrame([(1, text)], "id int, text string"), "text").first()


def test_neutral_words_count(spark):
    r = valence(spark, "good " + "word " * 999)
    assert abs(r.pos - 2.9 / (2.9 + 999)) < 1e-9 and r.neg == 0


def test_negation_and_boosters(spark):
    good, bad = valence(spark, "good"), valence(spark, "not good")
    assert good.compound > 0 > bad.compound
    assert abs(bad.compound - (1.9 * -0.74) / ((1.9 * 0.74) ** 2 + 15) ** 0.5) < 1e-9
    assert bad.neg > 0 and bad.pos == 0
    assert valence(spark, "very good").compound > good.compound > valence(spark, "slightly good").compound
    assert valence(spark, "very stupid").compound < valence(spark, "stupid").compound
    assert valence(spark, "not one two three good").compound == good.compound
    assert valence(spark, None).compound == 0 and valence(spark, "").pos == 0


def test_wait_answers():
    assert basics.WAIT_MIDPOINTS["More than 90 minutes"] == 100 and basics.WAIT_MIDPOINTS["Less than 15 minutes"] == 10


def test_noise_is_no_cluster(spark):
    # two dense squares, nine points each in two touching cells, far strays
    pts = [(0.1, 0.1)] * 9 + [(0.6, 0.1)] * 9 + [(20.1, 0.1)] * 12 + [(40.0, 40.0), (-40.0, 3.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id int, x double, y double")
    got = {r.id: r.cluster for r in M.grid_density_clusters(df, "x", "y").collect()}
    assert {got[i] for i in range(18)} == {"0:0"} and {got[i] for i in range(18, 30)} == {"40:0"}
    assert got[30] is None and got[31] is None
    chain = spark.createDataFrame([(k * 10 + i, k * 0.5 + 0.1, 0.1) for k in range(60) for i in range(10)], "id int, x double, y double")
    assert {r.cluster for r in M.grid_density_clusters(chain, "x", "y").collect()} == {"0:0"}
    one = M.assemble(df.withColumn("prediction", F.lit(0)), ["x", "y"])
    assert M.silhouette(one) == 0.0


def test_contribution_at_probability_one(spark):
    model = PM.complaint_classifier(spark, SF_SMALL)
    scored = spark.createDataFrame([(1, "idiot trash worthless", 1.0, 800.0)], "doc_id int, text string, p_negative double, logit double")
    rows = M.word_contributions(model, scored).collect()
    assert len(rows) == 3 and all(0 <= abs(r.contribution) <= 1 for r in rows)


def test_shuffled_interval_join_plan(spark):
    plan = campaign.interval_join_bucketed(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_half_written_cache_is_written_again(spark):
    path = scratch_dir(spark, "half")
    df = spark.range(3)
    df.write.parquet(path)
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    done.getFileSystem(spark._jsc.hadoopConfiguration()).delete(done, False)
    assert IO.cached_source(spark, path, lambda: spark.range(5)).count() == 5
    assert IO.cached_source(spark, path, lambda: spark.range(9)).count() == 5


def test_unquoted_csv(spark):
    path = scratch_dir(spark, "unquoted")
    spark.createDataFrame([('1,a "b"\\, c',), ("2,short,long",), ("x,y",)], "value string").write.text(path)
    got = sorted((r.k, r.t) for r in IO.read_unquoted_csv(spark, path, [("k", "int"), ("t", "string")]).where("k IS NOT NULL").collect())
    assert got == [(1, 'a "b", c')]


def test_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_snapshots_are_dropped(spark):
    drop_snapshots(spark)
    df = snapshot(spark.range(4), "few")
    assert df.count() == 4 and drop_snapshots(spark) == 1 and drop_snapshots(spark) == 0


def test_unsettled_chain_raises(spark):
    probs = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1e-12)], "from_ride string, to_ride string, p double")
    with pytest.raises(RuntimeError):
        J.steady_state(probs, ["a", "b"], tol=0.0, max_doublings=4)


def test_visit_entropy(spark):
    df = spark.createDataFrame([(["a", "a", "b", None],), ([None],), (["a"],)], "s array<string>")
    got = [r.e for r in df.select(J.array_entropy("s").alias("e")).collect()]
    assert abs(got[0] - 0.636514168) < 1e-6 and got[1:] == [0.0, 0.0]


def test_changed_day_types(spark):
    cal = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 4)], "day date")
    att = spark.createDataFrame([], "day date, facility string, attendance double")
    assert {r.day_type for r in J.day_types(cal, att, None, "f").collect()} == {"normal"}
