"""Shapiro-Wilk against published samples and critical values."""

import math
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from turnstile.operators import stattests as ST

WEIGHTS_OF_MEN = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]  # the example of the method's first paper


def gate(spark, **samples):
    rows = [(m, i, float(v)) for m, values in samples.items() for i, v in enumerate(values)]
    return {r.metric: r for r in ST.normality_gate(spark.createDataFrame(rows, "metric string, key int, value double")).collect()}


def test_published_sample(spark):
    got = gate(spark, men=WEIGHTS_OF_MEN, moved=[3.0 * v - 7 for v in WEIGHTS_OF_MEN])
    assert got["men"].statistic == pytest.approx(0.78881, abs=5e-5)
    assert got["men"].p_normal == pytest.approx(0.006704, abs=5e-5)
    assert got["moved"].statistic == pytest.approx(got["men"].statistic, abs=1e-12)
    assert {r.gate for r in got.values()} == {"shapiro-wilk"}


def test_published_critical_value_for_sixteen(spark):
    """W = 0.887 is the 5 % point of 16 values, 0.844 the 1 % point, in three digits from simulation: p agrees to
    0.002 (0.0111 at the 1 % point)."""
    n = 16
    for w, alpha in ((0.887, 0.05), (0.844, 0.01)):
        x = math.log(n)
        mean = sum(c * x ** i for i, c in enumerate(ST.LARGE_MEAN))
        sd = math.exp(sum(c * x ** i for i, c in enumerate(ST.LARGE_LOG_SD)))
        assert 1 - NormalDist().cdf((math.log(1 - w) - mean) / sd) == pytest.approx(alpha, abs=0.002)
    # and samples on either side of the 5 % point fall on the right side
    rng = random.Random(3)
    got = gate(spark, **{f"s{k}": [rng.gauss(0, 1) ** (3 if k % 2 else 1) for _ in range(n)] for k in range(40)})
    for r in got.values():
        if abs(r.statistic - 0.887) > 0.004:
            assert (r.p_normal < 0.05) == (r.statistic < 0.887)
    assert {r.p_normal < 0.05 for r in got.values()} == {True, False}


def test_normal_quantile(spark):
    ps = [1e-9, 1e-4, 0.02, 0.02425, 0.1, 0.4999, 0.5, 0.6, 0.98, 1 - 1e-6]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select("p", ST.normal_quantile(F.col("p")).alias("z")).collect()
    for r in got:
        assert r.z == pytest.approx(NormalDist().inv_cdf(r.p), rel=2e-9, abs=1e-9)


def test_sizes_and_degenerate_samples(spark):
    rng = random.Random(8)
    got = gate(spark, two=[1, 2], flat=[4] * 9, three=[0, 1, 2], bent=[0, 0, 1], five=[1, 2, 3, 4, 9],
               many=[rng.gauss(5, 2) for _ in range(5001)])
    assert got["two"].gate == got["flat"].gate == "none" and got["flat"].p_normal is None
    assert got["three"].statistic == pytest.approx(1.0) and got["three"].p_normal == pytest.approx(1.0)
    assert got["bent"].statistic == pytest.approx(0.75) and got["bent"].p_normal == pytest.approx(0.0, abs=1e-7)
    assert got["five"].gate == "shapiro-wilk" and 0 < got["five"].p_normal < 1
    assert got["many"].gate == "jarque-bera" and got["many"].p_normal > 0.001
