"""Scalar and text expressions, statistics."""

import math

import pytest
from pyspark.sql import functions as F


from turnstile.functions import scalars as S
from turnstile.functions import text as X
from turnstile.operators import aggregates as A
from turnstile.operators import stattests as ST


def test_severity_rules(spark):
    cases = [(5.0, 0.9, 0), (4.0, 0.9, 1), (2.0, 0.85, 3), (3.0, 0.7, 2), (3.0, 0.5, 1),
             (None, 0.9, 0), (2.0, None, 1), (7.0, 0.9, 0), (2.0, 1.5, 0)]
    df = spark.createDataFrame([(r, p) for r, p, _ in cases], "r double, p double")
    got = [row.s for row in df.select(S.complaint_severity("r", "p").alias("s")).collect()]
    assert got == [c[2] for c in cases]


def test_actions_and_labels(spark):
    df = spark.createDataFrame([(0, "X-east", 0.9), (1, "X-east", 0.9), (3, "Y", 0.5)],
                               "s int, b string, p double")
    got = [r.a for r in df.select(S.recommended_action("s", "b", "p", "X").alias("a")).collect()]
    assert got[0] == S.NO_ACTION
    assert got[1].startswith(S.SEVERITY_ACTIONS[1]) and got[1].endswith(S.FOCUS_MARKED_HIGH)
    assert got[2].endswith(S.FOCUS_OTHER_LOW)


def test_count_occurrences_non_overlapping(spark):
    df = spark.createDataFrame([("aaaa banana",)], "t string")
    r = df.select(S.count_occurrences("t", "aa").alias("a"), S.count_occurrences("t", "ana").alias("b")).first()
    assert (r.a, r.b) == (2, 1)


def test_keyword_segment_ties_and_vip(spark):
    df = spark.createDataFrame([("plain text",), ("Friends party VIP",), ("kids family cheap",),
                                ("friends express pass no wait",)], "t string")
    got = [r.s for r in df.select(X.keyword_segment("t").alias("s")).collect()]
    assert got == [1, 2, 1, 0]   # tie -> family/budget; lowered text never matches "VIP"


def test_rain_flag_is_substring_and_null_false(spark):
    df = spark.createDataFrame([("a train ride",), (None,), ("sunny",)], "t string")
    got = [r.f for r in df.select(S.keyword_flag("t", X.RAIN_WORDS).alias("f")).collect()]
    assert got == [True, False, False]


def test_lexicon_polarity(spark):
    df = spark.createDataFrame([("Great, GREAT and stupid!",), ("nothing here",), (None,)], "t string")
    got = [r.p for r in df.select(X.lexicon_polarity("t").alias("p")).collect()]
    assert abs(got[0] - (0.8 + 0.8 - 0.8) / 3) < 1e-12
    assert got[1] == 0.0 and got[2] == 0.0


def test_safe_corr_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, None)], "a double, b double")
    assert df.agg(S.safe_corr("a", "b").alias("c")).first().c is None


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(-1.0,), (0.95,), (1.0,), (0.0,)], "x double")
    got = {r.bin: r["count"] for r in A.histogram(df, "x", -1.0, 1.0, 0.1).collect()}
    assert got[0] == 1 and got[19] == 2 and got[10] == 1


def test_mode_ties_to_lowest(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", "a")], "k string, v string")
    assert df.groupBy("k").agg(A.mode_of("v").alias("m")).first().m == "a"


def test_wilcoxon_with_ties(spark):
    vals = [1.0, -2.0, 2.0, 3.0, 0.0, -1.0, 4.0]
    df = spark.createDataFrame([(i, "m", v) for i, v in enumerate(vals)], "k long, metric string, value double")
    r = ST.wilcoxon(df).first()
    # |x| without zero: 1,2,2,3,1,4 -> ranks 1.5,3.5,3.5,5,1.5,6
    assert r.n == 6 and abs(r.w_plus - 16.0) < 1e-12 and abs(r.w_minus - 5.0) < 1e-12


def test_t_pvalue_known_values():
    assert abs(ST.t_two_sided_p(2.0, 10) - 0.07339) < 1e-5
    assert abs(ST.t_two_sided_p(1.0, 1) - 0.5) < 1e-9


def test_parse_mixed_dates(spark):
    df = spark.createDataFrame([("2019-7",), ("Jan 05, 2020",), ("junk",), (None,)], "s string")
    got = [r.d for r in df.select(S.parse_year_month_or_date("s", ["MMM dd, yyyy"]).alias("d")).collect()]
    assert [str(x) if x else None for x in got] == ["2019-07-01", "2020-01-05", None, None]


def test_weighted_choice_is_deterministic(spark):
    df = spark.range(0, 2000)
    c = S.weighted_choice("id", ["a", "b"], [0.7, 0.3], 42)
    one = {r.id: r.c for r in df.select("id", c.alias("c")).collect()}
    two = {r.id: r.c for r in df.repartition(7).select("id", c.alias("c")).collect()}
    assert one == two
    share = sum(v == "a" for v in one.values()) / len(one)
    assert 0.65 < share < 0.75
    assert math.isclose(sum(1 for _ in one), 2000)


@pytest.mark.parametrize("buckets", [1, 3, 1024])
def test_group_quantiles_exact_for_any_bucket_count(spark, buckets):
    import numpy as np
    rng = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in rng.integers(0, 300, 5000)]          # many duplicates
    rows += [("one", 4.0), ("two", 1.0), ("two", 3.0), ("two", None), ("same", 2.0), ("same", 2.0)]
    rows += [(None, float(v)) for v in rng.normal(size=700)]
    rows += [("tail", float(2.0 ** v)) for v in range(60)]
    df = spark.createDataFrame(rows, "g string, x double")
    qs, names = [0.0, 0.25, 0.3, 0.5, 0.75, 1.0], ["z", "a", "b", "c", "d", "e"]
    got = {r.g: tuple(r[n] for n in names) for r in A.group_quantiles(df, ["g"], "x", qs, names, buckets=buckets).collect()}
    assert got.keys() == {k for k, _ in rows}
    for g, have in got.items():
        vals = np.array([x for k, x in rows if k == g and x is not None])
        assert np.allclose(have, [np.quantile(vals, q) for q in qs], rtol=1e-12, atol=1e-9), g


def _image(x):
    import struct
    k = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -k if x < 0 else k


def test_ordered_image_is_the_bit_pattern(spark):
    import random
    import struct
    rng = random.Random(8)
    vals = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1023, 1.7976931348623157e308, -1.7976931348623157e308,
            float("inf"), float("-inf")]
    for e in range(-1060, 1024, 7):  # both sides of every power looked at
        vals += [2.0 ** e, math.nextafter(2.0 ** e, 0), math.nextafter(2.0 ** e, math.inf)]
    while len(vals) < 6000:
        x = struct.unpack("<d", struct.pack("<q", rng.getrandbits(63) - rng.choice((0, 1 << 63))))[0]
        vals += [x] if math.isfinite(x) else []
    df = spark.createDataFrame([(v,) for v in vals] + [(float("nan"),), (None,)], "x double")
    got = A.with_ordered_image(df, "x", "k").collect()
    for r in got:
        if r.x is None:
            assert r.k is None
        elif math.isnan(r.x):
            assert r.k > _image(float("inf"))
        else:
            assert r.k == _image(r.x), r.x


@pytest.mark.parametrize("buckets", [1, 1 << 16])
def test_quantiles_over_thirty_powers_of_ten_order_one_digit_at_most(spark, buckets):
    import numpy as np
    rng = np.random.default_rng(6)
    vals = [float(v) for v in 10.0 ** rng.uniform(-15, 15, 20000)] + [1e20, 1e30, -1e30, 0.0, -1e-300]
    df = spark.createDataFrame([("g", v) for v in vals], "g string, x double")
    qs, names = [0.0, 0.1, 0.5, 0.9, 0.999, 1.0], list("abcdef")
    counts = A.value_counts_by(df, ["g"], "x")
    got = A.quantiles_of_counts(counts, qs, names, buckets).first()
    assert np.allclose([got[n] for n in names], [np.quantile(vals, q) for q in qs], rtol=1e-12)
    # whatever the spread, values that share all digits but the last are the only ones ordered in the last step
    last = counts.groupBy(F.shiftright("_k", 16).alias("p")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    assert last <= 1 << 16 and last < 20


def test_box_summary_reads_its_rows_once(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(50)] + [("a", 900.0), (None, 1.0), ("b", 2.0), ("b", None)], "g string, x double")
    rows = {r.g: r for r in A.box_summary(df, "g", "x").collect()}
    assert set(rows) == {"a", "b"} and rows["a"].n == 51 and rows["a"].n_outliers == 1 and rows["a"].whisker_hi == 49.0
    assert rows["b"].n == 1 and rows["b"].n_outliers == 0 and rows["b"].median == 2.0
    plan = A.box_summary(df, "g", "x")._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan and "LocalTableScan" not in plan  # only the stored counts


def test_parse_python_literal_records_with_apostrophe(spark):
    from turnstile.plans.staffing import parse_records
    text = ("[{'Attraction': \"Mel's Diner\", 'Queue_Time': np.float64(12.5), 'k': 3}, "
            "{'Attraction': 'Coaster', 'Queue_Time': np.float64(0.0), 'k': 4}]")
    df = spark.createDataFrame([(text,), ("[]",)], "t string")
    rows = df.select(parse_records("t").alias("r")).collect()
    assert [(x.Attraction, x.Queue_Time, x.k) for x in rows[0].r] == [("Mel's Diner", 12.5, 3), ("Coaster", 0.0, 4)]
    assert rows[1].r == []


def test_signed_rank_p_equals_enumeration():
    import itertools
    for n in (1, 4, 9):
        sums = [sum(r for r, s in zip(range(1, n + 1), signs) if s) for signs in itertools.product((0, 1), repeat=n)]
        for w in range(n * (n + 1) // 4 + 1):
            want = min(1.0, 2 * sum(x <= w for x in sums) / len(sums))
            assert abs(ST.signed_rank_p(w, n) - want) < 1e-12
