import random

import pytest
from pyspark.sql import functions as F

from turnstile.llm.queries import QUERIES
from turnstile.llm.simhash import drop_near_duplicates, similar_fingerprints, simhash_groups, text_fingerprint

from .brute import components, fingerprint

SF = "/root/testdata/sf0.001"


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {d: fingerprint(t) for d, t in docs.items()}
    root = components(fps.values())
    least = {}
    for d, f in fps.items():
        least[root[f]] = min(d, least.get(root[f], d))
    rows = QUERIES["op1_simhash_near_dedup"](spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {
        (d, f"{f:016x}", least[root[f]]) for d, f in fps.items()}


@pytest.mark.parametrize("max_bits,blocks,cap", [(2, 3, 64), (2, 3, 3), (2, 4, 3), (1, 3, 2), (1, 2, 100), (0, 3, 2)])
def test_crowded_buckets_lose_no_link(spark, max_bits, blocks, cap):
    rng = random.Random(max_bits * 100 + blocks * 10 + cap)
    fps = set()
    for _ in range(6):  # families that share most bits
        f = rng.getrandbits(64)
        for _ in range(25):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 3))))
            fps.add(f)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    links = [(r.u % (1 << 64), r.v % (1 << 64)) for r in similar_fingerprints(df, max_bits, blocks, cap).collect()]
    want = components(fps, max_bits)
    near = {f: f for f in fps}

    def find(x):
        while near[x] != x:
            x = near[x]
        return x
    for a, b in links:
        near[max(find(a), find(b))] = min(find(a), find(b))
    groups = lambda of: {frozenset(f for f in fps if of(f) == r) for r in {of(f) for f in fps}}
    assert groups(find) == groups(want.__getitem__)


def test_edges(spark):
    long = "w" * 200_000 + " x" * 40_000
    rows = [(5, "a b c d"), (3, "a b c d"), (None, "a b c d"), (7, None), (8, ""), (9, "\t\n "), (2, "one two"), (2, "one two"),
            (None, "lonely words of nobody at all here"), (11, long)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit("x")).withColumn("id", F.lit(1)).withColumn(
        "component_id", F.lit(2)).withColumn("text_hash", F.lit(None))
    got = sorted((repr((r.id, r.fp, r.component_id)) for r in simhash_groups(df).collect()))
    f = text_fingerprint
    want = [(5, f("a b c d"), 3), (3, f("a b c d"), 3), (None, f("a b c d"), 3), (7, 0, 7), (8, 0, 7), (9, 0, 7), (2, f("one two"), 2),
            (2, f("one two"), 2), (None, f(rows[8][1]), None), (11, f(long), 11)]
    assert got == sorted(map(repr, want))
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 2, 3, 7, 11]
    assert simhash_groups(df.limit(0)).count() == 0
    assert drop_near_duplicates(df.limit(0)).count() == 0
