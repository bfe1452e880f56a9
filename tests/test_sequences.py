"""Similar sequences against the standard matcher over all pairs."""

import random
from difflib import SequenceMatcher
from itertools import combinations

import pytest

from turnstile.operators import sequences as S
from turnstile.plans import journey

from .conftest import SF_SMALL


def brute(classes, threshold=0.8):
    out = {}
    for a, b in combinations(sorted(classes, key=lambda r: tuple(r["class"])), 2):
        if a.group == b.group:
            ratio = SequenceMatcher(None, a.seq, b.seq).ratio()
            if ratio >= threshold:
                out[a.group, tuple(a["class"]), tuple(b["class"])] = ratio
    return out


def test_registered_query_finds_like_visits(spark):
    classes = journey._visit_classes(spark, SF_SMALL).collect()
    want = brute(classes)
    got = {(r.express, (r.a_visitor, r.a_session_id), (r.b_visitor, r.b_session_id)): r.ratio
           for r in journey.sequence_similarity_lsh(spark, SF_SMALL).collect()}
    assert set(got) <= set(want) and len(want) > 10
    assert all(got[k] == pytest.approx(want[k], abs=1e-6) for k in got)
    assert len(got) >= 0.9 * len(want), f"recall {len(got) / len(want):.4f}"
    assert sum(r.n for r in classes) == journey.visit_sequences(spark, SF_SMALL).count()


def test_recall_and_ratios_on_long_sequences(spark):
    rng = random.Random(4)
    rides = [f"ride {i}" for i in range(12)] + [None]
    rows = []
    for family in range(25):
        base = [rng.choice(rides) for _ in range(rng.randrange(10, 260))]
        for _ in range(4):
            seq = base[:]
            for _ in range(rng.randrange(0, max(2, len(seq) // 6))):
                at = rng.randrange(len(seq))
                seq[at:at + 1] = [[], [rng.choice(rides)], [rng.choice(rides), seq[at]]][rng.randrange(3)]
            rows.append((len(rows), family % 2 == 0, seq))
    rows += [(1000 + i, r[1], r[2]) for i, r in enumerate(rows[:20])]  # repeated sequences join their class
    rows += [(2000, None, ["ride 1"]), (2001, True, []), (2002, True, None)]
    df = spark.createDataFrame(rows, "visit int, express boolean, seq array<string>")
    classes = S.sequence_classes(df, "express", "seq", ["visit"])
    assert sum(r.n for r in classes.collect()) == len(rows) - 2
    want = brute(classes.collect())
    got = {(r.group, tuple(r.a), tuple(r.b)): r.ratio for r in S.similar_sequences(classes).collect()}
    assert set(got) <= set(want) and len(got) >= 0.98 * len(want) > 20
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in got)
    assert S.similar_sequences(classes.limit(0)).count() == 0


def test_short_sequences_of_few_rides_meet_on_their_order(spark):
    """Multisets of few rides are nearly all alike: candidates have to have the common subsequence that the ratio asks for."""
    rng = random.Random(7)
    seqs = {tuple(rng.choice("abcd" if i % 9 else ["a", None]) for _ in range(rng.randrange(1, 13))) for i in range(700)}
    df = spark.createDataFrame([(i, i % 2 == 0 if i % 5 else None, list(s)) for i, s in enumerate(sorted(seqs, key=str))],
                               "visit int, express boolean, seq array<string>")
    classes = S.sequence_classes(df, "express", "seq", ["visit"])
    rows = sorted(classes.collect(), key=lambda r: r["class"].visit)
    allowed = {(tuple(a["class"]), tuple(b["class"])) for a, b in combinations(rows, 2) if a.group == b.group
               and 2 * S.common_length(a.seq, b.seq) / (len(a.seq) + len(b.seq)) >= 0.8}
    assert {(tuple(r.a), tuple(r.b)) for r in S.short_pairs(classes, 0.8, 12).collect()} == allowed
    got = {(r.group, tuple(r.a), tuple(r.b)): r.ratio for r in S.similar_sequences(classes).collect()}
    assert got == pytest.approx(brute(rows)) and len(got) > 100


def test_long_sequences_of_few_rides_meet_on_their_prefix(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(12):
        base = [rng.choice(["a", "b", "c", "d", None]) for _ in range(rng.randrange(180, 420))]
        rows += [(len(rows), True, base)]
        rows += [(len(rows) + i, True, base[:len(base) * k // 100] + [rng.choice("abcd") for _ in range(extra)])
                 for i, (k, extra) in enumerate([(70, 0), (90, 15), (85, 60), (99, 200), (60, 90)])]
    df = spark.createDataFrame(rows, "visit int, express boolean, seq array<string>")
    classes = S.sequence_classes(df, "express", "seq", ["visit"])
    want = brute(classes.collect())
    got = {(r.group, tuple(r.a), tuple(r.b)): r.ratio for r in S.similar_sequences(classes).collect()}
    assert got == pytest.approx(want) and len(got) > 20
    flagged = classes.withColumn("prefix", S._prefix_only("seq"))
    assert flagged.where("prefix and size(seq) < 200").isEmpty() and flagged.where("prefix").count() > 40
    met = S.prefix_pairs(flagged, 0.8, 12).distinct().count()
    assert met <= 12 * 15  # pairs of one base only


def test_common_length():
    rng = random.Random(9)
    for _ in range(60):
        a, b = ([rng.choice("abc") for _ in range(rng.randrange(0, 9))] for _ in "ab")
        subs = {tuple(a[i] for i in at) for k in range(len(a) + 1) for at in combinations(range(len(a)), k)}
        shared = subs & {tuple(b[i] for i in at) for k in range(len(b) + 1) for at in combinations(range(len(b)), k)}
        assert S.common_length(a, b) == max(map(len, shared))
