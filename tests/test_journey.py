"""Journey operators: aligned changes, co-movement, transition chain, day types."""

import datetime as dt
import itertools

import numpy as np

from turnstile.operators import journey as J

H = dt.datetime(2024, 1, 1)


def _waits(spark, rows):
    return spark.createDataFrame([(H + dt.timedelta(hours=h), r, float(w)) for h, r, w in rows],
                                 "slot timestamp_ntz, ride string, wait double")


def test_aligned_change_is_null_when_previous_slot_missing(spark):
    # ride b has no value at slot 1, so its change at slot 2 is NULL (a plain lag would give 30-10)
    w = _waits(spark, [(0, "a", 10), (0, "b", 10), (1, "a", 20), (2, "a", 5), (2, "b", 30)])
    c = {(r.slot.hour, r.ride): r.change for r in J.aligned_changes(w).collect()}
    assert c[(1, "a")] == 10 and c[(2, "a")] == -15
    assert c[(2, "b")] is None
    assert c[(0, "a")] is None


def test_co_movement_equals_pair_enumeration(spark):
    rng = np.random.default_rng(3)
    rides = ["a", "b", "c", "d"]
    rows = [(h, r, int(rng.integers(0, 50))) for h in range(40) for r in rides if rng.random() < 0.85]
    w = _waits(spark, rows)
    ch = J.aligned_changes(w)
    got = {(r.from_ride, r.to_ride): r.moves for r in J.co_movement(ch, rides).collect()}
    by_slot = {}
    for r in ch.collect():
        by_slot.setdefault(r.slot, {})[r.ride] = r.change
    want = {(a, b): 0 for a, b in itertools.permutations(rides, 2)}
    for d in by_slot.values():
        for a, b in itertools.permutations(d, 2):
            if d[a] is not None and d[b] is not None and d[a] < 0 and d[b] > 0:
                want[(a, b)] += 1
    assert got == want


def test_steady_state_of_periodic_chain(spark):
    # a -> b -> c -> a is periodic; the lazy chain still converges to uniform
    probs = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 1.0), ("c", "a", 1.0),
                                   ("a", "c", 0.0), ("b", "a", 0.0), ("c", "b", 0.0)],
                                  "from_ride string, to_ride string, p double")
    pi = {r.ride: r.pi for r in J.steady_state(probs, ["a", "b", "c"]).collect()}
    assert abs(sum(pi.values()) - 1) < 1e-12
    assert all(abs(v - 1 / 3) < 1e-9 for v in pi.values())


def test_steady_state_satisfies_pi_p(spark):
    P = np.array([[0.0, 0.7, 0.3], [0.5, 0.0, 0.5], [0.9, 0.1, 0.0]])
    names = ["x", "y", "z"]
    probs = spark.createDataFrame([(names[i], names[j], float(P[i, j])) for i in range(3) for j in range(3) if i != j],
                                  "from_ride string, to_ride string, p double")
    pi = J.steady_state(probs, names)
    v = np.array([{r.ride: r.pi for r in pi.collect()}[n] for n in names])
    assert np.allclose(v @ P, v, atol=1e-10)


def test_day_type_precedence(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 9)]
    att = spark.createDataFrame([(d, "f", float(t)) for d, t in zip(days, [1, 2, 3, 4, 5, 6, 7, 100])],
                                "day date, facility string, attendance double")
    cal = spark.createDataFrame([(d,) for d in days], "day date")
    covid = spark.createDataFrame([(days[0],), (days[3],)], "day date")
    out = {r.day.day: r.day_type for r in J.day_types(cal, att, covid, "f").collect()}
    assert out[1] == "quiet"       # quiet wins over covid
    assert out[4] == "covid"
    assert out[8] == "busy"
    assert out[5] == "normal"


def test_entropy_natural_log(spark):
    rows = spark.createDataFrame([(1, 0, "a"), (1, 0, "b"), (1, 0, "a"), (1, 0, "b"), (2, 0, "a")],
                                 "visitor long, session_id long, ride string")
    e = {r.visitor: r.entropy for r in J.sequence_entropy(rows, ["visitor", "session_id"], "ride").collect()}
    assert abs(e[1] - np.log(2)) < 1e-12 and abs(e[2]) < 1e-12


def test_outflow_by_group_equals_pivot_loops(spark):
    # brute force in the reference's shape: per group, pivot, diff, family subset, pair loops
    rng = np.random.default_rng(11)
    rides = ["r0", "r1", "r2", "ref"]
    rows = [(g, h, r, float(rng.integers(0, 60))) for g in ("normal", "covid") for h in range(30)
            for r in rides if rng.random() < 0.9]
    w = spark.createDataFrame([(g, H + dt.timedelta(hours=h + (0 if g == "normal" else 100)), r, v)
                               for g, h, r, v in rows], "day_type string, slot timestamp_ntz, ride string, wait double")
    got = {(r.day_type, r.ride): r.outflow for r in J.outflow_by_group(w, "ref").collect()}
    want = {}
    for g in ("normal", "covid"):
        table = {}
        for gg, h, r, v in rows:
            if gg == g:
                table.setdefault(h, {})[r] = v
        hours = sorted(table)
        if g == "covid":
            keep = rides
        else:
            def series(r):
                return [table[h].get(r) for h in hours]
            ref = series("ref")
            keep = []
            for r in rides:
                pairs = [(a, b) for a, b in zip(series(r), ref) if a is not None and b is not None]
                xs, ys = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
                c = np.corrcoef(xs, ys)[0, 1] if xs.std() > 0 and ys.std() > 0 else np.nan
                if c < 0.5:
                    keep.append(r)
        for a in keep:
            n = 0
            for i in range(1, len(hours)):
                cur, prev = table[hours[i]], table[hours[i - 1]]
                da = cur[a] - prev[a] if a in cur and a in prev else None
                if da is None or da >= 0:
                    continue
                for b in keep:
                    if b != a and b in cur and b in prev and cur[b] - prev[b] > 0:
                        n += 1
            want[(g, a)] = n
    assert got == want
