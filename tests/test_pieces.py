"""Traces spread over tasks piece by piece, against one fold over each trace."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_operators import as_rows, matched_by_one
from wayfold.config import MatchConfig
from wayfold.operators import match, pieces, traces
from wayfold.schema import ROAD


def walk(rng, n, parked):
    """Samples of a vehicle that moves about and stands still for long."""
    t, x, y = 0, 10.0, 50.0
    for _ in range(n):
        t += rng.choice([1000, 1000, 2000, 20_000])
        if parked == 0 and rng.random() < 0.01:
            parked = rng.randint(50, 400)
        parked = max(0, parked - 1)
        step = 1e-6 if parked else 3e-4
        x, y = x + rng.uniform(-step, step * 1.5), y + rng.uniform(-step, step)
        yield t, x, y


@pytest.mark.parametrize("either", [False, True])
def test_thinning_by_pieces(spark, either):
    rng = random.Random(1)
    rows = [(name, t, x, y, {"e": 1.0} if rng.random() < 0.003 else None, i) for name in ("a", None, "c") for i, (t, x, y) in enumerate(walk(rng, 3000, 1000 if name == "a" else 0))]
    rows += [("even", 10_000 * i, 10.0 + 3e-4 * i, 50.0, None, i) for i in range(900)]  # phases never meet
    rows += [("one", 5, 1.0, 1.0, None, 0), ("none", None, 1.0, 1.0, None, 0), ("twice", 5, 1.0, 1.0, None, 0), ("twice", 5, 1.0, 1.0, None, 1), ("lost", 0, None, 1.0, None, 0), ("lost", 90_000, 1.0, None, None, 1), ("lost", 95_000, 1.0, 1.0, None, 2)]
    points = spark.createDataFrame(rows, "vehicle_id string, time_ms long, lon double, lat double, event_data map<string,double>, i int")
    told = lambda df: sorted(map(tuple, df.select("vehicle_id", "time_ms", "i").collect()), key=str)
    want = told(traces.thin(points, 60.0, 25_000, either=either))
    assert told(pieces.thin(points, 60.0, 25_000, either=either, piece_ms=200_000)) == want
    assert 100 < len(want) < len(rows)
    assert pieces.thin(points.limit(0), 60.0, 25_000).count() == 0


@pytest.fixture(scope="module")
def town(spark):
    """Roads of uneven lengths, some of them one-way, some that lead nowhere."""
    rng, size = random.Random(3), 9
    at = {(i, j): (10.0 + 0.002 * i + rng.uniform(-4e-4, 4e-4), 50.0 + 0.0013 * j + rng.uniform(-3e-4, 3e-4)) for i in range(size) for j in range(size)}
    rows = []
    for (i, j), a in at.items():
        for other in ((i + 1, j), (i, j + 1)):
            if other in at and rng.random() < 0.9:
                name, line = f"{i}_{j}_{other[0]}_{other[1]}", [{"lon": x, "lat": y} for x, y in (a, at[other])]
                rows.append((name, f"n{i}_{j}", f"n{other[0]}_{other[1]}", f"{name}_f", None if rng.random() < 0.2 else f"{name}_b", rng.randrange(9), line))
    return spark.createDataFrame(rows, ROAD), at


def drive(rng, at, n):
    """Noisy samples along streets, with jumps and gaps."""
    node, t = (4, 4), 1_000_000
    for _ in range(n):
        i, j = node
        onward = rng.choice([p for p in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)) if p in at])
        for k in range(3):
            f = (k + rng.random()) / 3
            yield t, at[node][0] + f * (at[onward][0] - at[node][0]) + rng.gauss(0, 9e-5), at[node][1] + f * (at[onward][1] - at[node][1]) + rng.gauss(0, 6e-5)
            t += rng.choice([3000, 6000, 9000])
        node = onward
        if rng.random() < 0.04:
            node, t = (rng.randrange(9), rng.randrange(9)), t + rng.choice([0, 400_000])


@pytest.mark.parametrize("changes", [{}, {"min_distance_m": 0.0, "min_interval_ms": 0, "seqprob_delta_min": -2.0}, {"connect": False}])
def test_matching_by_pieces(spark, town, changes, monkeypatch):
    monkeypatch.setattr(pieces, "FAN", 4)  # three levels of products
    roads_, at = town
    rng = random.Random(7)
    rows = [(name, t, x, y, {"e": 1.0} if rng.random() < 0.1 else None) for name, n in (("long", 120), (None, 40), ("short", 1)) for t, x, y in drive(rng, at, n)]
    rows += [("away", 5, 0.0, 0.0, None)]
    points = spark.createDataFrame(rows, "vehicle_id string, time_ms long, lon double, lat double, event_data map<string,double>")
    config = replace(MatchConfig(max_inputs=10**9), **changes)
    got = pieces.match_long(points, roads_, config, piece_ms=60_000)
    want = as_rows(matched_by_one(points, roads_, config))
    assert got.columns == match.match(points.limit(0), roads_, config).columns
    assert as_rows((r.vehicle_id, r.asDict()) for r in got.collect()) == want and len(want) > 100
    kinds = {r[1] for r in want}
    assert {"estimate", "speed", "snapped"} <= kinds and (config.seqprob_delta_min != -2.0 or "failure" in kinds)


def test_chains_like_the_kernel(spark, monkeypatch):
    """Filter, sequence and the states chosen, with breaks, dead ends, gaps in the numbers and a null key."""
    from wayfold.operators import kernel, markov

    monkeypatch.setattr(pieces, "FAN", 3)
    rng, emissions, transitions, want = random.Random(5), [], [], []
    for name, n in (("a", 150), (None, 40), ("one", 1)):
        vectors, last = [], []
        for t in sorted(rng.sample(range(4 * n), n)):
            states = {f"s{k}": rng.choice([0.0, rng.random(), rng.random()]) for k in range(rng.randint(1, 5))}
            ways = {(a, b): rng.random() for a in last for b in states if rng.random() < (0.15 if rng.random() < 0.1 else 0.7)}
            emissions += [(name, t, s, p) for s, p in states.items()]
            transitions += [(name, t, a, b, p) for (a, b), p in ways.items()]
            alive = [s for s, p in states.items() if p > 0]
            if not alive:
                continue
            now = [(kernel.Candidate(s, 0.0, 0, 0), states[s]) for s in sorted(alive)]
            place = {c.edge: k for k, (c, _) in enumerate(now)}
            before = vectors[-1][1] if vectors else []
            vector = kernel.filter_step(before, now, lambda p: {place[b]: (x, None) for (a, b), x in ways.items() if a == p.edge and b in place})
            if before and all(c.before is None for c in vector):
                vectors[-1] = (vectors[-1][0], vectors[-1][1], [before[kernel.leader([c.seq for c in before])]])
            vectors.append((t, vector, vector))
            last = alive
        chosen = kernel.backtrace([v for _, _, v in vectors])
        want += [(name, t, c.edge, round(c.filt, 9), round(c.seq, 8), c.before and c.before.edge, c is best) for (t, vector, _), best in zip(vectors, chosen) for c in vector]
    frames = spark.createDataFrame(emissions, "trace string, t long, state string, probability double"), spark.createDataFrame(transitions, "trace string, t long, from_state string, state string, probability double")
    got = [(r.trace, r.t, r.state, round(r.filter, 9), round(r.log, 8), r.before, r.chosen) for r in markov.decode(*frames, piece=40).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(w[5] is None for w in want) > 5


def test_groups_are_walked_through_within_tasks(spark):
    """Groups over several Arrow batches, with nulls and lists, and frames beside; those that lack rows of one are left out."""
    rows = [(f"t{k % 7}", k // 3000, k, None if k % 5 == 0 else k / 2, [(k, "a")] * (k % 3) if k % 4 else None) for k in range(12_000)]
    frame = spark.createDataFrame(rows, "trace string, piece long, id long, x double, l array<struct<n:long,s:string>>")
    beside = spark.createDataFrame([(f"t{k}", p, 10 * k) for k in range(6) for p in range(4)], "trace string, piece long, v long")

    def run(group, told):
        return [(group[0]["trace"], group[0]["piece"], len(group), sum(r["x"] or 0.0 for r in group), sum(n for r in group for n, _ in r["l"] or ()), sum(r["l"] is None for r in group), told[0]["v"])]

    got = pieces.grouped(frame, run, "trace string, piece long, n int, x double, l long, missing int, v long", beside)
    assert "FlatMapGroupsInArrow" not in got._jdf.queryExecution().toString()
    want = []
    for k in range(6):
        for p in range(4):
            own = [r for r in rows if r[:2] == (f"t{k}", p)]
            want.append((f"t{k}", p, len(own), sum(r[3] or 0.0 for r in own), sum(n for r in own for n, _ in r[4] or ()), sum(r[4] is None for r in own), 10 * k))
    assert sorted(map(tuple, got.collect())) == want


def test_chain_probabilities_keep_pairs_in_rows(spark, sf):
    """Pairs of candidates aren't rows to be shuffled, and their distances are distance() to the bit."""
    from wayfold.functions import geo
    from wayfold.plans import queries

    at = spark.createDataFrame([(10.0 + 0.37 * k, 50.0 - 0.21 * k, 10.001 + 0.37 * k, 50.0007 - 0.21 * k) for k in range(200)], "a double, b double, c double, d double")
    a, b, c, d = (F.col(x) for x in "abcd")
    assert at.where(geo.between(geo.placed(a, b), geo.placed(c, d)) != geo.distance(a, b, c, d)).count() == 0
    assert "FlatMapGroupsInArrow" not in queries.chain_probabilities(spark, sf)._jdf.queryExecution().toString()
