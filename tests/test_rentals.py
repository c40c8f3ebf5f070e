"""Message cleaning and rental reconstruction against plain Python, with one bike holding most rows."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridepulse.operators import pings as P
from ridepulse.operators import rentals as R
from ridepulse.operators.ranking import exact_percentiles, ordinal_by_time, ordinal_shuffled, running_total
from ridepulse.operators.sessions import infer_starts
from ridepulse.sources.store import insert_ignore

T0 = dt.datetime(2021, 4, 1)
SCHEMA = """bike_id long, last_rental_start timestamp_ntz, last_gps_time timestamp_ntz, battery int, bike_type string,
    state_id int, latitude double, longitude double"""


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def ping(bike, start, gps, battery=50, state=2, lat=53.3, lon=-6.2, kind="DUB-General"):
    return (bike, at(start), at(gps), battery, kind, state, lat, lon)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def skewed(seed=3, n=1500):
    rng, seen, rows = random.Random(seed), set(), []
    while len(rows) < n:
        bike = 1 if rng.random() < 0.4 else rng.randrange(2, 30)
        start = rng.randrange(0, 40) * 90
        gps = start + rng.randrange(-3, 80)
        if (bike, start, gps) not in seen:
            seen.add((bike, start, gps))
            rows.append(ping(bike, start, gps, rng.choice([None, -5, 0, 30, 104]), rng.randrange(1, 6)))
    return rows


def by_hand(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[0], r[1])].append(r)
    newest = {b: max(s for bb, s in groups if bb == b) for b, _ in groups}
    found = {}
    for (bike, start), g in groups.items():
        if start == newest[bike]:
            continue
        g.sort(key=lambda r: r[2])
        minutes = int((g[-1][2] - start).total_seconds() // 60) if g[-1][2] > start else 0
        found[(bike, start)] = (g[0][3], g[-1][3] if len(g) > 1 else None, minutes)
    return found


def rebuilt(df):
    return {(r.bike_id, r.last_rental_start): (r.battery_start, r.battery_end, r.duration) for r in df.collect()}


def test_edge_rentals(spark):
    rows = [
        ping(1, 0, 0, None), ping(1, 0, 30, 70),  # null at the start
        ping(1, 100, 99, 40),  # one message, before the start
        ping(1, 200, 200, 80), ping(1, 200, 259, None),  # null at the end
        ping(1, 300, 300),  # open
        ping(2, 0, 5),  # open, shares its start with bike 1
    ]
    assert rebuilt(R.reconstruct(frame(spark, rows))) == {
        (1, at(0)): (None, 70, 30),
        (1, at(100)): (40, None, 0),
        (1, at(200)): (80, None, 59),
    }


def test_reconstruction_of_skewed_bikes(spark):
    rows = skewed()
    df = frame(spark, rows).repartition(7)
    assert rebuilt(R.reconstruct(df)) == by_hand(rows)
    assert rebuilt(R.reconstruct(df.union(df))) == by_hand(rows), "copies change nothing"


def test_batch_audit_and_purge(spark):
    rows = skewed(5)
    batch = R.process_batch(frame(spark, rows))
    done, bikes = by_hand(rows), {r[0] for r in rows}
    assert tuple(batch.log.first()) == (len(done), 0)
    assert R.count_pending(frame(spark, rows)).first()[0] == len(done) + len(bikes)
    left = {(r.bike_id, r.last_rental_start) for r in batch.remaining.collect()}
    assert len(left) == len(bikes) and not left & set(done)
    assert R.orphans(batch.coordinates, batch.rentals).count() == 0


def test_rank_matches_order(spark):
    rows = skewed(7)
    want = {}
    for bike in {r[0] for r in rows}:
        for rank, start in enumerate(sorted({r[1] for r in rows if r[0] == bike}, reverse=True), 1):
            want[(bike, start)] = rank
    got = {(r.bike_id, r.last_rental_start): r.rent_rank for r in R.rank_rentals(frame(spark, rows)).collect()}
    assert got == want


def test_history_by_day(spark):
    rows = skewed(9)
    pings = frame(spark, rows).withColumn("battery", P.normal_battery(F.col("battery")))
    got = defaultdict(dict)
    for r in R.rental_history(pings).collect():
        assert len(r.coordinates) == len(r.battery)
        got[(r.bike_id, r.last_rental_start)][r.day] = (r.battery, r.last_gps_time)
    groups = defaultdict(list)
    for r in rows:
        battery = -1 if r[3] is None or r[3] < 0 else min(r[3], 100)
        groups[(r[0], r[1])].append((r[2], battery))
    assert set(got) == set(groups)
    first_valid = {(r.bike_id, r.last_rental_start): r.start_battery for r in R.first_valid_battery(pings).collect()}
    direct = {(r.bike_id, r.last_rental_start): r.start_battery for r in R.grouped_rentals(pings).collect()}
    for key, g in groups.items():
        newest_first = [b for _, b in sorted(g, reverse=True)]
        assert set(got[key]) == {t.date() for t, _ in g}
        assert sum((got[key][d][0] for d in sorted(got[key], reverse=True)), []) == newest_first
        assert {latest for _, latest in got[key].values()} == {max(t for t, _ in g)}
        assert first_valid[key] == direct[key] == next((b for b in reversed(newest_first) if b > 0), -1)


def test_never_started_uses_the_start_alone(spark):
    rows = [
        ping(1, 0, 1, state=1),  # alone: dropped
        ping(2, 10, 11, state=1), ping(3, 10, 12, state=1),  # two bikes share the start: both stay
        ping(4, 20, 21, state=2),  # alone but normal
        (5, None, at(30), 50, "DUB-General", 1, 1.0, 1.0),  # no start: stays
    ]
    assert sorted(r.bike_id for r in P.drop_never_started(frame(spark, rows)).collect()) == [2, 3, 4, 5]


def test_position_and_battery_rules(spark):
    cases = [((0.0, 0.0), False), ((0.0, 2.0), True), ((None, 2.0), True), ((None, None), False), ((None, 0.0), False), ((1.0, None), True)]
    df = spark.createDataFrame([(i, *p) for i, (p, _) in enumerate(cases)], "i int, a double, b double")
    kept = {r.i for r in df.filter(P.has_position(F.col("a"), F.col("b"))).collect()}
    assert kept == {i for i, (_, keep) in enumerate(cases) if keep}
    levels = spark.createDataFrame([(i, b) for i, b in enumerate([-5, 0, 100, 104, None])], "i int, b int")
    assert [r[0] for r in levels.orderBy("i").select(P.normal_battery(F.col("b"))).collect()] == [-1, 0, 100, 100, -1]


def test_unique_rows_are_stable(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 4, "z"), (2, None, "a"), (1, 4, "y")], "k int, v int, w string")
    assert sorted(tuple(r) for r in P.unique_rows(df, ["k"]).collect()) == [(1, 4, "y"), (2, None, "a")]


def test_insert_ignore_keeps_what_is_stored(spark):
    stored = spark.createDataFrame([(1, 1, "old")], "k int, seq int, v string")
    new = spark.createDataFrame([(1, 2, "late"), (2, 4, "second"), (2, 3, "first")], "k int, seq int, v string")
    assert [tuple(r) for r in insert_ignore(stored, new, ["k"], ["seq"]).collect()] == [(2, 3, "first")]


def test_inferred_starts(spark):
    rng = random.Random(1)
    rows = [(1 if rng.random() < 0.5 else rng.randrange(2, 9), at(rng.randrange(0, 20000))) for _ in range(800)]
    rows += [(99, at(0)), (99, at(360)), (99, at(719)), (99, at(1079))]  # exactly the gap, then one minute less
    df = spark.createDataFrame(rows, "bike long, ts timestamp_ntz")
    got = sorted((r.bike, r.ts, r.session_start) for r in infer_starts(df, "bike", "ts", 6 * 3600).collect())
    want = []
    for bike in {b for b, _ in rows}:
        start = last = None
        for ts in sorted(t for b, t in rows if b == bike):
            if last is None or ts >= last + dt.timedelta(hours=6):
                start = ts
            last = ts
            want.append((bike, ts, start))
    assert got == sorted(want)
    with pytest.raises(ValueError):
        infer_starts(df, "bike", "ts", 60, slice_seconds=61)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-3000, 3000)), min_size=1, max_size=60), st.booleans())
def test_ordinal_by_time(spark, rows, newest_first):
    rows = [(k, T0 + dt.timedelta(seconds=s * 97), i) for i, (k, s) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, i int")
    placed = ordinal_by_time(df, ["k"], "ts", "n", newest_first, [F.col("i")], 3600).collect()
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: r[2])
        mine.sort(key=lambda r: r[1], reverse=newest_first)
        assert [r.i for r in sorted((p for p in placed if p.k == k), key=lambda p: p.n)] == [r[2] for r in mine]


def test_shuffled_numbers_and_running_total(spark):
    df = spark.range(500)
    one = [r.n for r in ordinal_shuffled(df, [F.col("id")], 1, "n", buckets=16).orderBy("id").collect()]
    two = [r.n for r in ordinal_shuffled(df, [F.col("id")], 2, "n", buckets=16).orderBy("id").collect()]
    assert sorted(one) == sorted(two) == list(range(1, 501)) and one != two
    rng = random.Random(4)
    counts = {round(rng.gauss(0, 5), 2): rng.randrange(1, 9) for _ in range(200)}
    got = running_total(spark.createDataFrame(list(counts.items()), "v double, n long"), "v", "n")
    total, want = 0, {}
    for v in sorted(counts):
        total += counts[v]
        want[v] = total
    assert {r.v: r.upto for r in got.collect()} == want
    single = spark.createDataFrame([(3, 7)], "v int, n long")
    assert running_total(single, "v", "n").first().upto == 7


def test_running_total_and_percentiles_by_key(spark):
    """An outlier, a hot key and a continuous column: the ranges stay of like size and the results exact."""
    rng = random.Random(8)
    rows = [("a", rng.gauss(0, 1)) for _ in range(3000)] + [("a", 1e12), ("b", 4.0)] + [("c", float(i % 3)) for i in range(30)]
    counts = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").count().withColumnRenamed("count", "n")
    upto = running_total(counts, "v", "n", keys=["k"]).collect()
    for k in "abc":
        mine = sorted(v for key, v in rows if key == k)
        assert {r.v: r.upto for r in upto if r.k == k} == {v: i + 1 for i, v in enumerate(mine)}
    got = exact_percentiles(counts, "v", "n", (0, 0.25, 0.9, 1), ("lo", "q1", "p90", "hi"), ["k"]).collect()
    assert len(got) == 3
    for r in got:
        mine = [v for key, v in rows if key == r.k]
        assert [r.lo, r.q1, r.p90, r.hi] == pytest.approx(np.quantile(mine, [0, 0.25, 0.9, 1]).tolist())
    assert exact_percentiles(counts.filter("k = 'z'"), "v", "n", (0.5,), ("m",)).first().m is None


def test_running_total_spreads_an_outlier(spark):
    counts = spark.range(20_000).selectExpr("CAST(id AS DOUBLE) AS v", "1L AS n").union(spark.sql("SELECT 1e15D, 1L"))
    ranges = counts.repartitionByRange(8, "v").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in ranges) < 5_000
    assert running_total(counts, "v", "n").agg(F.max("upto")).first()[0] == 20_001
