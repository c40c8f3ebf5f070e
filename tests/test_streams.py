"""The rental store under late, repeated and restarted batches."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from ridepulse.streaming import open_rentals
from ridepulse.streaming import telemetry as T
from ridepulse.streaming.rentals import RentalStore, stream_rentals
from test_rentals import at, by_hand, frame, ping, rebuilt, skewed


def messages(spark, rows):
    return frame(spark, rows).drop("bike_type", "state_id")


def test_late_message_rules(spark, tmp_path):
    store = RentalStore.create(spark, str(tmp_path / "store"))
    store.apply(messages(spark, [ping(1, 0, 0, 90), ping(1, 0, 10, 80), ping(1, 100, 100, 70)]), 0)
    assert rebuilt(store.rentals) == {(1, at(0)): (90, 80, 10)}
    assert store.coordinates.count() == 2
    store.apply(messages(spark, [ping(1, 0, 20, 60)]), 1)
    assert rebuilt(store.rentals) == {(1, at(0)): (90, 80, 10)}, "the rental row stays as it was"
    assert store.coordinates.count() == 3, "the late position is added"
    assert {r.batch_id: r.processed for r in store.log.collect()} == {0: 1, 1: 1}, "and counted again"
    assert [r.last_rental_start for r in store.raw.collect()] == [at(100)], "and purged"


def test_a_new_checkpoint_adds_to_the_store(spark, tmp_path):
    store = RentalStore.create(spark, str(tmp_path / "store"))
    for bike, state in ((1, "a"), (2, "b")):
        df = messages(spark, [ping(bike, 0, 0), ping(bike, 0, 10), ping(bike, 100, 100)])
        df.write.parquet(str(tmp_path / f"in{bike}"))
        stream_rentals(T.message_stream(spark, str(tmp_path / f"in{bike}"), df.schema), store, str(tmp_path / state))
    assert set(rebuilt(store.rentals)) == {(1, at(0)), (2, at(0))}
    assert {r.bike_id for r in store.raw.collect()} == {1, 2} and store.coordinates.count() == 4 and store.log.count() == 2


def test_a_half_written_batch_is_never_seen(spark, tmp_path, monkeypatch):
    store = RentalStore.create(spark, str(tmp_path / "store"))
    store.apply(messages(spark, [ping(1, 0, 0), ping(1, 0, 10), ping(1, 100, 100)]), 0)
    before = rebuilt(store.rentals), store.raw.count(), store.log.count()
    second = messages(spark, [ping(1, 100, 130), ping(1, 200, 200)])
    write = RentalStore._write

    def broken(self, df, table, version, mode="overwrite"):
        if table == "raw":
            raise OSError("lost")
        write(self, df, table, version, mode)

    monkeypatch.setattr(RentalStore, "_write", broken)
    with pytest.raises(OSError):
        store.apply(second, 1)
    assert (rebuilt(store.rentals), store.raw.count(), store.log.count()) == before
    monkeypatch.setattr(RentalStore, "_write", write)
    store.apply(second, 1)
    assert set(rebuilt(store.rentals)) == {(1, at(0)), (1, at(100))} and store.log.count() == 2


def test_a_batch_reads_the_days_of_its_rentals_only(spark, tmp_path):
    store = RentalStore.create(spark, str(tmp_path / "store"))
    for day in range(4):
        store.apply(messages(spark, [ping(1, day * 1440, day * 1440), ping(1, day * 1440 + 100, day * 1440 + 100)]), day)
    days = [at(0).date(), None]
    found = store.finished_on(days, store.versions())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnull(day" in plan and found.count() == 2
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert str(days[0]) in scan or "18718" in scan, scan
    assert len(found.inputFiles()) <= len(store.rentals.inputFiles())


def test_messages_without_a_time_are_stored_once(spark, tmp_path):
    rows = [(1, None, 5), (2, "2024-01-05 10:00:00", 6)]
    df = spark.createDataFrame(rows, "bike_id long, t string, battery int").selectExpr("bike_id", "cast(t as timestamp_ntz) last_gps_time", "battery")
    for _ in range(3):
        df.write.mode("append").parquet(str(tmp_path / "in"))
        stream = T.message_stream(spark, str(tmp_path / "in"), df.schema)
        stored = T.store_unique(stream, ["bike_id", "last_gps_time"], "last_gps_time", str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))


def test_rentals_followed_from_open_to_completed(spark, tmp_path):
    rows = [r for r in skewed(23, 500) if r[2] >= r[1]]
    done, newest = by_hand(rows), max(r[2] for r in rows)
    starts = {b: sorted({r[1] for r in rows if r[0] == b}) for b in {r[0] for r in rows}}
    delay = dt.timedelta(minutes=300)
    due = {(b, s): v for (b, s), v in done.items() if starts[b][starts[b].index(s) + 1] < newest - delay}
    rows.sort(key=lambda r: r[2])
    cuts, source, held = [0, 100, 200, 300, 400, len(rows)], str(tmp_path / "in"), []
    for a, b in zip(cuts, cuts[1:]):
        late = [r for r in rows[a:b] if r[2] > rows[b - 1][2] - dt.timedelta(minutes=200) and r[5] == 3] if b < len(rows) else []
        part = held + [r for r in rows[a:b] if r not in late] + rows[max(0, a - 20) : a]
        held = late
        messages(spark, part).repartition(2).write.mode("append").parquet(source)
        stream = open_rentals.ended_rentals(T.message_stream(spark, source, messages(spark, rows[:1]).schema), "300 minutes")
        table = T.run_available(stream, str(tmp_path / "out"), str(tmp_path / "state"), open_rentals.CONF)
    assert rebuilt(table) == due and table.count() == len(due) > 100
    again = T.run_available(stream, str(tmp_path / "out"), str(tmp_path / "state"), open_rentals.CONF)
    assert again.count() == len(due), "a restart without new files changes nothing"
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_sightings_merge_in_any_order():
    a, b = (5, 50, 9, None), (3, None, 7, 70)
    assert open_rentals.merged(a, b) == open_rentals.merged(b, a) == (3, None, 9, None) == open_rentals.merged(None, (3, None, 9, None))


class CountedState:
    """A bike's state and timers in memory, with the number of times they were asked or told something."""

    def __init__(self):
        self.kept, self.timers, self.calls = {}, set(), 0

    def _called(self, answer=None):
        self.calls += 1
        return answer

    def getValueState(self, name, schema):  # noqa: N802 - Spark's name
        state = type("Value", (), {})()
        state.get = lambda: self._called(self.kept.get(name))
        state.exists = lambda: self._called(name in self.kept)
        state.update = lambda value: self._called(self.kept.update({name: value}))
        return state

    def getMapState(self, name, key, schema):  # noqa: N802 - Spark's name
        state, rows = type("Map", (), {})(), self.kept.setdefault(name, {})
        state.get = state.getValue = lambda k: self._called(rows.get(k))
        state.containsKey = lambda k: self._called(k in rows)
        state.keys = lambda: self._called(list(rows))
        state.updateValue = lambda k, value: self._called(rows.update({k: value}))
        state.removeKey = lambda k: self._called(rows.pop(k))
        return state

    def registerTimer(self, at):  # noqa: N802 - Spark's name
        self._called(self.timers.add(at))

    def run(self, processor, rows, watermark):
        """One micro-batch of a bike: its rows, then its expired timers."""
        kind = Row("bike_id", "seen", "start", "first", "first_battery", "last", "last_battery")
        times, out = TimerValues(0, watermark), []
        if rows:
            list(processor.handleInputRows((1,), iter([kind(1, None, *r) for r in rows]), times))
        for at in sorted(t for t in self.timers if t < watermark):
            out += processor.handleExpiredTimer((1,), times, ExpiredTimerInfo(at))
            self.timers.discard(at)
        return [tuple(r) for r in out]


def test_a_bike_asks_its_state_once_a_batch(spark):
    state, processor = CountedState(), open_rentals.OpenRentals()
    processor.init(state)
    rows = [(i * 1000, i * 1000 + 5, i, i * 1000 + 9, -i) for i in range(500)]
    assert state.run(processor, rows[::2], 0) == []
    assert state.run(processor, rows[1::2] + rows[:50], 0) == []
    found = state.run(processor, [], 400)
    assert found == [(1, *r[:2], r[3], r[2], r[4]) for r in rows[:399]]
    assert state.calls < 20, "not once per message, rental or timer"
    assert state.run(processor, rows[:10], 400) == [], "messages of ended rentals change nothing"
    assert [r[1] for r in state.run(processor, [(500_000, 500_005, 1, 500_005, 1)], 501)] == [r[0] for r in rows[399:]]


def test_repeated_batch_changes_nothing(spark, tmp_path):
    store = RentalStore.create(spark, str(tmp_path / "store"))
    rows = skewed(21, 600)
    rows.sort(key=lambda r: r[2])
    store.apply(messages(spark, rows[:300]), 0)
    store.apply(messages(spark, rows[300:]), 1)
    once = rebuilt(store.rentals), store.coordinates.count()
    store.apply(messages(spark, rows[300:]), 1)
    assert (rebuilt(store.rentals), store.coordinates.count()) == once


def test_stream_equals_batch(spark, tmp_path):
    rows = [r for r in skewed(22, 600) if r[2] >= r[1]]
    rows.sort(key=lambda r: r[1])
    store = RentalStore.create(spark, str(tmp_path / "store"))
    source = str(tmp_path / "in")
    for part in (rows[:200], rows[200:450], rows[450:]):
        df = messages(spark, part)
        df.write.mode("append").parquet(source)
        stream_rentals(T.message_stream(spark, source, df.schema), store, str(tmp_path / "state"))
    assert set(rebuilt(store.rentals)) == set(by_hand(rows))
    stream_rentals(T.message_stream(spark, source, messages(spark, rows).schema), store, str(tmp_path / "state"))
    assert set(rebuilt(store.rentals)) == set(by_hand(rows)), "a run without new files adds nothing"


def test_late_messages_and_new_checkpoints_keep_every_message_once(spark, tmp_path):
    rows = [(i, f"2024-01-{day:02d} {hour:02d}:00:00", day) for i in range(3) for day, hour in ((5, 10), (1, 3), (5, 4), (5, 10))]
    df = spark.createDataFrame(rows, "bike_id long, t string, battery int").selectExpr("bike_id", "cast(t as timestamp_ntz) last_gps_time", "battery")
    for part, state in (("day(last_gps_time) = 5", "a"), ("true", "a"), ("bike_id = 1", "b")):
        df.filter(part).write.mode("append").parquet(str(tmp_path / "in"))
        stream = T.message_stream(spark, str(tmp_path / "in"), df.schema)
        stored = T.store_unique(stream, ["bike_id", "last_gps_time"], "last_gps_time", str(tmp_path / "out"), str(tmp_path / state))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.distinct().collect()))


def test_a_new_checkpoint_adds_to_landed_rows(spark, tmp_path):
    from ridepulse.streaming.landing import ingest_new_files

    for bike in (7, 8):
        (tmp_path / f"in{bike}").mkdir()
        (tmp_path / f"in{bike}" / "x.json").write_text(f'[{{"BikeID": {bike}}}]')
        ingest_new_files(spark, str(tmp_path / f"in{bike}"), str(tmp_path / "t"), str(tmp_path / "e"), str(tmp_path / f"s{bike}"), "BikeID LONG")
    assert {r.BikeID for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {7, 8}
