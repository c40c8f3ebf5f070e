"""Rentals followed from their first message to their end, with one keyed state per bike.

A bike's state holds its rentals that have not ended: per start the first and the last GPS time seen so far, with their
batteries. A newer start closes a rental; a timer at that start emits it once the watermark has passed, when no message
of it can come any more, and its state ends with it. Messages are combined per rental inside each input partition before
they are sent to their bike, so a bike with most of the messages sends few rows.

The state of a bike is one value with one timer, for the earliest newer start: it is read and written once per batch and
once per expiry, however many rentals and messages the bike has.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.calendar import rental_duration

PARTIAL = "bike_id bigint, seen timestamp, start bigint, first bigint, first_battery int, last bigint, last_battery int"
ENDED = "bike_id bigint, start bigint, first bigint, last bigint, battery_start int, battery_end int"
#: Rentals that started before ``before`` have ended; the others by start.
STATE = """before bigint, open array<struct<start: bigint, first: bigint, first_battery: int, last: bigint,
    last_battery: int>>"""
#: State with timers is kept by this store.
CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


def merged(a: tuple | None, b: tuple) -> tuple:
    """Two sightings (first, battery, last, battery) of one rental as one; copies change nothing."""
    if a is None:
        return b
    return (*(a[:2] if a[0] <= b[0] else b[:2]), *(a[2:] if a[2] >= b[2] else b[2:]))


class OpenRentals(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rentals = handle.getValueState("rentals", STATE)

    def _store(self, ended: int | None, known: dict[int, tuple]) -> None:
        """Keep the rentals and set the timer of the first that a newer start has closed."""
        starts = sorted(known)
        self.rentals.update((ended, [(start, *known[start]) for start in starts]))
        if len(starts) > 1:
            self.handle.registerTimer(starts[1] // 1000)

    def _read(self) -> tuple[int | None, dict[int, tuple]]:
        state = self.rentals.get()
        return (None, {}) if state is None else (state[0], {row[0]: tuple(row[1:]) for row in state[1]})

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803 - Spark's names
        ended, known = self._read()
        for _, _, start, *seen in rows:
            if ended is None or start >= ended:
                known[start] = merged(known.get(start), tuple(seen))
        self._store(ended, known)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803 - Spark's names
        passed, (ended, known) = timerValues.getCurrentWatermarkInMs(), self._read()
        starts = sorted(known)
        due = [(start, newer) for start, newer in zip(starts, starts[1:]) if newer // 1000 < passed]
        # a timer that an older start has overtaken finds nothing to do
        for start, ended in due:
            first, first_battery, last, last_battery = known.pop(start)
            end = last_battery if last > first else None
            yield Row(bike_id=key[0], start=start, first=first, last=last, battery_start=first_battery, battery_end=end)
        if due:
            self._store(ended, known)

    def close(self) -> None:
        pass


def _combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if not len(batch):
            continue
        rows = batch.sort_values("at", kind="stable").groupby(["bike_id", "start"], as_index=False, sort=False)
        # nth keeps nulls where first() and last() would pass over them
        first, last = rows.nth(0), rows.nth(-1)
        found = first.merge(last, on=["bike_id", "start"], suffixes=("_a", "_b"))
        yield pd.DataFrame(
            {
                "bike_id": found["bike_id"], "seen": found["seen_b"], "start": found["start"], "first": found["at_a"],
                "first_battery": found["battery_a"].astype("Int32"), "last": found["at_b"],
                "last_battery": found["battery_b"].astype("Int32"),
            }
        )


def ended_rentals(messages: DataFrame, delay: str = "1 day") -> DataFrame:
    """Stream of rentals (start, bike, battery at start and end, minutes) that a newer start of the bike has ended.

    ``messages`` is a stream with bike_id, last_rental_start, last_gps_time and battery. Messages may come late by
    ``delay`` and more than once; one that is later still may be left out, and one of a rental that has been emitted
    changes nothing. Messages without a bike, a start or a GPS time belong to no rental.
    """
    known = messages.filter("bike_id is not null and last_rental_start is not null and last_gps_time is not null")
    micros = {"start": "last_rental_start", "at": "last_gps_time"}
    rows = known.select(
        F.col("bike_id").cast("long"),
        F.col("last_gps_time").cast("timestamp").alias("seen"),
        *[F.unix_micros(F.col(c).cast("timestamp")).alias(name) for name, c in micros.items()],
        F.col("battery").cast("int"),
    )
    partial = rows.mapInPandas(_combined, PARTIAL).withWatermark("seen", delay)
    ended = partial.groupBy("bike_id").transformWithState(OpenRentals(), ENDED, "append", "eventTime")

    def time(column: str):
        return F.timestamp_micros(F.col(column)).cast("timestamp_ntz")

    return ended.select(
        time("start").alias("last_rental_start"),
        "bike_id",
        "battery_start",
        "battery_end",
        rental_duration(time("last"), time("start")).alias("duration"),
    )
