"""Structured Streaming queries; each runs to the end of the available data and equals its batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.pings import PING_KEY
from ..session import scratch, settle
from ..sources.files import WEATHER_JSON_SCHEMA, typed_weather
from ..streaming import open_rentals
from ..streaming import telemetry as T
from ..streaming.landing import ingest_new_files
from ..streaming.rentals import RentalStore, stream_rentals
from . import data
from .catalog import query

NTZ = "timestamp_ntz"


def events(spark, sf):
    return T.message_stream(spark, f"{sf}/events*.parquet", data.table(spark, sf, "events").schema)


@query(
    "T1_new_files",
    """select date, hour, timesofday, cast(floor(temp) as integer) as temp, wdsp, rhum, rain, rainfall_intensity from features""",
)
def new_files(spark, sf):
    """Weather files in two deliveries and three runs; what is stored is typed like a batch read."""
    root = scratch(spark, "t1")
    w = data.weather(spark, sf)
    reading = F.struct(
        F.floor("temp").cast("string").alias("temperature"),
        F.col("wdsp").cast("string").alias("windSpeed"),
        F.col("rhum").cast("string").alias("humidity"),
        F.col("rain").cast("string").alias("rainfall"),
        F.date_format("date", "dd-MM-yyyy").alias("date"),
        F.format_string("%02d:00", F.col("hour")).alias("reportTime"),
    )
    for part in ("hour < 12", "hour >= 12", None):
        if part:
            w.filter(part).select(F.to_json(F.array(reading)).alias("value")).write.mode("append").text(f"{root}/landing")
        ingest_new_files(
            spark, f"{root}/landing", f"{root}/table", f"{root}/errors", f"{root}/state", WEATHER_JSON_SCHEMA, multi_line=False
        )
    stored = spark.read.schema(WEATHER_JSON_SCHEMA).parquet(f"{root}/table/*")
    return typed_weather(stored)


@query("T2_unique_messages", "select bike_id, last_rental_start, last_gps_time, battery, state_id from pings")
def unique_messages(spark, sf):
    """Three deliveries: even days, then late odd days with messages of state 1 again, then from a new checkpoint."""
    folder = scratch(spark, "t2")
    pings = settle(data.pings(spark, sf).select(*PING_KEY, "battery", "state_id"), "pings")
    odd = F.dayofmonth("last_gps_time") % 2 == 1
    for delivery, state in ((~odd, "state"), (odd | F.expr("state_id = 1"), "state"), (F.expr("state_id = 2"), "other")):
        pings.filter(delivery).write.mode("append").parquet(f"{folder}/in")
        stream = T.message_stream(spark, f"{folder}/in", pings.schema)
        stored = T.store_unique(stream, PING_KEY, "last_gps_time", f"{folder}/out", f"{folder}/{state}")
    return stored


@query(
    "T3_inferred_rentals",
    """select user_id, started, last_seen, messages from (
       select user_id, min(ts) as started, max(ts) as last_seen, count(*) as messages from ping_runs group by user_id, sess)
       where last_seen + interval 6 hour <= (select max(ts) - interval 1 hour from events)""",
)
def inferred_rentals(spark, sf):
    """Three deliveries in time order; a run goes on from one to the next."""
    folder, rows = scratch(spark, "t3"), data.table(spark, sf, "events")
    first, second = "ts < timestamp_ntz'2024-01-10 00:00:00'", "ts < timestamp_ntz'2024-01-20 00:00:00'"
    for delivery in (first, f"{second} and not {first}", f"not {second}"):
        rows.filter(delivery).write.mode("append").parquet(f"{folder}/in")
        stream = T.inferred_rentals(T.message_stream(spark, f"{folder}/in", rows.schema), "user_id", "ts")
        table = T.run_available(stream, f"{folder}/out", f"{folder}/state")
    return table.withColumns({c: F.col(c).cast(NTZ) for c in ("started", "last_seen")})


@query(
    "T4_hourly_totals",
    """select * from (select date_trunc('hour', ts) as hour_start, count(*) as total, round(avg(value), 6) as mean_value
       from events group by 1) where hour_start + interval 1 hour <= (select max(ts) - interval 1 hour from events)""",
)
def hourly_totals(spark, sf):
    folder = scratch(spark, "t4")
    table = T.run_available(T.hourly_totals(events(spark, sf), "ts", "value"), f"{folder}/out", f"{folder}/state")
    return table.select(F.col("hour_start").cast(NTZ).alias("hour_start"), "total", F.round("mean_value", 6).alias("mean_value"))


EARLY = "(event_type = 'error' and ts < timestamp '2024-01-10 00:00:00')"


@query(
    "T4_late_rows",
    f"""select * from (select date_trunc('hour', ts) as hour_start, count(*) as total, round(avg(value), 6) as mean_value
       from events where not {EARLY} group by 1)
       where hour_start + interval 1 hour <= (select max(ts) - interval 1 hour from events)""",
)
def late_rows(spark, sf):
    """Three deliveries under a watermark of an hour: the first misses some rows, the last holds nothing else.

    By then their hours are closed and written, so they are left out. Rows of the second delivery that are late by
    less than the hour count.
    """
    folder = scratch(spark, "t4-late")
    rows = data.table(spark, sf, "events")
    first = rows.filter("ts < timestamp_ntz'2024-01-15 00:00:00'")
    soon = F.col("ts") >= F.lit("2024-01-14 23:30:00").cast(NTZ)
    early = F.expr(EARLY.replace("timestamp '", "timestamp_ntz'"))
    for delivery in (
        first.filter(~early & ~(soon & F.expr("user_id % 2 = 0"))),
        rows.filter("ts >= timestamp_ntz'2024-01-15 00:00:00'").unionByName(first.filter(soon & F.expr("user_id % 2 = 0"))),
        first.filter(early),
    ):
        delivery.write.mode("append").parquet(f"{folder}/in")
        stream = T.hourly_totals(T.message_stream(spark, f"{folder}/in", rows.schema), "ts", "value")
        table = T.run_available(stream, f"{folder}/out", f"{folder}/state")
    return table.select(F.col("hour_start").cast(NTZ).alias("hour_start"), "total", F.round("mean_value", 6).alias("mean_value"))


#: Ends of the deliveries in time order.
DELIVERED = ["2024-01-06", "2024-01-12", "2024-01-18", "2024-01-24", "9999-01-01"]


@query(
    "T3_open_to_completed",
    """select r.* from rentals r join (select last_rental_start, bike_id, lead(last_rental_start) over (
        partition by bike_id order by last_rental_start) as newer from (select distinct last_rental_start, bike_id from pings)) n
       on r.last_rental_start = n.last_rental_start and r.bike_id = n.bike_id
       where newer < (select max(last_gps_time) - interval 1 day from pings)""",
)
def open_to_completed(spark, sf):
    """Five deliveries; messages of state 4 come up to half a day late, with the next one, and those of state 2 twice."""
    folder = scratch(spark, "t3-state")
    pings = settle(data.pings(spark, sf).select(*PING_KEY, "battery", "state_id"), "pings")
    start = F.lit("0001-01-01").cast(NTZ)
    held = F.lit(False)
    for day in DELIVERED:
        end = F.lit(day).cast(NTZ)
        late = (F.col("state_id") == 4) & (F.col("last_gps_time") >= end - F.expr("interval 12 hours"))
        now = (F.col("last_gps_time") >= start) & (F.col("last_gps_time") < end)
        rows = pings.filter((now & ~late) | held)
        rows.unionByName(pings.filter(now & ~late & (F.col("state_id") == 2))).write.mode("append").parquet(f"{folder}/in")
        ended = open_rentals.ended_rentals(T.message_stream(spark, f"{folder}/in", pings.schema))
        table = T.run_available(ended, f"{folder}/out", f"{folder}/state", open_rentals.CONF)
        start, held = end, now & late
    return table


def run_store(spark, sf, deliveries):
    """Deliver the messages in parts and let the stream process each part before the next arrives."""
    folder = scratch(spark, "rental-store")
    store = RentalStore.create(spark, f"{folder}/store")
    pings = data.pings(spark, sf).drop("bike_type", "state_id")
    full = data.pings(spark, sf)
    for condition in deliveries:
        full.filter(condition).drop("bike_type", "state_id").write.mode("append").parquet(f"{folder}/in")
        stream_rentals(T.message_stream(spark, f"{folder}/in", pings.schema), store, f"{folder}/state")
    return store


BY_TIME = [
    "last_gps_time < timestamp_ntz'2024-01-10 00:00:00'",
    "last_gps_time >= timestamp_ntz'2024-01-10 00:00:00' and last_gps_time < timestamp_ntz'2024-01-20 00:00:00'",
    "last_gps_time >= timestamp_ntz'2024-01-20 00:00:00'",
]


@query("T3_completed_rentals", "select * from rentals")
def completed_rentals(spark, sf):
    """Three deliveries in time order: the same rentals as the batch job over everything."""
    return run_store(spark, sf, BY_TIME).rentals


@query(
    "T5_late_coordinates",
    """select last_rental_start as date, bike_id, latitude, longitude from pings
       where (last_rental_start, bike_id) in (select last_rental_start, bike_id from ranked_rentals where rent_rank > 1)
       and (latitude is not null or longitude is not null) and (latitude <> 0 or longitude <> 0)""",
)
def late_coordinates(spark, sf):
    """Messages of state 4 come late: their rentals stay as they are, their coordinates are still added."""
    return run_store(spark, sf, ["state_id <> 4", "state_id = 4"]).coordinates


ON_TIME = "(select * from pings where state_id <> 4)"


@query(
    "T5_late_rentals",
    f"""with early as (select last_rental_start, bike_id, arg_min_null(battery, last_gps_time) as battery_start,
        case when count(*) > 1 then arg_max_null(battery, last_gps_time) end as battery_end,
        cast(greatest(datesub('minute', last_rental_start, max(last_gps_time)), 0) as integer) as duration
        from {ON_TIME} group by 1, 2),
        early_done as (select * from (select *, rank() over (partition by bike_id order by last_rental_start desc) as rk from early) where rk > 1),
        merged as (select * from pings p where not exists (select 1 from early_done d
         where d.last_rental_start = p.last_rental_start and d.bike_id = p.bike_id)),
        late as (select last_rental_start, bike_id, arg_min_null(battery, last_gps_time) as battery_start,
        case when count(*) > 1 then arg_max_null(battery, last_gps_time) end as battery_end,
        cast(greatest(datesub('minute', last_rental_start, max(last_gps_time)), 0) as integer) as duration
        from merged group by 1, 2),
        late_done as (select * from (select *, rank() over (partition by bike_id order by last_rental_start desc) as rk from late) where rk > 1)
        select * exclude (rk) from early_done union all select * exclude (rk) from late_done""",
)
def late_rentals(spark, sf):
    """Rentals finished before their late messages came keep the row they had."""
    return run_store(spark, sf, ["state_id <> 4", "state_id = 4"]).rentals
