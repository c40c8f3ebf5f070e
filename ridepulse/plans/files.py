"""Queries that write the given tables in a file format of the feeds and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import kpis as K
from ..operators import pings as P
from ..operators.features import calendar
from ..session import scratch
from ..sources import files as S
from ..sources import store
from ..streaming.landing import ingest_new_files
from . import data
from .catalog import query
from .oracle import SEASON, WEEKDAY


def degrees(column):
    return F.col(column).cast("decimal(11,7)")


def history(spark, sf):
    """Messages with all fifteen columns of the public export."""
    p = data.pings(spark, sf)
    return p.select(
        F.col("last_gps_time").alias("HarvestTime"),
        F.col("bike_id").alias("BikeID"),
        F.col("battery").alias("Battery"),
        F.concat(F.lit("B"), F.col("bike_id")).alias("BikeIdentifier"),
        F.col("bike_type").alias("BikeTypeName"),
        F.lit(1).alias("EBikeProfileID"),
        F.col("state_id").alias("EBikeStateID"),
        F.lit(True).alias("IsEBike"),
        F.lit(True).alias("IsMotor"),
        F.lit(True).alias("IsSmartLock"),
        F.col("last_gps_time").alias("LastGPSTime"),
        F.col("last_rental_start").alias("LastRentalStart"),
        degrees("latitude").alias("Latitude"),
        degrees("longitude").alias("Longitude"),
        F.lit(None).cast("string").alias("SpikeID"),
    )


def history_files(spark, sf):
    path = scratch(spark, "history")
    exact = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("HarvestTime", "LastGPSTime", "LastRentalStart")}
    history(spark, sf).withColumns(exact).write.option("header", True).csv(path)
    return S.read_history(spark, f"{path}/*.csv")


def plain(df):
    return df.withColumns({c: F.col(c).cast("double") for c in df.columns if c.lower() in ("latitude", "longitude")})


DEG = "cast(cast({c} as decimal(11,7)) as double) as {c}"
LAT, LON = DEG.format(c="latitude"), DEG.format(c="longitude")


@query(
    "S1_history_csv",
    f"select bike_id as bikeid, battery, bike_type as biketypename, state_id as ebikestateid, last_gps_time as lastgpstime, last_rental_start as lastrentalstart, {LAT}, {LON} from pings",
)
def history_csv(spark, sf):
    read = P.lower_columns(history_files(spark, sf))
    kept = ["bikeid", "battery", "biketypename", "ebikestateid", "lastgpstime", "lastrentalstart", "latitude", "longitude"]
    return plain(read.select(*kept))


@query(
    "P1_fleet_columns",
    f"select last_rental_start, bike_id, battery, last_gps_time, {LAT}, {LON} from pings where bike_type = 'DUB-General'",
)
def fleet_columns(spark, sf):
    """From the raw CSV export: the filter and the six wanted columns reach the scan."""
    raw = history_files(spark, sf).filter(F.col("BikeTypeName") == P.FLEET)
    return plain(
        raw.select(
            F.col("LastRentalStart").alias("last_rental_start"),
            F.col("BikeID").alias("bike_id"),
            F.col("Battery").alias("battery"),
            F.col("LastGPSTime").alias("last_gps_time"),
            F.col("Latitude").alias("latitude"),
            F.col("Longitude").alias("longitude"),
        )
    )


@query("P2_lower_columns", "select user_id as userid, event_type as eventtype, count(*) as messages from events group by 1, 2")
def lower_columns(spark, sf):
    events = data.table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("Messages"))
    return P.lower_columns(events.withColumnsRenamed({"user_id": "UserID", "event_type": "EventType"}))


@query(
    "A11_constant_columns",
    """select 'isebike' as column_name, 'true' as value, count(*) as n from pings union all
       select 'ismotor', 'true', count(*) from pings union all select 'issmartlock', 'true', count(*) from pings""",
)
def constant_columns(spark, sf):
    from ..operators.profile import by_each

    flags = ["isebike", "ismotor", "issmartlock"]
    found = by_each(P.lower_columns(history_files(spark, sf)), flags, [F.count("*").alias("n")])
    return found.select(F.col("factor").alias("column_name"), F.col("level").alias("value"), "n")


def ping_lines(df):
    """One JSON array per line, as many arrays as messages, so that nothing has to be gathered."""
    row = F.struct(
        F.date_format("last_rental_start", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("LastRentalStart"),
        F.col("bike_id").alias("BikeID"),
        F.col("battery").alias("Battery"),
        F.date_format("last_gps_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("LastGPSTime"),
        degrees("latitude").alias("Latitude"),
        degrees("longitude").alias("Longitude"),
        F.col("bike_type").alias("BikeTypeName"),
    )
    return df.select(F.to_json(F.array(row), {"ignoreNullFields": "false"}).alias("value"))


@query(
    "S2_pings_json",
    f"""select last_rental_start as LastRentalStart, bike_id as BikeID, battery as Battery, last_gps_time as LastGPSTime,
        {LAT.replace('as latitude', 'as Latitude')}, {LON.replace('as longitude', 'as Longitude')} from pings""",
)
def pings_json(spark, sf):
    path = scratch(spark, "pings-json")
    ping_lines(data.pings(spark, sf)).write.text(path)
    return plain(S.read_pings_json(spark, path, multi_line=False))


@query(
    "S3_weather_json",
    """select date, hour, case when hour between 7 and 11 then 'Morning' when hour between 12 and 17 then 'Afternoon'
       when hour between 18 and 22 then 'Evening' else 'Night' end as timesofday,
       case when hour = 3 then 0 else cast(floor(temp) as integer) end as temp, wdsp, case when hour = 4 then 0 else rhum end as rhum, rain,
       case when rain = 0 then 'no rain' when rain <= 0.3e0 then 'drizzle' when rain <= 0.5e0 then 'light rain'
       when rain <= 4 then 'moderate rain' else 'heavy rain' end as rainfall_intensity from weather""",
)
def weather_json(spark, sf):
    """Readings as padded text; at 3 the temperature has decimals and at 4 the humidity is missing."""
    w, path = data.weather(spark, sf), scratch(spark, "weather-json")
    pad = lambda c: F.concat(F.lit(" "), c.cast("string"), F.lit(" "))
    at = F.timestamp_add("HOUR", F.col("hour"), F.col("date").cast("timestamp_ntz"))
    w.select(
        F.when(F.col("hour") == 3, F.lit("7.5")).otherwise(pad(F.floor("temp"))).alias("temperature"),
        pad(F.col("wdsp")).alias("windSpeed"),
        F.when(F.col("hour") == 4, F.lit("-")).otherwise(pad(F.col("rhum"))).alias("humidity"),
        pad(F.col("rain")).alias("rainfall"),
        F.date_format("date", "dd-MM-yyyy").alias("date"),
        F.date_format(at, "HH:mm").alias("reportTime"),
    ).write.json(path)
    return S.read_weather_json(spark, path, multi_line=False)


@query("S4_weather_csv", "select hour as time, temp, cast(wdsp as double) as wdsp, rain from weather")
def weather_csv(spark, sf):
    path = scratch(spark, "weather-csv")
    w = data.weather(spark, sf)
    clock = F.concat(F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00"))
    w.select(
        clock.alias("Time (UTC)"), F.lit("Cloudy").alias("Report"), "temp", "wdsp", F.lit("-").alias("gust"),
        F.lit("SW").alias("dir"), "rain", F.lit(1013).alias("pressure"),
    ).write.option("header", True).csv(path)
    return S.read_weather_csv(spark, path)


@query("S5_station_hourly", "select date + to_hours(cast(hour as bigint)) as date, rain, temp, rhum, wdsp from weather")
def station_hourly(spark, sf):
    path = scratch(spark, "station-hourly")
    w = data.weather(spark, sf)
    at = F.timestamp_add("HOUR", F.col("hour"), F.col("date").cast("timestamp_ntz"))
    known = {"date": F.date_format(at, "dd-MMM-yyyy HH:mm"), **{c: F.col(c) for c in S.STATION_KEPT[1:]}}
    columns = [known.get(c, F.lit("0")).alias(c) for c in S.STATION_HOURLY_COLUMNS]
    w.select(*columns).write.option("header", True).csv(path)
    return S.read_station_hourly(spark, path)


@query(
    "S6_station_daily",
    """select strftime(date, '%d-%b-%Y') as date, cast(cast(max(temp) as decimal(9,1)) as varchar) as maxtp,
       cast(cast(min(temp) as decimal(9,1)) as varchar) as mintp, cast(cast(sum(rain) as decimal(9,1)) as varchar) as rain from weather group by weather.date""",
)
def station_daily(spark, sf):
    path = scratch(spark, "station-daily")
    tenth = lambda c: c.cast("decimal(9,1)")
    days = data.weather(spark, sf).groupBy("date").agg(
        tenth(F.max("temp")).alias("maxtp"), tenth(F.min("temp")).alias("mintp"), tenth(F.sum("rain")).alias("rain")
    )
    days.withColumn("date", F.date_format("date", "dd-MMM-yyyy")).write.option("header", True).csv(path)
    return S.read_station_daily(spark, path)


# Every distinct order date becomes a feed entry; only the days of the holiday list are national holidays.
HOLIDAY_NAMES = "case strftime(d, '%m%d') when '0101' then 'New Year' when '0317' then 'Patron Day' when '1225' then 'Christmas Day' when '1226' then 'Second Christmas Day' end"
HOLIDAYS = f"""select d as date, 'Ireland' as country, {HOLIDAY_NAMES} as name, 'National holiday' as type
        from (select distinct cast(o_orderdate as date) as d from orders) where {HOLIDAY_NAMES} is not null"""


def feed_days(spark, sf):
    days = data.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    key = F.month("d") * 100 + F.dayofmonth("d")
    name = F.lit(None).cast("string")
    for (month, day), label in data.HOLIDAY_DAYS.items():
        name = F.when(key == month * 100 + day, label).otherwise(name)
    national = name.isNotNull()
    return days.select(
        F.date_format("d", "yyyy-MM-dd").alias("iso"),
        F.coalesce(name, F.lit("Some day")).alias("name"),
        F.when(national, "National holiday").otherwise("Observance").alias("type"),
    )


@query("S7_holidays_json", HOLIDAYS)
def holidays_json(spark, sf):
    path = scratch(spark, "holidays")
    feed_days(spark, sf).select(
        F.concat("iso", F.lit("T00:00:00Z")).alias("date"), F.lit("Ireland").alias("country"), "name", "type"
    ).write.json(path)
    return S.read_holidays(spark, path, multi_line=False)


@query("S7_holiday_feed", HOLIDAYS)
def holiday_feed(spark, sf):
    path = scratch(spark, "holiday-feed")
    entry = F.struct(
        F.struct("iso").alias("date"),
        F.struct(F.lit("Ireland").alias("name")).alias("country"),
        "name",
        F.array(F.col("type"), F.lit("Any other type")).alias("type"),
    )
    feed_days(spark, sf).select(F.struct(F.array(entry).alias("holidays")).alias("response")).write.json(path)
    return S.read_holiday_feed(spark, path, multi_line=False)


@query(
    "F21_calendar_from_feed",
    f"""select date, {WEEKDAY} as dayofweek, date in (select date from ({HOLIDAYS})) as holiday,
        isodow(date) < 6 and date not in (select date from ({HOLIDAYS})) as working_day, {SEASON} as season
        from (select cast(unnest(generate_series(a, b - 1, interval 1 day)) as date) as date from
        (select cast(min(o_orderdate) as date) as a, cast(max(o_orderdate) as date) as b from orders))""",
)
def calendar_from_feed(spark, sf):
    """The calendar with the holidays of the feed's file, whatever days they are."""
    span = data.table(spark, sf, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("end_day")
    )
    return calendar(span, holidays_json(spark, sf))


def forecast_files(spark, sf):
    """A forecast document: the state of every hour, and the rain of every hour but those at 2."""
    path = scratch(spark, "forecast-xml")
    w = data.weather(spark, sf)
    at = F.timestamp_add("HOUR", F.col("hour"), F.col("date").cast("timestamp_ntz"))
    zulu = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    state = F.struct(
        F.struct(F.col("temp").alias("_value")).alias("temperature"),
        F.struct((F.col("wdsp") / 10).alias("_mps")).alias("windSpeed"),
        F.struct(F.col("rhum").cast("double").alias("_value")).alias("humidity"),
        F.lit(None).cast("struct<_value: double>").alias("precipitation"),
    )
    interval = F.struct(
        F.lit(None).cast("struct<_value: double>").alias("temperature"),
        F.lit(None).cast("struct<_mps: double>").alias("windSpeed"),
        F.lit(None).cast("struct<_value: double>").alias("humidity"),
        F.struct(F.col("rain").alias("_value")).alias("precipitation"),
    )
    hour = F.date_format(at, zulu)
    before = F.date_format(F.timestamp_add("HOUR", F.lit(-1), at), zulu)
    states = w.filter("hour <> 23").select(hour.alias("_from"), hour.alias("_to"), state.alias("location"))
    rain = w.filter("hour <> 2").select(before.alias("_from"), hour.alias("_to"), interval.alias("location"))
    (
        states.unionByName(rain)
        .write.format("xml")
        .option("rootTag", "product")
        .option("rowTag", "time")
        .option("valueTag", "_text")
        .save(path)
    )
    return S.read_forecast_xml(spark, path)


STATES = "date + to_hours(cast(hour as bigint)) as at_time"


@query(
    "S8_forecast_xml",
    f"""select {STATES}, date + to_hours(cast(hour as bigint)) as from_time, temp, cast(rhum as double) as rhum, wdsp / 10e0 as wind_ms,
        cast(null as double) as rain from weather where hour <> 23 union all
        select {STATES}, date + to_hours(cast(hour - 1 as bigint)), null, null, null, rain from weather where hour <> 2""",
)
def forecast_xml(spark, sf):
    return forecast_files(spark, sf)


@query(
    "J8_combined_forecast",
    f"""select {STATES}, temp, cast(rhum as double) as rhum, wdsp / 10e0 as wind_ms, case when hour <> 2 then rain end as rain
        from weather where hour <> 23""",
)
def combined_forecast(spark, sf):
    return S.combine_forecast(forecast_files(spark, sf))


@query(
    "S9_ingest_new_files",
    f"select last_rental_start, bike_id, battery, last_gps_time, {LAT}, {LON} from pings",
)
def ingest(spark, sf):
    """Two deliveries and three runs: each file is stored once, and a run without new files adds nothing."""
    root = scratch(spark, "ingest")
    run = lambda: ingest_new_files(
        spark, f"{root}/landing/*", f"{root}/table", f"{root}/errors", f"{root}/checkpoint", multi_line=False
    )
    pings = data.pings(spark, sf)
    ping_lines(pings.filter("state_id <= 2")).write.text(f"{root}/landing/first")
    run()
    ping_lines(pings.filter("state_id > 2")).write.text(f"{root}/landing/second")
    run()
    run()
    stored = spark.read.schema(S.PING_SCHEMA).parquet(f"{root}/table/*")
    return plain(
        stored.select(
            F.col("LastRentalStart").alias("last_rental_start"),
            F.col("BikeID").alias("bike_id"),
            F.col("Battery").alias("battery"),
            F.col("LastGPSTime").alias("last_gps_time"),
            F.col("Latitude").alias("latitude"),
            F.col("Longitude").alias("longitude"),
        )
    )


@query("S10_land_if_absent", "select * from trips")
def land_if_absent(spark, sf):
    """The second landing under the same name changes nothing."""
    trips, path = data.trips(spark, sf), scratch(spark, "landing")
    store.land_if_absent(trips, path)
    store.land_if_absent(trips.filter("duration > 60"), path)
    return spark.read.parquet(path)


@query(
    "S12_export_json",
    "select battery_start, count(*) as n from trips where battery_start <> 0 group by 1",
)
def export_json(spark, sf):
    path = scratch(spark, "export-json")
    trips = data.trips(spark, sf)
    levels = trips.filter("battery_start <> 0").groupBy("battery_start").agg(F.count("*").alias("n"))
    store.save_json(levels, path)
    return spark.read.schema("battery_start INT, n BIGINT").json(path)


@query(
    "S12_export_metrics",
    """select count(*) as total_rentals, round(avg(duration), 6) as average_duration from trips
       where cast(start as date) between (select cast(max(start) as date) from trips) - interval 3 month and (select cast(max(start) as date) from trips)""",
)
def export_metrics(spark, sf):
    path = scratch(spark, "export-metrics")
    trips = data.trips(spark, sf)
    store.save_json(K.quarter_figures(trips, K.last_day(trips, "start")), path)
    read = spark.read.schema("total_rentals BIGINT, average_duration DOUBLE").json(path)
    return read.withColumn("average_duration", F.round("average_duration", 6))


@query(
    "S13_export_csv",
    """select strftime(start, '%Y-%m-%d %H:%M') as start, cast(bike_id as varchar) as bike_id,
       coalesce(cast(battery_start as varchar), 'NULL') as battery_start, cast(duration as varchar) as duration from trips""",
)
def export_csv(spark, sf):
    """Read back as text, so that the marker for nulls shows."""
    path = scratch(spark, "export-csv")
    trips = data.trips(spark, sf).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm"))
    store.save_csv(trips, path, ["start", "bike_id", "battery_start", "duration"])
    return spark.read.option("header", True).csv(path)


@query(
    "S14_run_log",
    """select timestamp '2024-01-31 06:00:00' as run_at, cast(count(*) filter (where rent_rank > 1) as bigint) as processed,
       cast(0 as bigint) as errors from ranked_rentals union all
       select timestamp '2024-02-01 06:00:00', 0, 0""",
)
def run_log(spark, sf):
    """Two daily runs: the second finds only open rentals left."""
    from ..operators.rentals import process_batch
    from ..session import settle

    path = scratch(spark, "run-log")
    first = process_batch(settle(data.pings(spark, sf), "pings"))
    store.log_run(spark, path, "2024-01-31 06:00:00", first.log)
    left = settle(first.remaining, "remaining")
    store.log_run(spark, path, "2024-02-01 06:00:00", process_batch(left).log)
    return spark.read.parquet(path)
