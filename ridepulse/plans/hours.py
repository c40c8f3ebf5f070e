"""Queries on the hourly fact, the calendar, the scalar functions and the dashboard figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import text as T
from ..functions import weather as W
from ..functions.ordering import domain_ordinal
from ..functions.sql import register_sql_functions
from ..operators import features as X
from ..operators import hourly as H
from ..operators import kpis as K
from ..operators import profile as P
from . import data
from .catalog import query
from .oracle import BFT, PERIOD, RAIN, SEASON, WEEKDAY

TRAIN = ("2021-03-01", "2022-02-28")
TEST = ("2022-03-01", "2022-04-30")
FEATURE_COLUMNS = [
    "date", "hour", "temp", "rhum", "wdsp", "rain", "demand", "holiday", "dayofweek_n", "dayofweek", "working_day",
    "season", "peak", "timesofday", "rainfall_intensity", "wind_bft", "wind_speed_group", "temp_r",
    "temp_bin", "rhum_bin",
]


@query("J1_rentals_with_weather", "select * exclude (start), start from trip_weather")
def rentals_with_weather(spark, sf):
    return H.rentals_and_weather(data.trips(spark, sf), data.weather(spark, sf), "start")


@query(
    "J1_pings_with_weather",
    """select g.last_rental_start, g.bike_id, w.* from (select distinct last_rental_start, bike_id from clean_pings) g
       join ping_weather w on cast(g.last_rental_start as date) = w.date and hour(g.last_rental_start) = w.hour""",
)
def ping_rentals_with_weather(spark, sf):
    rentals = data.cleaned(spark, sf).select("last_rental_start", "bike_id").distinct()
    return H.rentals_and_weather(rentals, data.ping_weather(spark, sf), "last_rental_start")


@query("J2_hours_with_rentals", "select w.*, demand from weather w join hourly h on w.date = h.date and w.hour = h.hour")
def hours_with_rentals(spark, sf):
    return H.hours_with_rentals(data.hourly(spark, sf), data.weather(spark, sf))


@query("J3_all_hours", "select * from fact")
def all_hours(spark, sf):
    return data.fact(spark, sf)


@query(
    "J6_daily_series",
    """select d.date, daily_rentals, holiday, dayofweek, working_day, season from daily d left join
       (select distinct date, holiday, dayofweek, working_day, season from features) f on d.date = f.date""",
)
def daily_series(spark, sf):
    return H.daily_series(data.features(spark, sf))


@query(
    "J7_outlier_hours_with_day",
    """select f.date, hour, demand as demand_hour, daily_rentals as demand_day from fact f
       left join daily d on f.date = d.date where demand > 4""",
)
def outlier_hours(spark, sf):
    fact = data.fact(spark, sf)
    hours = fact.filter("demand > 4").select("date", "hour", F.col("demand").alias("demand_hour"))
    return hours.join(H.daily_totals(fact).withColumnRenamed("daily_rentals", "demand_day"), "date", "left")


@query(
    "J9_holiday_flag",
    "select trip_id, cast(start as date) in (select date from holidays) as holiday from trips",
)
def holiday_flag(spark, sf):
    dated = data.trips(spark, sf).select("trip_id", F.to_date("start").alias("date"))
    return X.with_holiday_flag(dated, data.holidays(spark)).drop("date")


@query(
    "U1_train_and_test_days",
    f"""select 'train' as part, date, daily_rentals from daily where date between '{TRAIN[0]}' and '{TRAIN[1]}'
        union all select 'test', date, daily_rentals from daily where date between '{TEST[0]}' and '{TEST[1]}'""",
)
def train_and_test_days(spark, sf):
    daily = H.daily_totals(data.fact(spark, sf))
    train = H.sample_dates(daily, *TRAIN).withColumn("part", F.lit("train"))
    return train.unionByName(H.sample_dates(daily, *TEST).withColumn("part", F.lit("test")))


@query("P6_train_sample", f"select * from fact where date between '{TRAIN[0]}' and '{TRAIN[1]}'")
def train_sample(spark, sf):
    return H.sample_dates(data.fact(spark, sf), *TRAIN)


@query("P6_test_sample", f"select * from fact where date between '{TEST[0]}' and '{TEST[1]}'")
def test_sample(spark, sf):
    return H.sample_dates(data.fact(spark, sf), *TEST)


@query(
    "P7_station_dates",
    """select * from (select date + to_hours(cast(hour as bigint)) as at_time, rain, temp, rhum, wdsp from weather)
       where at_time between timestamp '2021-09-18' and timestamp '2021-12-31'""",
)
def station_dates(spark, sf):
    """A closed interval of timestamps: of the last day only midnight passes."""
    hours = data.weather(spark, sf).select(C.at_hour(F.col("date"), F.col("hour")).alias("at_time"), "rain", "temp", "rhum", "wdsp")
    return hours.filter(F.col("at_time").between(F.lit("2021-09-18").cast("timestamp_ntz"), F.lit("2021-12-31").cast("timestamp_ntz")))


ASOF = "(select cast(max(start) as date) from trips)"


@query(
    "P8_trailing_periods",
    f"""select trip_id, cast(start as date) between {ASOF} - interval 3 month and {ASOF} as current_quarter,
        cast(start as date) between {ASOF} - interval 6 month and {ASOF} - interval 3 month as previous_quarter,
        cast(start as date) between {ASOF} - 30 and {ASOF} as last_30_days from trips""",
)
def trailing_periods(spark, sf):
    trips = data.trips(spark, sf)
    asof = K.last_day(trips, "start")
    return trips.select(
        "trip_id",
        K.in_last_months(F.col("start"), asof, 3).alias("current_quarter"),
        K.in_last_months(F.col("start"), asof, 6, 3).alias("previous_quarter"),
        K.in_last_days(F.col("start"), asof, 30).alias("last_30_days"),
    )


@query(
    "P9_initial_battery",
    f"""select battery_start from trips where cast(start as date) between {ASOF} - interval 3 month and {ASOF}
        and battery_start is not null and battery_start <> 0""",
)
def initial_battery(spark, sf):
    trips = data.trips(spark, sf)
    return K.initial_battery(trips, K.last_day(trips, "start"))


@query("P10_outlier_hours", "select date, hour, demand, demand > 4 as outlier from fact")
def threshold(spark, sf):
    return data.fact(spark, sf).select("date", "hour", "demand", (F.col("demand") > 4).alias("outlier"))


@query(
    "P11_subsets",
    """select count(*) filter (where demand > 0) as positive, count(*) filter (where demand = 0) as zero from fact""",
)
def subsets(spark, sf):
    return data.fact(spark, sf).agg(F.count_if(F.col("demand") > 0).alias("positive"), F.count_if(F.col("demand") == 0).alias("zero"))


@query(
    "P11_positive_durations",
    "select trip_id, battery_start, duration from trips where duration > 0",
)
def positive_durations(spark, sf):
    return data.trips(spark, sf).filter("duration > 0").select("trip_id", "battery_start", "duration")


@query(
    "P12_holiday_is_no_working_day",
    """select date, holiday, isodow(date) < 6 as weekday, working_day, greatest(demand - 2, 0) as clipped from features""",
)
def conditional_update(spark, sf):
    f = data.features(spark, sf)
    return f.select(
        "date",
        "holiday",
        C.is_working_day(F.col("date")).alias("weekday"),
        "working_day",
        F.greatest(F.col("demand") - 2, F.lit(0)).alias("clipped"),
    )


@query(
    "P13_day_lookup",
    """select hour, rain, temp, rhum, wdsp, season, timesofday, working_day, demand from features
       where date in ('2021-03-07', '2021-04-25')""",
)
def day_lookup(spark, sf):
    days = data.features(spark, sf).filter(F.col("date").isin("2021-03-07", "2021-04-25"))
    return days.select("hour", "rain", "temp", "rhum", "wdsp", "season", "timesofday", "working_day", "demand")


# -- aggregates of the dashboard ---------------------------------------------------------------------------------------


@query("A5_hourly_counts", "select * from hourly")
def hourly_counts(spark, sf):
    return data.hourly(spark, sf)


@query(
    "A5_hourly_counts_of_pings",
    """select cast(last_rental_start as date) as date, cast(hour(last_rental_start) as integer) as hour, count(*) as demand
       from (select distinct last_rental_start, bike_id from clean_pings) group by 1, 2""",
)
def hourly_counts_of_pings(spark, sf):
    rentals = data.cleaned(spark, sf).select("last_rental_start", "bike_id").distinct()
    return H.hourly_counts(rentals, "last_rental_start")


HOURLY_TOTALS = f"""select date_rental, {PERIOD} as timeofday, dayname(date_rental) as day_of_week, total_rentals, hourly_avg_duration
        from (select date_trunc('hour', start) as date_rental, cast(hour(date_trunc('hour', start)) as integer) as hour,
        count(*) as total_rentals, round(avg(duration), 2) as hourly_avg_duration from trips group by 1, 2)"""


@query("A6_hourly_totals", HOURLY_TOTALS)
def hourly_totals(spark, sf):
    return K.hourly_totals(data.trips(spark, sf))


@query(
    "A6_hourly_totals_last_quarter",
    f"select * from ({HOURLY_TOTALS}) where cast(date_rental as date) between {ASOF} - interval 3 month and {ASOF}",
)
def hourly_totals_last_quarter(spark, sf):
    trips = data.trips(spark, sf)
    totals = K.hourly_totals(trips)
    return totals.filter(K.in_last_months(F.col("date_rental"), K.last_day(trips, "start"), 3))


@query(
    "A7_kpi_row",
    f"""select total_rentals, previous_rentals, total_rentals - previous_rentals as rentals_change, average_duration, previous_duration,
        average_duration - previous_duration as duration_change from (select
        count(*) filter (where d between a - interval 3 month and a) as total_rentals,
        count(*) filter (where d between a - interval 6 month and a - interval 3 month) as previous_rentals,
        avg(duration) filter (where d between a - interval 3 month and a) as average_duration,
        avg(duration) filter (where d between a - interval 6 month and a - interval 3 month) as previous_duration
        from (select cast(start as date) as d, duration, {ASOF} as a from trips))""",
)
def kpi_row(spark, sf):
    trips = data.trips(spark, sf)
    return K.quarter_figures(trips, K.last_day(trips, "start"))


@query(
    "A7_last_30_days",
    f"""select avg(duration) as average_duration, count(*) as total_rentals from trips
        where cast(start as date) between {ASOF} - 30 and {ASOF}""",
)
def last_30_days(spark, sf):
    trips = data.trips(spark, sf)
    recent = trips.filter(K.in_last_days(F.col("start"), K.last_day(trips, "start"), 30))
    return recent.agg(F.avg("duration").alias("average_duration"), F.count("*").alias("total_rentals"))


for _label, _column, _sql in (
    ("day_of_week", "day_of_week", "day_of_week"),
    ("period", "timeofday", "timeofday"),
    ("season", "season", SEASON),
):

    @query(
        f"A8_share_by_{_label}",
        f"""select *, total_rentals / sum(total_rentals) over () as share from (
            select {_sql} as {_column}, cast(sum(total_rentals) as bigint) as total_rentals
            from (select *, cast(date_rental as date) as date from ({HOURLY_TOTALS})) group by 1)""",
    )
    def share(spark, sf, by=_column):
        return K.share_by(K.hourly_totals(data.trips(spark, sf)), by)

    @query(
        f"A9_mean_of_hourly_duration_by_{_label}",
        f"""select {_sql} as {_column}, round(avg(hourly_avg_duration), 6) as avg_duration
            from (select *, cast(date_rental as date) as date from ({HOURLY_TOTALS})) group by 1""",
    )
    def mean_duration(spark, sf, by=_column):
        means = K.mean_hourly_duration(K.hourly_totals(data.trips(spark, sf)), by)
        return means.withColumn("avg_duration", F.round("avg_duration", 6))


BUCKET = """case when battery_start >= 0 and battery_start < 30 then '< 30%' when battery_start >= 30 and battery_start < 50 then '30% - 50%'
        when battery_start >= 50 and battery_start < 80 then '50% - 80%' when battery_start >= 80 and battery_start < 100 then '> 80%' end"""


@query(
    "A10_battery_status",
    f"""select l.battery_status, counts, per, cast(round(per * 100, 2) as varchar) || '%' as per100
        from (values ('< 30%'), ('30% - 50%'), ('50% - 80%'), ('> 80%')) l(battery_status) left join (
        select *, counts / sum(counts) over () as per from (
        select {BUCKET} as battery_status, count(*) as counts from trips where duration > 0 group by 1)
        where battery_status is not null) c on c.battery_status = l.battery_status""",
)
def battery_status(spark, sf):
    return P.battery_status(data.trips(spark, sf).filter("duration > 0"), "battery_start")


@query(
    "A27_weather_completeness",
    "select date, count(*) as processed, 24 - count(*) as errors from weather where rain <= 5.5e0 group by date",
)
def weather_completeness(spark, sf):
    """Hours recorded per day and hours missing; readings above 5.5 mm are taken as lost here."""
    recorded = data.weather(spark, sf).filter(F.col("rain") <= 5.5)
    days = data.weather(spark, sf).select("date").distinct()
    return K.completeness(recorded, days)


# -- order, top rows ---------------------------------------------------------------------------------------------------


@query("O1_busiest_hours", "select date, hour, demand from fact order by demand desc, date, hour limit 10")
def busiest_hours(spark, sf):
    return data.fact(spark, sf).orderBy(F.col("demand").desc(), "date", "hour").limit(10).select("date", "hour", "demand")


@query(
    "O3_domain_order",
    """select dayofweek, timesofday, season, wind_speed_group, cast(isodow(date) - 1 as integer) as day_order,
       case season when 'Winter' then 0 when 'Spring' then 1 when 'Summer' then 2 else 3 end as season_order,
       case wind_speed_group when 'Calm / Light Breeze' then 0 when 'Breeze' then 1 when 'Moderate Breeze' then 2
        when 'Strong Breeze / Near Gale' then 3 else 4 end as wind_order,
       case timesofday when 'Morning' then 0 when 'Afternoon' then 1 when 'Evening' then 2 else 3 end as period_order,
       case rainfall_intensity when 'no rain' then 0 when 'drizzle' then 1 when 'light rain' then 2 when 'moderate rain' then 3 else 4 end as rain_order,
       cast(sum(demand) as bigint) as demand from features group by all""",
)
def domain_order(spark, sf):
    f = data.features(spark, sf)
    return (
        f.groupBy("dayofweek", "timesofday", "season", "wind_speed_group", "rainfall_intensity")
        .agg(F.sum("demand").alias("demand"))
        .select(
            "dayofweek",
            "timesofday",
            "season",
            "wind_speed_group",
            domain_ordinal("dayofweek").alias("day_order"),
            domain_ordinal("season").alias("season_order"),
            domain_ordinal("wind_speed_group").alias("wind_order"),
            domain_ordinal("timesofday").alias("period_order"),
            domain_ordinal("rainfall_intensity").alias("rain_order"),
            "demand",
        )
        .orderBy("season_order", "day_order", "period_order", "wind_order", "rain_order")
    )


@query(
    "O4_drop_newest_hours",
    """select at_time, demand from (select *, row_number() over (order by at_time desc) as rn
       from (select date + to_hours(cast(hour as bigint)) as at_time, demand from fact)) where rn > 25""",
)
def drop_newest_hours(spark, sf):
    from ..operators.rentals import latest_dropped

    hours = data.fact(spark, sf).select(C.at_hour(F.col("date"), F.col("hour")).alias("at_time"), "demand")
    return latest_dropped(hours, "at_time", 25)


@query("O5_slice_of_days", "select date, daily_rentals from daily order by date limit 8 offset 295")
def slice_of_days(spark, sf):
    return H.daily_totals(data.fact(spark, sf)).orderBy("date").offset(295).limit(8)


# -- scalar functions --------------------------------------------------------------------------------------------------


@query("F2_time_of_day", f"select trip_id, {PERIOD} as timesofday from (select *, hour(start) as hour from trips)")
def time_of_day(spark, sf):
    return data.trips(spark, sf).select("trip_id", C.time_of_day(F.hour("start")).alias("timesofday"))


@query("F3_season", f"select trip_id, {SEASON} as season from (select trip_id, cast(start as date) as date from trips)")
def season(spark, sf):
    return data.trips(spark, sf).select("trip_id", C.season(F.to_date("start")).alias("season"))


@query(
    "F4_rain_level",
    f"select date, hour, {RAIN} as level from (select * replace (case when hour = 5 then null else rain - 0.3e0 end as rain) from weather)",
)
def rain_level(spark, sf):
    """Shifted so that negative and missing readings occur."""
    w = data.weather(spark, sf).withColumn("rain", F.when(F.col("hour") != 5, F.col("rain") - 0.3))
    return w.select("date", "hour", W.rain_level(F.col("rain")).alias("level"))


@query(
    "F5_wind_units",
    "select date, hour, wdsp * 0.514e0 as ms, wdsp * (3.6e0 / 1.852e0) as knots from weather",
)
def wind_units(spark, sf):
    w = F.col("wdsp")
    return data.weather(spark, sf).select("date", "hour", W.knots_to_ms(w).alias("ms"), W.ms_to_knots(w).alias("knots"))


@query("F6_beaufort", f"select date, hour, cast({BFT} as integer) as bft from (select *, wdsp * 0.6e0 as ms from weather)")
def beaufort(spark, sf):
    return data.weather(spark, sf).select("date", "hour", W.beaufort(F.col("wdsp") * 0.6).alias("bft"))


@query("F7_wind_group", "select wind_bft, wind_speed_group, count(*) as n from features group by 1, 2")
def wind_group(spark, sf):
    return data.features(spark, sf).groupBy("wind_bft", "wind_speed_group").agg(F.count("*").alias("n"))


@query(
    "F8_round_half_away",
    """select date, hour, cast(round(v) as integer) as away, cast(round_even(v, 0) as integer) as even
       from (select date, hour, (wdsp - 30) / 2e0 as v from weather)""",
)
def round_half_away(spark, sf):
    v = (F.col("wdsp") - 30) / F.lit(2.0)
    return data.weather(spark, sf).select("date", "hour", W.round_half_away(v).alias("away"), W.round_half_even(v).alias("even"))


@query(
    "F9_weekday",
    f"select trip_id, {WEEKDAY} as weekday, dayname(date) as name from (select trip_id, cast(start as date) as date from trips)",
)
def weekday(spark, sf):
    d = F.to_date("start")
    return data.trips(spark, sf).select("trip_id", C.weekday_number(d).alias("weekday"), C.weekday_name(d).alias("name"))


@query(
    "F10_working_day",
    """select trip_id, isodow(start) < 6 as weekday, isodow(start) < 6 and cast(start as date) not in (select date from holidays) as working_day
       from trips""",
)
def working_day(spark, sf):
    dated = data.trips(spark, sf).select("trip_id", F.to_date("start").alias("date"))
    flagged = X.with_holiday_flag(dated, data.holidays(spark))
    d = F.col("date")
    return flagged.select("trip_id", C.is_working_day(d).alias("weekday"), C.is_working_day(d, F.col("holiday")).alias("working_day"))


@query(
    "F11_peak",
    "select trip_id, isodow(start) < 6 and (hour(start) between 6 and 10 or hour(start) between 15 and 19) as peak from trips",
)
def peak(spark, sf):
    return data.trips(spark, sf).select("trip_id", C.is_peak(F.hour("start"), F.to_date("start")).alias("peak"))


@query(
    "F12_date_parts",
    """select trip_id, cast(start as date) as date, cast(hour(start) as integer) as hour, cast(day(start) as integer) as day,
       cast(month(start) as integer) as month, cast(year(start) as integer) as year, strftime(start, '%Y-%m-%d %H:00:00') as hour_key
       from trips""",
)
def date_parts(spark, sf):
    parts = [column.alias(name) for name, column in C.date_parts(F.col("start")).items()]
    return data.trips(spark, sf).select("trip_id", *parts, C.hour_key(F.col("start")).alias("hour_key"))


@query("F13_date_and_hour", "select date + to_hours(cast(hour as bigint)) as period, demand from fact")
def date_and_hour(spark, sf):
    return data.fact(spark, sf).select(C.at_hour(F.col("date"), F.col("hour")).alias("period"), "demand")


@query(
    "F14_parsed_text",
    """select trip_id, cast(start as date) as from_text, cast(start as date) as from_name, cast(hour(start) as integer) as from_clock from trips""",
)
def parsed_text(spark, sf):
    d = F.col("start")
    text = F.concat(F.lit(" "), F.date_format(d, "dd-MM-yyyy"), F.lit(" "))
    name = F.concat(F.lit("folder/weather_"), F.date_format(d, "yyyy-MM-dd"), F.lit(".json"))
    return data.trips(spark, sf).select(
        "trip_id",
        T.day_month_year(text).alias("from_text"),
        T.date_from_file_name(name).alias("from_name"),
        T.hour_of_clock(F.date_format(d, "HH:mm")).alias("from_clock"),
    )


DIRTY = """case trip_id % 4 when 0 then ' ' || duration || ' ' when 1 then duration || '.5' when 2 then '-' || duration else '-' end"""


@query(
    "F15_force_integer",
    f"""select trip_id, case when regexp_full_match(trim(s), '[+-]?[0-9]+') then cast(trim(s) as integer) else 0 end as value
        from (select trip_id, {DIRTY} as s from trips)""",
)
def force_integer(spark, sf):
    m, d = F.col("trip_id") % 4, F.col("duration").cast("string")
    dirty = (
        F.when(m == 0, F.concat(F.lit(" "), d, F.lit(" ")))
        .when(m == 1, F.concat(d, F.lit(".5")))
        .when(m == 2, F.concat(F.lit("-"), d))
        .otherwise("-")
    )
    return data.trips(spark, sf).select("trip_id", T.force_integer(dirty).alias("value"))


@query(
    "F16_minutes_as_text",
    """select trip_id, cast(cast(floor(m / 60) as integer) as varchar) || 'h ' ||
       cast(cast(round(m - 60 * floor(m / 60)) as integer) as varchar) || 'm' as text,
       (case when m >= 1440 then cast(cast(floor(m / 1440) as integer) as varchar) || case when m < 2880 then ' day, ' else ' days, ' end else '' end) ||
       cast(cast(floor((m % 1440) / 60) as integer) as varchar) || ':' || lpad(cast(cast(floor(m % 60) as integer) as varchar), 2, '0') || ':' ||
       lpad(cast(cast(floor((m * 60) % 60) as integer) as varchar), 2, '0') as clock
       from (select trip_id, duration * 25 + 0.25e0 as m from trips)""",
)
def minutes_as_text(spark, sf):
    m = F.col("duration") * 25 + 0.25
    return data.trips(spark, sf).select("trip_id", T.hours_minutes(m).alias("text"), T.clock_string(m).alias("clock"))


@query(
    "F17_month_name",
    "select trip_id, strftime(start, '%b') as month from trips",
)
def month_name(spark, sf):
    return data.trips(spark, sf).select("trip_id", C.month_name(F.month("start")).alias("month"))


@query(
    "F18_percent_string",
    "select trip_id, cast(round(duration / 180e0 * 100, 2) as varchar) || '%' as pct from trips",
)
def percent_string(spark, sf):
    return data.trips(spark, sf).select("trip_id", T.percent_string(F.col("duration") / F.lit(180.0)).alias("pct"))


@query("F19_high_demand", "select date, hour, demand > 8 as high_demand, demand > 3 as busy from fact")
def high_demand(spark, sf):
    d = F.col("demand")
    return data.fact(spark, sf).select("date", "hour", W.is_high_demand(d).alias("high_demand"), W.is_high_demand(d, 3).alias("busy"))


@query(
    "F20_comfort_flags",
    """select date, hour, case when temp + 10 > 27 and wdsp < 30 then 1 else 0 end as ideal,
       case when working_day and rhum >= 60 then 1 else 0 end as sticky,
       round_even(wdsp * 0.2e0 + rhum * 0.8e0, 0) as blended from features""",
)
def comfort_flags(spark, sf):
    return data.features(spark, sf).select(
        "date",
        "hour",
        W.is_ideal(F.col("temp") + 10, F.col("wdsp")).alias("ideal"),
        W.is_sticky(F.col("working_day"), F.col("rhum")).alias("sticky"),
        W.blend(F.col("wdsp"), F.col("rhum")).alias("blended"),
    )


@query(
    "F21_calendar",
    f"""select date, {WEEKDAY} as dayofweek, date in (select date from holidays) as holiday,
        isodow(date) < 6 and date not in (select date from holidays) as working_day, {SEASON} as season
        from (select cast(unnest(generate_series(a, b - 1, interval 1 day)) as date) as date from
        (select cast(min(o_orderdate) as date) as a, cast(max(o_orderdate) as date) as b from orders))""",
)
def calendar(spark, sf):
    span = data.table(spark, sf, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("end_day")
    )
    return X.calendar(span, data.holidays(spark))


@query(
    "F22_weather_rows",
    f"select date, hour, {PERIOD} as timesofday, temp, wdsp, rhum, rain, {RAIN} as rainfall_intensity from weather",
)
def weather_rows(spark, sf):
    return X.weather_rows(data.weather(spark, sf))


@query(
    "F23_forecast_features",
    f"""select at_time, date, hour, temp, rhum, wind_ms, rain, wind_ms * (3.6e0 / 1.852e0) as wdsp, {WEEKDAY} as dayofweek_n,
        dayname(date) as dayofweek, isodow(date) < 6 as working_day, {PERIOD} as timesofday, {SEASON} as season,
        {RAIN} as rainfall_intensity from (select date + to_hours(cast(hour as bigint)) as at_time, date, hour, temp, rhum,
        wdsp * 0.514e0 as wind_ms, rain from weather)""",
)
def forecast_features(spark, sf):
    points = data.weather(spark, sf).select(
        C.at_hour(F.col("date"), F.col("hour")).alias("at_time"),
        "temp",
        "rhum",
        W.knots_to_ms(F.col("wdsp")).alias("wind_ms"),
        "rain",
    )
    return X.forecast_features(points)


@query("F24_hourly_features", f"select {', '.join(FEATURE_COLUMNS)} from binned")
def hourly_features(spark, sf):
    return data.binned_features(spark, sf).select(*FEATURE_COLUMNS)


@query(
    "F24_rental_features",
    "select trip_id, duration, holiday, dayofweek, working_day, season, peak, timesofday, rainfall_intensity, wind_bft, wind_speed_group, temp_r from trip_features",
)
def rental_features(spark, sf):
    columns = ["holiday", "dayofweek", "working_day", "season", "peak", "timesofday", "rainfall_intensity", "wind_bft"]
    return data.rentals_with_weather(spark, sf).select("trip_id", "duration", *columns, "wind_speed_group", "temp_r")


@query(
    "SQL_functions",
    f"""select bike_id, last_rental_start, cast(greatest(datesub('minute', last_rental_start, max(last_gps_time)), 0) as integer) as minutes,
        max({PERIOD}) as timesofday from (select *, hour(last_rental_start) as hour from pings) group by 1, 2""",
)
def sql_functions(spark, sf):
    register_sql_functions(spark)
    data.pings(spark, sf).createOrReplaceTempView("ridepulse_pings")
    return spark.sql(
        """SELECT bike_id, last_rental_start, fn_rental_duration(max(last_gps_time), last_rental_start) AS minutes,
           fn_timesofday(last_rental_start) AS timesofday FROM ridepulse_pings GROUP BY bike_id, last_rental_start"""
    )
