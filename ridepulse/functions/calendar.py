"""Date and time expressions. Every function takes and returns Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def rental_duration(last_gps: Column, start: Column) -> Column:
    """Whole minutes between the rental start and the last GPS message, never negative."""
    minutes = F.timestamp_diff("MINUTE", start, last_gps)
    return F.greatest(minutes, F.lit(0)).cast("int")


def duration_minutes(last_gps: Column, start: Column) -> Column:
    """The same duration with its fraction of a minute, never negative."""
    micros = F.timestamp_diff("MICROSECOND", start, last_gps)
    return F.greatest(micros / F.lit(60e6), F.lit(0.0))


def time_of_day(hour: Column) -> Column:
    """Night before 7 and from 23, Morning to 11, Afternoon to 17, Evening to 22."""
    return (
        F.when((hour >= 7) & (hour < 12), "Morning")
        .when((hour >= 12) & (hour < 18), "Afternoon")
        .when((hour >= 18) & (hour < 23), "Evening")
        .when(hour.isNotNull(), "Night")
    )


def season(date: Column) -> Column:
    """Season by fixed day of the year; 21 March, 21 June, 23 September and 21 December start one."""
    day = F.month(date) * 100 + F.dayofmonth(date)
    return (
        F.when(day.between(321, 620), "Spring")
        .when(day.between(621, 922), "Summer")
        .when(day.between(923, 1220), "Autumn")
        .when(day.isNotNull(), "Winter")
    )


def weekday_number(date: Column) -> Column:
    """Monday is 0."""
    return F.weekday(date)


def weekday_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def is_working_day(date: Column, holiday: Column | None = None) -> Column:
    """Monday to Friday; a holiday is no working day where the flag is given."""
    weekday = F.weekday(date) < 5
    return weekday if holiday is None else weekday & ~holiday


def is_peak(hour: Column, date: Column) -> Column:
    """Commuter hours 6-10 and 15-19 from Monday to Friday, holidays included."""
    return (F.weekday(date) < 5) & (hour.between(6, 10) | hour.between(15, 19))


def at_hour(date: Column, hour: Column) -> Column:
    """The zone-free timestamp of an hour of a day."""
    return F.timestamp_add("HOUR", hour, date.cast("timestamp_ntz"))


def hour_start(ts: Column) -> Column:
    """The timestamp cut down to its hour, staying zone-free."""
    return at_hour(F.to_date(ts), F.hour(ts))


def hour_key(ts: Column) -> Column:
    """Text key of the hour, such as ``2021-04-02 12:00:00``."""
    return F.date_format(ts, "yyyy-MM-dd HH:00:00")


def hours_since(origin: Column, ts: Column) -> Column:
    return F.timestamp_diff("HOUR", origin, ts)


def month_name(month: Column) -> Column:
    """Three-letter name of a month number."""
    return F.element_at(F.array(*[F.lit(name) for name in MONTH_NAMES]), month.cast("int"))


def date_parts(ts: Column) -> dict[str, Column]:
    """date, hour, day, month and year columns of a timestamp."""
    return {
        "date": F.to_date(ts),
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "month": F.month(ts),
        "year": F.year(ts),
    }
