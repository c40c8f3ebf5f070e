"""Figures of the operations dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import hour_start, season, time_of_day, weekday_name
from .profile import share_of_total


def last_day(rentals: DataFrame, start: str) -> Column:
    """The newest rental date, the usual as-of day; periods never read the clock."""
    return rentals.agg(F.to_date(F.max(start))).scalar()


def in_last_months(ts: Column, asof: Column, months: int, until: int = 0) -> Column:
    """Dates from ``months`` to ``until`` months before the as-of day, both ends included."""
    return _between_days(ts, F.add_months(asof, -months), F.add_months(asof, -until))


def in_last_days(ts: Column, asof: Column, days: int) -> Column:
    return _between_days(ts, F.date_sub(asof, days), asof)


def _between_days(ts: Column, first: Column, last: Column) -> Column:
    """A range on the column itself, not on its date, so that the scan can skip files and row groups."""
    return (ts >= first.cast("timestamp_ntz")) & (ts < F.date_add(last, 1).cast("timestamp_ntz"))


def quarter_figures(rentals: DataFrame, asof: Column) -> DataFrame:
    """Rentals and mean duration of the last and the previous three months, and their change, in one pass."""
    now = in_last_months(F.col("start"), asof, 3)
    before = in_last_months(F.col("start"), asof, 6, 3)
    return (
        rentals.filter(in_last_months(F.col("start"), asof, 6))
        .agg(
            F.count_if(now).alias("total_rentals"),
            F.count_if(before).alias("previous_rentals"),
            F.avg(F.when(now, F.col("duration"))).alias("average_duration"),
            F.avg(F.when(before, F.col("duration"))).alias("previous_duration"),
        )
        .withColumns(
            {
                "rentals_change": F.col("total_rentals") - F.col("previous_rentals"),
                "duration_change": F.col("average_duration") - F.col("previous_duration"),
            }
        )
    )


def initial_battery(rentals: DataFrame, asof: Column) -> DataFrame:
    """Known battery levels at the start of rentals of the last three months."""
    recent = rentals.filter(in_last_months(F.col("start"), asof, 3))
    return recent.filter(F.col("battery_start").isNotNull() & (F.col("battery_start") != 0)).select("battery_start")


def hourly_totals(rentals: DataFrame) -> DataFrame:
    """Rentals and mean duration per hour, with period of the day and day name."""
    hour = F.col("date_rental")
    return (
        rentals.groupBy(hour_start(F.col("start")).alias("date_rental"))
        .agg(F.count("*").alias("total_rentals"), F.round(F.avg("duration"), 2).alias("hourly_avg_duration"))
        .select(
            "date_rental",
            time_of_day(F.hour(hour)).alias("timeofday"),
            weekday_name(hour).alias("day_of_week"),
            "total_rentals",
            "hourly_avg_duration",
        )
    )


def _by(totals: DataFrame, by: str) -> DataFrame:
    return totals.withColumn("season", season(F.to_date("date_rental"))) if by == "season" else totals


def share_by(totals: DataFrame, by: str) -> DataFrame:
    """Share of all rentals per weekday, period or season."""
    groups = _by(totals, by).groupBy(by).agg(F.sum("total_rentals").alias("total_rentals"))
    return share_of_total(groups, "total_rentals")


def mean_hourly_duration(totals: DataFrame, by: str) -> DataFrame:
    """Plain mean of the hourly means, as the dashboard shows it."""
    return _by(totals, by).groupBy(by).agg(F.avg("hourly_avg_duration").alias("avg_duration"))


def completeness(recorded: DataFrame, days: DataFrame) -> DataFrame:
    """Weather hours per day and how many of the 24 are missing, days without any included."""
    counts = recorded.groupBy("date").agg(F.count("*").alias("n"))
    return days.join(counts, "date", "left").select(
        "date", F.coalesce("n", F.lit(0)).cast("long").alias("processed"), (24 - F.coalesce("n", F.lit(0))).cast("long").alias("errors")
    )
