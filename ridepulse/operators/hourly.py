"""The hourly fact table and the joins that build it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_counts(rentals: DataFrame, start: str) -> DataFrame:
    """Rentals per date and hour of their start."""
    return rentals.groupBy(F.to_date(start).alias("date"), F.hour(start).alias("hour")).agg(F.count("*").alias("demand"))


def rentals_and_weather(rentals: DataFrame, weather: DataFrame, start: str) -> DataFrame:
    """Each rental with the weather of its hour."""
    keyed = rentals.withColumns({"date": F.to_date(start), "hour": F.hour(start)})
    return keyed.join(weather, ["date", "hour"])


def hours_with_rentals(hourly: DataFrame, weather: DataFrame) -> DataFrame:
    return hourly.join(weather, ["date", "hour"])


def with_all_hours(weather: DataFrame, hourly: DataFrame) -> DataFrame:
    """Every weather hour; an hour nobody rented in counts zero."""
    joined = weather.join(hourly, ["date", "hour"], "left")
    return joined.withColumn("demand", F.coalesce("demand", F.lit(0)).cast("int"))


def sample_dates(df: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of a closed date range."""
    return df.filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def daily_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(F.sum("demand").alias("daily_rentals"))


def daily_series(df: DataFrame) -> DataFrame:
    """Daily totals with the day's attributes, one row per date."""
    attributes = ["holiday", "dayofweek", "working_day", "season"]
    days = df.groupBy("date").agg(*[F.min(c).alias(c) for c in attributes])
    return daily_totals(df).join(days, "date", "left")
