"""Calendar and weather features of hours, rentals, days and forecasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import weather as W
from .encoders import bin_of


def with_holiday_flag(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """Flag rows whose date is a holiday. The optimizer broadcasts the holiday table while it is small."""
    days = holidays.select("date").distinct().withColumn("holiday", F.lit(True))
    return df.join(days, "date", "left").withColumn("holiday", F.coalesce("holiday", F.lit(False)))


def _derived() -> dict:
    date, hour = F.col("date"), F.col("hour")
    return {
        "day": F.dayofmonth(date),
        "month": F.month(date),
        "year": F.year(date),
        "dayofweek_n": C.weekday_number(date),
        "dayofweek": C.weekday_name(date),
        "working_day": C.is_working_day(date, F.col("holiday")),
        "season": C.season(date),
        "peak": C.is_peak(hour, date),
        "timesofday": C.time_of_day(hour),
        "rainfall_intensity": W.rain_level(F.col("rain")),
        "wind_speed_group": W.wind_group(F.col("wind_bft")),
        "temp_r": W.round_half_away(F.col("temp")),
    }


def hourly_features(fact: DataFrame, holidays: DataFrame) -> DataFrame:
    """All features of an hourly row.

    Wind is scaled in steps of their own: the optimizer keeps them apart because later steps read them several
    times, and no expression grows past what the JVM compiles.
    """
    flagged = with_holiday_flag(fact, holidays).withColumn("_ms", W.knots_to_ms(F.col("wdsp")))
    scaled = flagged.withColumn("wind_bft", W.beaufort(F.col("_ms"))).drop("_ms")
    return scaled.withColumns(_derived())


def with_bins(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """A column ``<name>_bin`` per column with learnt inner edges; an unknown value has no bin."""
    return df.withColumns({f"{name}_bin": bin_of(F.col(name), found) for name, found in edges.items()})


def trip_features(trips: DataFrame, weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """Rentals with the weather of their hour and the same features."""
    keyed = trips.withColumns({"date": F.to_date("start"), "hour": F.hour("start")})
    return hourly_features(keyed.join(weather, ["date", "hour"]), holidays)


def weather_rows(observed: DataFrame) -> DataFrame:
    """Weather rows as the store keeps them, with period of the day and rain level."""
    return observed.select(
        "date",
        "hour",
        C.time_of_day(F.col("hour")).alias("timesofday"),
        "temp",
        "wdsp",
        "rhum",
        "rain",
        W.rain_level(F.col("rain")).alias("rainfall_intensity"),
    )


def forecast_features(forecast: DataFrame) -> DataFrame:
    """Model inputs of forecast points. Working day ignores holidays, and wind arrives in m/s."""
    at = F.col("at_time")
    points = forecast.withColumns({"date": F.to_date(at), "hour": F.hour(at), "wdsp": W.ms_to_knots(F.col("wind_ms"))})
    return points.withColumns(
        {
            "dayofweek_n": C.weekday_number(F.col("date")),
            "dayofweek": C.weekday_name(F.col("date")),
            "working_day": C.is_working_day(F.col("date")),
            "timesofday": C.time_of_day(F.col("hour")),
            "season": C.season(F.col("date")),
            "rainfall_intensity": W.rain_level(F.col("rain")),
        }
    )


def calendar(span: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` up to, not including, ``end_day``."""
    days = span.select(F.explode(F.sequence(F.col("first_day"), F.date_sub("end_day", 1))).alias("date"))
    return with_holiday_flag(days, holidays).select(
        "date",
        C.weekday_number(F.col("date")).alias("dayofweek"),
        "holiday",
        C.is_working_day(F.col("date"), F.col("holiday")).alias("working_day"),
        C.season(F.col("date")).alias("season"),
    )
