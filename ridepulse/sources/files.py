"""Readers for the landed files: message history, daily messages, weather, holidays and forecasts.

All schemas are explicit, so no file is scanned twice to guess types.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.features import weather_rows

# Column names of the public feeds.
HISTORY_SCHEMA = """HarvestTime TIMESTAMP_NTZ, BikeID BIGINT, Battery INT, BikeIdentifier STRING, BikeTypeName STRING,
    EBikeProfileID INT, EBikeStateID INT, IsEBike BOOLEAN, IsMotor BOOLEAN, IsSmartLock BOOLEAN,
    LastGPSTime TIMESTAMP_NTZ, LastRentalStart TIMESTAMP_NTZ, Latitude DECIMAL(11,7), Longitude DECIMAL(11,7), SpikeID STRING"""
PING_SCHEMA = """LastRentalStart TIMESTAMP_NTZ, BikeID BIGINT, Battery INT, LastGPSTime TIMESTAMP_NTZ,
    Latitude DECIMAL(11,7), Longitude DECIMAL(11,7)"""
WEATHER_JSON_SCHEMA = "temperature STRING, windSpeed STRING, humidity STRING, rainfall STRING, date STRING, reportTime STRING"
WEATHER_CSV_COLUMNS = ["time", "report", "temp", "wdsp", "wind_gust", "wind_direction", "rain", "pressure"]
STATION_HOURLY_COLUMNS = [
    "date", "ind", "rain", "ind.1", "temp", "ind.2", "wetb", "dewpt", "vappr", "rhum", "msl", "ind.3", "wdsp",
    "ind.4", "wddir", "ww", "w", "sun", "vis", "clht", "clamt",
]
STATION_KEPT = ["date", "rain", "temp", "rhum", "wdsp"]
HOLIDAY_FILE_SCHEMA = "date STRING, country STRING, name STRING, type STRING"
HOLIDAY_FEED_SCHEMA = """response STRUCT<holidays: ARRAY<STRUCT<date: STRUCT<iso: STRING>, country: STRUCT<name: STRING>,
    name: STRING, type: ARRAY<STRING>>>>"""
FORECAST_SCHEMA = """_from STRING, _to STRING, location STRUCT<temperature: STRUCT<_value: DOUBLE>,
    windSpeed: STRUCT<_mps: DOUBLE>, humidity: STRUCT<_value: DOUBLE>, precipitation: STRUCT<_value: DOUBLE>>"""
NATIONAL_HOLIDAY = "National holiday"


def _paths(path: str | Sequence[str]) -> str | list[str]:
    return path if isinstance(path, str) else list(path)


def read_history(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Many headered CSV exports of the message history as one frame."""
    return spark.read.schema(HISTORY_SCHEMA).option("header", True).csv(_paths(path))


def read_pings_json(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Daily message files: each holds one JSON array; only the six columns the store needs are read.

    A pretty-printed array is one task per file. Files with one array per line (``multi_line=False``) split.
    """
    return spark.read.schema(PING_SCHEMA).option("multiLine", multi_line).json(_paths(path))


def typed_weather(raw: DataFrame, to_integer=T.force_integer) -> DataFrame:
    """Typed weather rows from all-text readings. Readings that are no whole number become 0 by default."""
    return weather_rows(
        raw.select(
            T.day_month_year(F.col("date")).alias("date"),
            T.hour_of_clock(F.col("reportTime")).alias("hour"),
            to_integer(F.col("temperature")).alias("temp"),
            to_integer(F.col("windSpeed")).alias("wdsp"),
            to_integer(F.col("humidity")).alias("rhum"),
            F.trim("rainfall").try_cast("double").alias("rain"),
        )
    )


def read_weather_json(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    raw = spark.read.schema(WEATHER_JSON_SCHEMA).option("multiLine", multi_line).json(_paths(path))
    return typed_weather(raw)


def read_weather_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The fallback weather feed: eight columns by position, of which four are kept."""
    schema = ", ".join(f"{c} STRING" for c in WEATHER_CSV_COLUMNS)
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(_paths(path))
    return raw.select(
        T.hour_of_clock(F.col("time")).alias("time"),
        F.col("temp").try_cast("double").alias("temp"),
        F.col("wdsp").try_cast("double").alias("wdsp"),
        F.col("rain").try_cast("double").alias("rain"),
    )


def read_station_hourly(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Station history per hour; the reader parses only the kept columns."""
    kinds = {"date": "STRING", "rain": "DOUBLE", "temp": "DOUBLE", "rhum": "INT", "wdsp": "INT"}
    schema = ", ".join(f"`{c}` {kinds.get(c, 'STRING')}" for c in STATION_HOURLY_COLUMNS)
    raw = spark.read.schema(schema).option("header", True).csv(_paths(path)).select(*STATION_KEPT)
    iso = F.col("date").try_cast("timestamp_ntz")
    named = F.try_to_timestamp("date", F.lit("dd-MMM-yyyy HH:mm")).cast("timestamp_ntz")
    return raw.withColumn("date", F.coalesce(iso, named))


def read_station_daily(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Station history per day, as text columns under the file's own names."""
    return spark.read.option("header", True).csv(_paths(path))


def read_holidays(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Dates of national holidays from the flattened holiday file."""
    raw = spark.read.schema(HOLIDAY_FILE_SCHEMA).option("multiLine", multi_line).json(_paths(path))
    return _national(raw.select(_iso_date(F.col("date")).alias("date"), "country", "name", "type"))


def read_holiday_feed(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """The same from the nested feed, of which the first type of a holiday counts."""
    raw = spark.read.schema(HOLIDAY_FEED_SCHEMA).option("multiLine", multi_line).json(_paths(path))
    days = raw.select(F.explode("response.holidays").alias("h"))
    return _national(
        days.select(
            _iso_date(F.col("h.date.iso")).alias("date"),
            F.col("h.country.name").alias("country"),
            F.col("h.name").alias("name"),
            F.get(F.col("h.type"), F.lit(0)).alias("type"),
        )
    )


def _iso_date(text: Column) -> Column:
    return F.substring(text, 1, 10).try_cast("date")


def _national(days: DataFrame) -> DataFrame:
    return days.filter(F.col("type") == NATIONAL_HOLIDAY)


def read_forecast_xml(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per forecast entry; an entry tells either the state at a time or the rain of an interval."""
    raw = spark.read.format("xml").schema(FORECAST_SCHEMA).option("rowTag", "time").option("valueTag", "_text").load(_paths(path))
    return raw.select(
        _utc(F.col("_from")).alias("from_time"),
        _utc(F.col("_to")).alias("at_time"),
        F.col("location.temperature._value").alias("temp"),
        F.col("location.humidity._value").alias("rhum"),
        F.col("location.windSpeed._mps").alias("wind_ms"),
        F.col("location.precipitation._value").alias("rain"),
    )


def _utc(text: Column) -> Column:
    return F.rtrim(text, F.lit("Z")).try_cast("timestamp_ntz")


def combine_forecast(entries: DataFrame) -> DataFrame:
    """One row per time that has a state entry, with the rain of the shortest interval ending there."""
    return (
        entries.groupBy("at_time")
        .agg(
            F.max("temp").alias("temp"),
            F.max("rhum").alias("rhum"),
            F.max("wind_ms").alias("wind_ms"),
            F.coalesce(
                F.max_by("rain", F.when(F.col("rain").isNotNull(), F.col("from_time"))), F.max("rain")
            ).alias("rain"),
        )
        .filter(F.coalesce("temp", "rhum", "wind_ms").isNotNull())
    )
