"""How the given tables stand in for pings, trips, weather and holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import hour_start
from ..operators.encoders import kmeans_edges
from ..operators.features import hourly_features, trip_features, with_bins
from ..operators.hourly import hourly_counts, sample_dates, with_all_hours
from ..operators.pings import clean_pings
from ..operators.sessions import infer_starts
from ..session import settle
from .oracle import BINS, TRAIN

GAP_SECONDS = 6 * 3600
# Holiday days of the year.
HOLIDAY_DAYS = {(1, 1): "New Year", (3, 17): "Patron Day", (12, 25): "Christmas Day", (12, 26): "Second Christmas Day"}
# All years that a date can have; four days each.
HOLIDAY_YEARS = (1, 9999)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pings(spark: SparkSession, sf: str) -> DataFrame:
    """GPS messages of bikes, from the event stream; batteries are dirty on purpose."""
    events = table(spark, sf, "events").selectExpr(
        "user_id AS bike_id",
        "ts AS last_gps_time",
        "event_type",
        "value / 1e4 AS offset",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
    )
    runs = infer_starts(events, "bike_id", "last_gps_time", GAP_SECONDS, "last_rental_start")
    return runs.selectExpr(
        "bike_id",
        "last_rental_start",
        "last_gps_time",
        "CASE WHEN k % 25 = 0 THEN NULL WHEN k % 25 = 1 THEN -k WHEN k = 99 THEN 104 ELSE k END AS battery",
        """CASE bike_id % 10 WHEN 0 THEN 'Workshop' WHEN 1 THEN 'Private' WHEN 2 THEN 'Healthcare'
           ELSE 'DUB-General' END AS bike_type""",
        """CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'view' THEN 4
           ELSE 5 END AS state_id""",
        "CASE event_type WHEN 'error' THEN 0e0 WHEN 'signup' THEN NULL ELSE 53.3e0 + offset END AS latitude",
        "CASE event_type WHEN 'error' THEN 0e0 WHEN 'signup' THEN NULL ELSE -6.25e0 - offset END AS longitude",
    )


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean_pings(pings(spark, sf))


def trips(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """Finished rentals over fourteen months, one per order, and more columns of the order where asked for."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS trip_id",
        "o_custkey AS bike_id",
        """timestampadd(MINUTE,
           greatest(o_orderkey % 24, (o_orderkey * 5 + o_custkey) % 24) * 60 + (o_custkey * 7 + o_orderkey) % 60,
           CAST(date_add(DATE'2021-03-01', datediff(CAST(o_orderdate AS DATE), DATE'1995-01-01') % 426) AS TIMESTAMP_NTZ)
           ) AS start""",
        "CAST(CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey % 103 - 1 END AS INT) AS battery_start",
        "CAST(o_orderkey % 180 AS INT) AS duration",
        *more,
    )


def _weather(times: DataFrame, ts: str) -> DataFrame:
    """One row per hour between the first and the last hour seen."""
    span = times.agg(F.min(ts).alias("h0"), F.max(ts).alias("h1")).select(
        hour_start(F.col("h0")).alias("h0"), hour_start(F.col("h1")).alias("h1")
    )
    return (
        span.selectExpr("h0", "explode(sequence(0, CAST(timestampdiff(HOUR, h0, h1) AS INT))) AS i")
        .selectExpr("i", "timestampadd(HOUR, i, h0) AS ts")
        .selectExpr(
            "CAST(ts AS DATE) AS date",
            "hour(ts) AS hour",
            "((i * 37) % 251) / 1e1 - 5e0 AS temp",
            "40 + (i * 29) % 61 AS rhum",
            "(i * 13) % 60 AS wdsp",
            "CASE WHEN i % 3 = 0 THEN 0e0 ELSE ((i * 17) % 60) / 1e1 END AS rain",
        )
    )


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly weather over the months of the trips."""
    return _weather(trips(spark, sf), "start")


def ping_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly weather over the days of the pings."""
    return _weather(table(spark, sf, "events"), "ts")


def holidays(spark: SparkSession) -> DataFrame:
    """National holidays, a dimension of a few days a year."""
    days = ", ".join(f"make_date(y, {m}, {d})" for m, d in HOLIDAY_DAYS)
    first, last = HOLIDAY_YEARS
    return spark.sql(f"SELECT explode(array({days})) AS date FROM (SELECT explode(sequence({first}, {last})) AS y)")


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    return hourly_counts(trips(spark, sf), "start")


def fact(spark: SparkSession, sf: str) -> DataFrame:
    """Every hour with its weather and its number of rentals, zero hours included."""
    return with_all_hours(weather(spark, sf), hourly(spark, sf))


def features(spark: SparkSession, sf: str) -> DataFrame:
    return hourly_features(fact(spark, sf), holidays(spark))


def bin_edges(fact: DataFrame) -> dict[str, list[float]]:
    """Inner edges of the bins, learnt from the training dates."""
    train = sample_dates(fact, *TRAIN)
    return {name: kmeans_edges(train, name, bins) for name, bins in BINS.items()}


def binned_features(spark: SparkSession, sf: str) -> DataFrame:
    """The features of every hour with its temperature and humidity bins."""
    hours = settle(fact(spark, sf), "fact")
    return with_bins(hourly_features(hours, holidays(spark)), bin_edges(hours))


def rentals_with_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Trips joined with the weather and the calendar of their hour."""
    return trip_features(trips(spark, sf), weather(spark, sf), holidays(spark))


