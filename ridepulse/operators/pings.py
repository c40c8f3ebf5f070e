"""Cleaning of raw GPS messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import spread_join

FLEET = "DUB-General"
PING_KEY = ["last_rental_start", "bike_id", "last_gps_time"]


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def fleet_only(df: DataFrame, fleet: str = FLEET) -> DataFrame:
    """Messages of the public fleet; the type column is dropped as it holds one value afterwards."""
    return df.filter(F.col("bike_type") == fleet).drop("bike_type")


def never_started(df: DataFrame) -> DataFrame:
    """Start times whose only message is a warning: the bike moved but nobody rented it.

    The start time alone is the key. Counts are combined map-side, so a start shared by many rows is cheap.
    """
    return (
        df.filter(F.col("last_rental_start").isNotNull())
        .groupBy("last_rental_start")
        .agg(F.count("*").alias("n"), F.max("state_id").alias("state"))
        .filter("n = 1 AND state = 1")
        .select("last_rental_start")
    )


def drop_never_started(df: DataFrame) -> DataFrame:
    return spread_join(df, never_started(df), ["last_rental_start"], "left_anti")


def normal_battery(battery: Column) -> Column:
    """At most 100; unknown or negative becomes -1."""
    return F.when(battery.isNull() | (battery < 0), -1).otherwise(F.least(battery, F.lit(100))).cast("int")


def has_position(latitude: Column, longitude: Column) -> Column:
    """A coordinate pair that was reported; SQL null rules decide for half-empty pairs."""
    return (latitude.isNotNull() | longitude.isNotNull()) & ((latitude != 0) | (longitude != 0))


def clean_pings(df: DataFrame, fleet: str = FLEET) -> DataFrame:
    """Drop rentals that never started, keep the public fleet, normalise the battery."""
    return fleet_only(drop_never_started(df), fleet).withColumn("battery", normal_battery(F.col("battery")))


def null_counts(df: DataFrame) -> DataFrame:
    """Number of nulls per column, as one row per column."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])
    return counted.select(F.inline(pairs))


def unique_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """One row per key. Of rows that differ, the smallest by the remaining columns is kept, so reruns agree."""
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.dropDuplicates(key)
    kept = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_kept"))
    return kept.select(*[F.col(c) if c in key else F.col(f"_kept.{c}").alias(c) for c in df.columns])
