"""Rentals rebuilt from GPS messages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import rental_duration
from ..session import settle
from .joins import spread_join
from .pings import has_position
from .ranking import ordinal_by_time

RENTAL_KEY = ["last_rental_start", "bike_id"]


def rental_pairs(pings: DataFrame) -> DataFrame:
    return pings.select(*RENTAL_KEY).distinct()


def count_pending(pings: DataFrame) -> DataFrame:
    """Number of distinct rentals among the raw messages."""
    return rental_pairs(pings).agg(F.count("*").alias("pending"))


def rank_rentals(pings: DataFrame) -> DataFrame:
    """Rentals of a bike numbered from the newest; 1 is open, all others are completed."""
    return ordinal_by_time(rental_pairs(pings), ["bike_id"], "last_rental_start", "rent_rank", descending=True)


def latest_starts(rentals: DataFrame) -> DataFrame:
    """The newest start of each bike, which is its open rental."""
    return rentals.groupBy("bike_id").agg(F.max("last_rental_start").alias("open_start"))


def completed_pairs(pings: DataFrame) -> DataFrame:
    """Rentals of a bike that a newer start has closed.

    The same answer as rank > 1, from one small aggregate per bike instead of a ranking.
    """
    pairs = rental_pairs(pings)
    closed = spread_join(pairs, latest_starts(pairs), ["bike_id"], "inner").filter("last_rental_start < open_start")
    return closed.select(*RENTAL_KEY)


def summarize(pings: DataFrame) -> DataFrame:
    """One row per rental from one pass: first and last battery, last GPS time, duration.

    Messages are unique on (start, bike, GPS time), so first and last are well defined, and a repeated copy
    changes nothing. A rental with a single GPS time has no final battery.
    """
    return (
        pings.groupBy(*RENTAL_KEY)
        .agg(
            F.min_by("battery", "last_gps_time").alias("battery_start"),
            F.max_by("battery", "last_gps_time").alias("_final"),
            F.min("last_gps_time").alias("first_gps_time"),
            F.max("last_gps_time").alias("last_gps_time"),
        )
        .select(
            *RENTAL_KEY,
            "battery_start",
            F.when(F.col("last_gps_time") > F.col("first_gps_time"), F.col("_final")).alias("battery_end"),
            rental_duration(F.col("last_gps_time"), F.col("last_rental_start")).alias("duration"),
        )
    )


def reconstruct(pings: DataFrame) -> DataFrame:
    """Completed rentals with battery at start and end and the duration in minutes.

    Messages shrink to one row per rental before anything is joined, so the only wide shuffle is the aggregate's. The
    rentals are written once, as their newest starts are taken from them too.
    """
    rentals = settle(summarize(pings), "rentals")
    newest = latest_starts(rentals)
    return spread_join(rentals, newest, ["bike_id"], "inner").filter("last_rental_start < open_start").drop("open_start")


def rental_coordinates(pings: DataFrame, completed: DataFrame) -> DataFrame:
    """Usable positions of completed rentals."""
    return (
        spread_join(pings, completed, RENTAL_KEY, "left_semi")
        .filter(has_position(F.col("latitude"), F.col("longitude")))
        .select(F.col("last_rental_start").alias("date"), "bike_id", "latitude", "longitude")
    )


def purge(pings: DataFrame, completed: DataFrame) -> DataFrame:
    """Raw messages that stay after the completed rentals are taken out."""
    return spread_join(pings, completed, RENTAL_KEY, "left_anti")


def orphans(coordinates: DataFrame, rentals: DataFrame) -> DataFrame:
    """Coordinates that point to no rental; empty when the store is sound."""
    keys = rentals.select(F.col("last_rental_start").alias("date"), "bike_id")
    return coordinates.join(keys, ["date", "bike_id"], "left_anti")


def audit(pings: DataFrame, remaining: DataFrame) -> DataFrame:
    """Rentals processed, and errors: rentals left over beyond the open ones, of which each bike has one.

    One aggregate per rental and one per bike, over the messages before and after.
    """
    both = pings.select(*RENTAL_KEY, F.lit(0).alias("_left")).unionByName(remaining.select(*RENTAL_KEY, F.lit(1).alias("_left")))
    rentals = both.groupBy(*RENTAL_KEY).agg(F.max("_left").alias("_left"))
    bikes = rentals.groupBy("bike_id").agg(F.count("*").alias("before"), F.sum("_left").alias("left"))
    totals = bikes.agg(F.count("*").alias("open"), F.sum("before").alias("before"), F.sum("left").alias("left"))
    counts = {"processed": F.col("before") - F.col("open"), "errors": F.col("left") - F.col("open")}
    return totals.select(*[F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in counts.items()])


@dataclass
class ProcessedBatch:
    rentals: DataFrame
    coordinates: DataFrame
    remaining: DataFrame
    log: DataFrame


def process_batch(pings: DataFrame) -> ProcessedBatch:
    """The daily job: completed rentals, their coordinates, the raw rest and the audit row.

    The keys of the completed rentals are written once for the steps that need them.
    """
    completed = settle(completed_pairs(pings), "completed")
    remaining = purge(pings, completed)
    return ProcessedBatch(
        reconstruct(pings), rental_coordinates(pings, completed), remaining, audit(pings, remaining)
    )


def first_and_last(pings: DataFrame) -> DataFrame:
    """The first and the last message of each rental; one row where they are the same."""
    detail = [c for c in pings.columns if c not in [*RENTAL_KEY, "last_gps_time"]]
    message = F.struct("last_gps_time", *detail)
    ends = pings.groupBy(*RENTAL_KEY).agg(F.min(message).alias("lo"), F.max(message).alias("hi"))
    rows = F.array(
        F.struct(F.lit(True).alias("rent_starting"), F.col("lo").alias("m")),
        F.struct(F.lit(False).alias("rent_starting"), F.col("hi").alias("m")),
    )
    return (
        ends.select(*RENTAL_KEY, "lo", F.explode(rows).alias("e"))
        .filter(F.col("e.rent_starting") | (F.col("e.m.last_gps_time") > F.col("lo.last_gps_time")))
        .select(*RENTAL_KEY, "e.rent_starting", "e.m.*")
    )


def rental_history(pings: DataFrame) -> DataFrame:
    """Coordinates and batteries of a rental as arrays, newest first, one row per rental and day of its messages.

    Every rental is cut by the day, however long, so a row is bounded by the messages a bike can send in a day and
    no group grows with the data. ``last_gps_time`` is the latest of the whole rental.
    """
    message = F.struct("last_gps_time", "battery", "latitude", "longitude")
    days = pings.groupBy(*RENTAL_KEY, F.to_date("last_gps_time").alias("day")).agg(
        F.sort_array(F.collect_list(message), asc=False).alias("m")
    )
    arrays = days.select(
        *RENTAL_KEY,
        "day",
        F.transform("m", lambda x: F.array(x["latitude"], x["longitude"])).alias("coordinates"),
        F.col("m.battery").alias("battery"),
    )
    latest = pings.groupBy(*RENTAL_KEY).agg(F.max("last_gps_time").alias("last_gps_time"))
    return spread_join(arrays, latest, RENTAL_KEY, "inner")


def first_valid_battery(pings: DataFrame) -> DataFrame:
    """Earliest battery above 0 of each rental, else -1."""
    return grouped_rentals(pings).select(*RENTAL_KEY, "start_battery")


def grouped_rentals(pings: DataFrame) -> DataFrame:
    """Rentals of cleaned messages: latest GPS time, first valid battery and message count, without arrays."""
    valid_at = F.when(F.col("battery") > 0, F.col("last_gps_time"))
    return pings.groupBy(*RENTAL_KEY).agg(
        F.max("last_gps_time").alias("last_gps_time"),
        F.coalesce(F.min_by("battery", valid_at), F.lit(-1)).alias("start_battery"),
        F.count("*").alias("n_pings"),
    )


def starts_per_day(pings: DataFrame, bike_type: str) -> DataFrame:
    """Distinct rental starts per day of one bike type."""
    starts = pings.filter(F.col("bike_type") == bike_type).select("last_rental_start").distinct()
    return starts.groupBy(F.to_date("last_rental_start").alias("date")).agg(F.count("*").alias("starts"))


def latest_dropped(df: DataFrame, order: str, n: int) -> DataFrame:
    """All rows but the ``n`` newest; the top-n is cheap and small, ``order`` must be unique."""
    newest = df.orderBy(F.col(order).desc()).limit(n).select(order)
    return df.join(newest, order, "left_anti")

