"""Parsing of dirty text fields and formatting for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_month_year(text: Column) -> Column:
    """Date of ``dd-mm-yyyy`` text; NULL where it does not parse."""
    return F.try_to_date(F.trim(text), "dd-MM-yyyy")


def date_from_file_name(path: Column) -> Column:
    """Date in a file name such as ``weather_2022-07-31.json``."""
    found = F.regexp_extract(path, r"_(\d{4}-\d{2}-\d{2})[^/]*$", 1)
    return F.when(found != "", F.to_date(found))


def hour_of_clock(text: Column) -> Column:
    """Hour of ``HH:MM`` text."""
    return F.split(F.trim(text), ":")[0].try_cast("int")


def force_integer(text: Column) -> Column:
    """Whole-number text as int; everything else, ``7.5`` included, becomes 0."""
    clean = F.trim(text)
    whole = F.when(clean.rlike(r"^[+-]?[0-9]+$"), clean.try_cast("int"))
    return F.coalesce(whole, F.lit(0))


def hours_minutes(minutes: Column) -> Column:
    """``1h 5m``; the minute part is rounded after the split, so ``1h 60m`` can occur."""
    hours = F.floor(minutes / 60).cast("int").cast("string")
    rest = F.round(F.pmod(minutes, F.lit(60.0))).cast("int").cast("string")
    return F.concat(hours, F.lit("h "), rest, F.lit("m"))


def clock_string(minutes: Column) -> Column:
    """``H:MM:SS`` with a day part in front and a fraction behind where there is one."""
    micros = F.bround(minutes * F.lit(60e6)).cast("long")
    day = F.floor(micros / F.lit(86400e6)).cast("long")
    rest = micros - day * F.lit(86400000000)
    second = F.floor(rest / F.lit(1e6)).cast("long")
    fraction = rest - second * F.lit(1000000)
    plural = F.when(F.abs(day) == 1, " day, ").otherwise(" days, ")
    return F.concat(
        F.when(day != 0, F.concat(day.cast("string"), plural)).otherwise(""),
        F.floor(second / 3600).cast("string"),
        F.lit(":"),
        F.lpad(F.floor(second % 3600 / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((second % 60).cast("string"), 2, "0"),
        F.when(fraction != 0, F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))).otherwise(""),
    )


def percent_string(share: Column) -> Column:
    """``12.5%`` from 0.125, at most two decimals."""
    return F.concat(F.round(share * 100, 2).cast("string"), F.lit("%"))
