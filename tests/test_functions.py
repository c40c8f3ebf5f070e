"""Scalar functions on the edge rows where a rule changes its answer."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridepulse.functions import calendar as C
from ridepulse.functions import text as T
from ridepulse.functions import weather as W
from ridepulse.functions.ordering import ordinal_of


def column(spark, kind, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_time_of_day_edges(spark):
    hours = [0, 6, 7, 11, 12, 17, 18, 22, 23]
    names = ["Night"] * 2 + ["Morning"] * 2 + ["Afternoon"] * 2 + ["Evening"] * 2 + ["Night"]
    assert column(spark, "int", hours, C.time_of_day) == names


def test_season_edges(spark):
    days = ["2020-02-29", "2021-03-20", "2021-03-21", "2021-06-20", "2021-06-21", "2021-09-22", "2021-09-23", "2021-12-20", "2021-12-21"]
    names = ["Winter", "Winter", "Spring", "Spring", "Summer", "Summer", "Autumn", "Autumn", "Winter"]
    assert column(spark, "string", days, lambda x: C.season(x.cast("date"))) == names


def test_rain_edges(spark):
    rain = [0.0, 0.3, 0.31, 0.5, 0.51, 4.0, 4.1, -0.1, None]
    names = ["no rain", "drizzle", "light rain", "light rain", "moderate rain", "moderate rain", "heavy rain", "drizzle", None]
    assert column(spark, "double", rain, W.rain_level) == names


def test_every_beaufort_limit(spark):
    below = [x - 0.01 for x in W.BEAUFORT_LIMITS]
    assert column(spark, "double", below, W.beaufort) == list(range(12))
    assert column(spark, "double", list(W.BEAUFORT_LIMITS), W.beaufort) == list(range(1, 13))
    assert column(spark, "double", [None], W.beaufort) == [None]


def test_wind_groups(spark):
    names = ["Calm / Light Breeze"] * 3 + ["Breeze"] + ["Moderate Breeze"] * 2 + ["Strong Breeze / Near Gale"] * 2
    assert column(spark, "int", list(range(13)), W.wind_group) == names + ["Gale / Storm"] * 5


def test_wind_units_keep_null(spark):
    assert column(spark, "double", [10.0, None], W.knots_to_ms) == [pytest.approx(5.14), None]
    assert column(spark, "double", [1.852], W.ms_to_knots) == pytest.approx([3.6])


def test_rounding(spark):
    assert column(spark, "double", [2.5, -2.5, 0.4, 1.5], W.round_half_away) == [3, -3, 0, 2]
    assert column(spark, "double", [2.5, -2.5, 0.4, 1.5], W.round_half_even) == [2, -2, 0, 2]


def test_duration_is_whole_and_not_negative(spark):
    start, rows = dt.datetime(2021, 1, 1, 9), [(dt.datetime(2021, 1, 1, 10, 0, 59),), (dt.datetime(2021, 1, 1, 8),)]
    df = spark.createDataFrame(rows, "gps timestamp_ntz").orderBy("gps")
    found = df.select(C.rental_duration(F.col("gps"), F.lit(start)), C.duration_minutes(F.col("gps"), F.lit(start)))
    assert [tuple(r) for r in found.collect()] == [(0, 0.0), (60, pytest.approx(60 + 59 / 60))]


def test_force_integer(spark):
    assert column(spark, "string", [" 7 ", "7.5", "-", "-3", "+4", "", None], T.force_integer) == [7, 0, 0, -3, 4, 0, 0]


def test_text_dates(spark):
    assert column(spark, "string", ["31-07-2022", " 01-02-2021 "], T.day_month_year) == [dt.date(2022, 7, 31), dt.date(2021, 2, 1)]
    names = ["a/b/weather_2022-07-31.json", "weather_x.json"]
    assert column(spark, "string", names, T.date_from_file_name) == [dt.date(2022, 7, 31), None]
    assert column(spark, "string", ["07:45", "23:00"], T.hour_of_clock) == [7, 23]


def test_minutes_as_text(spark):
    minutes = [65.5, 119.7, -5.0, 1440.0, 3000.25]
    assert column(spark, "double", minutes, T.hours_minutes) == ["1h 6m", "1h 60m", "-1h 55m", "24h 0m", "50h 0m"]
    clock = [str(dt.timedelta(minutes=m)) for m in [*minutes, 0.0001]]
    assert column(spark, "double", [*minutes, 0.0001], T.clock_string) == clock


def test_percent_and_names(spark):
    assert column(spark, "double", [0.125, 0.3, 1 / 3], T.percent_string) == ["12.5%", "30.0%", "33.33%"]
    assert column(spark, "int", [1, 9, 12], C.month_name) == ["Jan", "Sep", "Dec"]
    assert column(spark, "string", ["b", "z", None], lambda x: ordinal_of(x, ["a", "b"])) == [1, -1, -1]


def test_working_day_and_peak(spark):
    day = dt.date(2021, 3, 17)  # a holiday on a Wednesday
    df = spark.createDataFrame([(day, True)], "d date, h boolean")
    row = df.select(
        C.is_working_day(F.col("d")), C.is_working_day(F.col("d"), F.col("h")), C.is_peak(F.lit(8), F.col("d")),
        C.is_peak(F.lit(11), F.col("d")), C.weekday_name(F.col("d")), C.weekday_number(F.col("d")),
    ).first()
    assert tuple(row) == (True, False, True, False, "Wednesday", 2)
