"""Hourly fact, dashboard figures and profiles against small hand-made rows and pandas."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ridepulse.operators import features as X
from ridepulse.operators import hourly as H
from ridepulse.operators import kpis as K
from ridepulse.operators import profile as P

D = dt.date


def weather(spark, hours):
    rows = [(D(2021, 3, 17), h, 10.0 + h, 80, 12, 0.0) for h in hours]
    return spark.createDataFrame(rows, "date date, hour int, temp double, rhum int, wdsp int, rain double")


def test_all_hours_keeps_each_weather_row(spark):
    trips = spark.createDataFrame(
        [(dt.datetime(2021, 3, 17, 8, 5),), (dt.datetime(2021, 3, 17, 8, 50),), (dt.datetime(2021, 3, 18, 8, 0),)], "start timestamp_ntz"
    )
    w, counts = weather(spark, range(6, 10)), H.hourly_counts(trips, "start")
    fact = H.with_all_hours(w, counts)
    assert {r.hour: r.demand for r in fact.collect()} == {6: 0, 7: 0, 8: 2, 9: 0}
    assert H.hours_with_rentals(counts, w).count() == 1
    assert H.rentals_and_weather(trips, w, "start").count() == 2


def test_features_of_a_holiday(spark):
    holidays = spark.createDataFrame([(D(2021, 3, 17),), (D(2021, 3, 17),)], "date date")
    fact = weather(spark, [8]).withColumn("demand", F.lit(1))
    rows = X.hourly_features(fact, holidays).collect()
    assert len(rows) == 1, "a repeated holiday does not repeat hours"
    r = rows[0]
    assert (r.holiday, r.working_day, r.peak, r.season, r.timesofday) == (True, False, True, "Winter", "Morning")
    assert (r.wind_bft, r.wind_speed_group, r.temp_r) == (4, "Moderate Breeze", 18)


def test_calendar_excludes_its_end(spark):
    span = spark.createDataFrame([(D(2020, 2, 28), D(2020, 3, 2))], "first_day date, end_day date")
    none = spark.createDataFrame([], "date date")
    assert [r.date for r in X.calendar(span, none).orderBy("date").collect()] == [D(2020, 2, 28), D(2020, 2, 29), D(2020, 3, 1)]


def test_boundary_day_counts_in_both_periods(spark):
    starts = [D(2022, 2, 28), D(2022, 5, 31), D(2021, 11, 30), D(2021, 11, 29)]
    rows = [(dt.datetime(d.year, d.month, d.day, 9), 60 + i) for i, d in enumerate(starts)]
    trips = spark.createDataFrame(rows, "start timestamp_ntz, duration int")
    row = K.quarter_figures(trips, F.lit(D(2022, 5, 31))).first()
    assert (row.total_rentals, row.previous_rentals) == (2, 2)
    assert row.duration_change == pytest.approx(60.5 - 61)


def test_battery_buckets(spark):
    df = spark.createDataFrame([(b,) for b in [0, 29, 30, 50, 79, 80, 99, 100, -1, None]], "b int")
    rows = {r.battery_status: (r.counts, r.per100) for r in P.battery_status(df, "b").collect()}
    assert rows == {"< 30%": (2, "28.57%"), "30% - 50%": (1, "14.29%"), "50% - 80%": (2, "28.57%"), "> 80%": (2, "28.57%")}


def test_missing_weather_hours(spark):
    days = spark.createDataFrame([(D(2021, 3, 17),), (D(2021, 3, 18),)], "date date")
    got = {r.date.day: (r.processed, r.errors) for r in K.completeness(weather(spark, range(23)), days).collect()}
    assert got == {17: (23, 1), 18: (0, 24)}


def test_box_stats_match_pandas(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.5 else rng.choice("abc"), rng.random() < 0.3, int(rng.expovariate(0.2))) for _ in range(900)]
    got = {(r.factor, r.level): r for r in P.box_stats(spark.createDataFrame(rows, "g string, f boolean, v int"), "v", ["g", "f"]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "f", "v"])
    pdf["f"] = pdf["f"].map({True: "true", False: "false"})
    for factor in ("g", "f"):
        for level, v in pdf.groupby(factor)["v"]:
            q1, q2, q3 = v.quantile([0.25, 0.5, 0.75])
            inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
            r = got[(factor, level)]
            assert (r.q1, r.median, r.q3, r.n) == (q1, q2, q3, len(v))
            assert (r.whisker_low, r.whisker_high, r.outliers) == (inside.min(), inside.max(), len(v) - len(inside))


def test_shares_add_up_and_nulls_stay_a_level(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "g string, v int")
    assert sum(r.share for r in P.value_counts(df, "g", normalize=True).collect()) == pytest.approx(1)
    got = {(r.factor, r.level): r.s for r in P.by_each(df, ["g"], [F.sum("v").alias("s")]).collect()}
    assert got == {("g", "a"): 3, ("g", None): 3}


def test_describe_and_zero_summary(spark):
    values = [0, 0, 1, 2, 7, 9, 9, 30]
    df = spark.createDataFrame([(v,) for v in values], "demand int")
    s, row = pd.Series(values), P.describe(df, "demand").first()
    assert (row["count"], row["min"], row["max"]) == (8, 0, 30)
    assert (row["p10"], row["p50"], row["p90"]) == pytest.approx(tuple(s.quantile([0.1, 0.5, 0.9])))
    zero = P.zero_summary(df).first()
    assert (zero.zeros_pct, zero["mean"], zero["var"]) == pytest.approx((25.0, s.mean(), s.var()))
    assert P.dispersion(df).first().overdispersed
