"""Rank tests, serial correlation, regressions and encoders against dense numpy."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ridepulse.operators import encoders as E
from ridepulse.operators import glm as G
from ridepulse.operators import stats as S


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(11)
    rows = []
    for i in range(700):
        g = "a" if rng.random() < 0.5 else rng.choice("bcd")
        x = rng.randrange(0, 12)
        rows.append((i, g, x, rng.random() < 0.4, min(int(rng.expovariate(1 / (1 + 0.3 * x + (g == "b") * 2))), 25)))
    return pd.DataFrame(rows, columns=["i", "g", "x", "b", "y"])


@pytest.fixture(scope="module")
def frame(spark, sample):
    return spark.createDataFrame(sample, "i long, g string, x int, b boolean, y int").repartition(5).cache()


def test_kruskal(sample, frame):
    ranks, n = sample["y"].rank(), len(sample)
    ties = sample["y"].value_counts()
    correction = 1 - (ties**3 - ties).sum() / (n**3 - n)
    for row in S.kruskal_wallis(frame, "y", ["g", "b"]).collect():
        groups = ranks.groupby(sample[row.factor])
        h = 12 / (n * (n + 1)) * (groups.sum() ** 2 / groups.size()).sum() - 3 * (n + 1)
        assert row.h == pytest.approx(h / correction) and row.freedom == groups.ngroups - 1


def test_chi_square_tail_at_tabled_points(spark):
    table = [(3.841459, 1), (5.991465, 2), (7.814728, 3), (9.487729, 4), (18.307038, 10), (24.995790, 15)]
    df = spark.createDataFrame([(x, k) for x, k in table], "x double, k int")
    assert [r[0] for r in df.select(S.chi_square_tail("x", "k")).collect()] == pytest.approx([0.05] * 6, abs=1e-6)


def test_lags_cross_chunk_borders(spark):
    values = [random.Random(5).random() for _ in range(101)] + [0.25] * 7
    df = spark.createDataFrame(list(enumerate(values)), "i long, v double").repartition(6)
    rows = S.with_lags(df, "i", "v", 3, width=10).orderBy("i").collect()
    assert len(rows) == len(values)
    for r in rows:
        assert [r.lag_1, r.lag_2, r.lag_3] == [values[r.i - k] if r.i >= k else None for k in (1, 2, 3)]


def test_serial_correlation(spark):
    rng = np.random.default_rng(3)
    e = np.zeros(600)
    for t in range(1, 600):
        e[t] = 0.6 * e[t - 1] + rng.normal()
    e -= e.mean()
    df = spark.createDataFrame(list(enumerate(map(float, e))), "i long, e double")
    want = (np.diff(e) ** 2).sum() / (e**2).sum()
    assert S.durbin_watson(df, "i", "e").first()[0] == pytest.approx(want)
    acf = np.array([1.0] + [(e[k:] * e[:-k]).sum() / (e**2).sum() for k in range(1, 9)])
    got = [r.acf for r in S.autocorrelation(df, "i", "e", 8).orderBy("lag").collect()]
    assert got == pytest.approx(list(acf))
    partial = [r.pacf for r in S.partial_autocorrelation(df, "i", "e", 8).orderBy("lag").collect()]
    for k in range(1, 9):
        toeplitz = np.array([[acf[abs(i - j)] for j in range(k)] for i in range(k)])
        assert partial[k] == pytest.approx(np.linalg.solve(toeplitz, acf[1 : k + 1])[-1])


def dense(sample):
    return np.column_stack([np.ones(len(sample)), *[(sample["g"] == v).astype(float) for v in "bcd"], sample["x"].astype(float)])


def test_negative_binomial_fit(spark, sample, frame):
    fit = G.fit(frame, "y", ["x"], ["g"])
    x, y = dense(sample), sample["y"].to_numpy(float)
    mu = np.exp(x @ fit.beta)
    assert np.abs(x.T @ ((y - mu) / (1 + mu))).max() < 1e-6, "the score is zero at the optimum"
    w = mu / (1 + mu)
    inverse = np.linalg.inv((x * w[:, None]).T @ x)
    h = w * np.einsum("ij,jk,ik->i", x, inverse, x)
    s = (y - mu) / (1 + mu) / (1 - h)
    robust = inverse @ ((x * (s**2)[:, None]).T @ x) @ inverse
    assert fit.robust == pytest.approx(robust, rel=1e-8)
    rows = {r.i: r for r in fit.influence(frame).collect()}
    pearson = (y - mu) / np.sqrt(mu + mu**2)
    cooks = pearson**2 / (1 - h) / 5 * h / (1 - h)
    for i in range(0, 700, 37):
        assert rows[i].leverage == pytest.approx(h[i]) and rows[i].cooks == pytest.approx(cooks[i])
    ll = (y * np.log(mu) - (y + 1) * np.log(1 + mu)).sum()
    found = fit.information(frame).first()
    assert found.log_likelihood == pytest.approx(ll) and found.aic == pytest.approx(-2 * ll + 10)
    assert [r.term for r in fit.coefficients(spark).collect()] == ["Intercept", "g[b]", "g[c]", "g[d]", "x"]
    kept = G.without_influential(fit.influence(frame), fit.n).count()
    assert kept == int((cooks <= 4 / 700).sum())


def test_other_dispersion(sample, frame):
    fit = G.fit(frame, "y", ["x"], alpha=0.5)
    y, mu = sample["y"].to_numpy(float), np.exp(fit.beta[0] + fit.beta[1] * sample["x"].to_numpy(float))
    gamma = np.vectorize(math.lgamma)
    ll = gamma(y + 2) - gamma(2.0) - gamma(y + 1) + y * np.log(mu / 2) - (y + 2) * np.log(1 + mu / 2)
    assert fit.information(frame).first().log_likelihood == pytest.approx(ll.sum())


def test_gaussian_fit_with_robust_errors(sample, frame):
    fit = G.fit(frame, "y", ["x"], ["g"], family="gaussian")
    x, y = dense(sample), sample["y"].to_numpy(float)
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    inverse, e = np.linalg.inv(x.T @ x), y - x @ beta
    h = np.einsum("ij,jk,ik->i", x, inverse, x)
    assert fit.beta == pytest.approx(beta)
    assert fit.robust == pytest.approx(inverse @ ((x * ((e / (1 - h)) ** 2)[:, None]).T @ x) @ inverse)
    scale = (e**2).sum() / (700 - 5)
    assert fit.scale == pytest.approx(scale)
    rows = {r.i: r.studentized for r in fit.influence(frame).collect()}
    assert rows[5] == pytest.approx(e[5] / math.sqrt(scale * (1 - h[5])))


def test_a_fit_that_does_not_settle_raises(frame):
    """The number of levels has no limit any more, but a level without events has no finite estimate."""
    rows = frame.sparkSession.createDataFrame([("a", 0.0), ("a", 0.0), ("b", 2.0)], "f string, y double")
    with pytest.raises(RuntimeError, match="still moves"):
        G.fit(rows, "y", factors=["f"], max_steps=5)


def test_kmeans_edges_are_a_fixed_point(sample, frame):
    edges = E.kmeans_edges(frame, "y", 4)
    assert edges == sorted(edges) and len(edges) == 3
    bins = np.searchsorted(edges, sample["y"], side="right")
    centres = [sample["y"][bins == b].mean() for b in range(4)]
    assert edges == pytest.approx([(a + b) / 2 for a, b in zip(centres, centres[1:])])
    got = [r.b for r in frame.orderBy("i").select(E.bin_of(F.col("y"), edges).alias("b")).collect()]
    assert got == list(bins)


def test_yeo_johnson(sample, frame):
    power = E.yeo_johnson_power(frame, "y")
    y, n = sample["y"].to_numpy(float), len(sample)

    def likelihood(p):
        t = np.log1p(y) if abs(p) < 1e-12 else ((1 + y) ** p - 1) / p
        return -n / 2 * math.log(t.var()) + (p - 1) * np.log1p(y).sum()

    assert likelihood(power) >= max(likelihood(p) for p in np.linspace(-2, 2, 2001)) - 1e-6
    spark = frame.sparkSession
    # exact quantiles of a law whose power is about -4.5: far outside the first bracket
    normal = [-0.06 + 0.03 * math.sin(i) + 0.0001 * i for i in range(400)]
    far = [(1 - 4.5 * (0.1 + t)) ** (-1 / 4.5) - 1 for t in normal]
    found = E.yeo_johnson_power(spark.createDataFrame([(v,) for v in far], "v double"), "v")

    def far_likelihood(p):
        values = np.array(far)
        t = ((1 + values) ** p - 1) / p
        return -len(far) / 2 * math.log(t.var()) + (p - 1) * np.log1p(values).sum()

    assert far_likelihood(found) >= max(far_likelihood(p) for p in np.arange(-12, 12, 0.0503)) - 1e-6 and abs(found) > 2.3
    for none in ([(None,), (math.nan,)], [(2.0,), (2.0,)]):
        assert E.yeo_johnson_power(spark.createDataFrame(none, "v double"), "v") == 1.0
    signed = frame.sparkSession.createDataFrame([(-2.0,), (0.0,), (3.0,)], "v double")
    for p in (0.0, 0.5, 2.0):
        got = [r[0] for r in signed.select(E.yeo_johnson(F.col("v"), p)).collect()]
        low = -math.log1p(2) if p == 2.0 else -(3 ** (2 - p) - 1) / (2 - p)
        assert got == pytest.approx([low, 0.0, math.log1p(3) if p == 0 else (4**p - 1) / p])


def test_standardized_uses_the_fitted_rows(sample, frame):
    train = frame.filter("i < 400")
    got = E.standardized(frame, ["x"], train).filter("i = 600").first()
    part = sample[sample["i"] < 400]["x"]
    assert got.x_std == pytest.approx((sample["x"][600] - part.mean()) / part.std(ddof=0))


def test_preprocessor_layout(spark):
    df = spark.createDataFrame(
        [("Morning", "drizzle", 1.0, 9), ("Night", "heavy rain", 3.0, 9)], "timesofday string, rainfall_intensity string, temp double, temp_bin int"
    )
    model = E.preprocessor(df, ["timesofday", "rainfall_intensity", "temp", "temp_bin"]).fit(df)
    unseen = spark.createDataFrame([("Noon", "fog", 2.0, 1)], df.schema)
    rows = model.transform(df.union(unseen)).select(vector_to_array("features").alias("v")).collect()
    assert [list(r.v) for r in rows] == [[1, 0, 1, -1], [0, 1, 4, 1], [0, 0, -1, 0]]


def test_empty_constant_and_all_zero_inputs(spark):
    from ridepulse.operators import profile as P

    zeros = spark.createDataFrame([(0,), (0,)], "demand int")
    assert P.dispersion(zeros).first().dispersion is None
    assert [tuple(r) for r in P.histogram(zeros, "demand", 5).collect()] == [(0, 2)]
    empty = zeros.filter("demand > 0")
    assert P.zero_summary(empty).first().n == 0 and P.outlier_share(empty, 3).first().outliers == 0


def test_rows_alone_in_their_level_are_kept(spark):
    from ridepulse.operators import glm

    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0), ("b", 5.0), ("alone", 3.0)], "f string, y double")
    measured = glm.fit(rows, "y", factors=["f"], family="gaussian").influence(rows)
    assert glm.without_influential(measured, 5).filter("f = 'alone'").count() == 1


def test_a_forecast_time_keeps_its_entry_without_temperature(spark):
    from ridepulse.sources.files import combine_forecast

    entries = spark.createDataFrame([(1, 1, None, 80.0, 2.0, None), (0, 1, None, None, None, 0.5), (1, 2, None, None, None, 0.1)], "from_time long, at_time long, temp double, rhum double, wind_ms double, rain double")
    assert [(r.at_time, r.rhum, r.rain) for r in combine_forecast(entries).collect()] == [(1, 80.0, 0.5)]
