"""Designs with many levels against dense linear algebra, and fits with missing values."""

from __future__ import annotations

import math
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ridepulse.operators import glm as G
from ridepulse.operators import wide as W


@pytest.fixture(scope="module")
def sample():
    draw = np.random.default_rng(4)
    level, kind = draw.integers(0, 50, 3000), draw.integers(0, 3, 3000)
    x = draw.normal(2, 1, 3000).round(1)
    y = draw.poisson(np.exp(0.3 + 0.02 * level + 0.2 * kind + 0.1 * x))
    return pd.DataFrame({"i": range(3000), "g": [f"g{v:02d}" for v in level], "k": [f"k{v}" for v in kind], "x": x, "y": y})


@pytest.fixture(scope="module")
def frame(spark, sample):
    return spark.createDataFrame(sample).repartition(5).cache()


def dense(sample):
    dummies = [(sample[f] == v).astype(float) for f in ("g", "k") for v in sorted(sample[f].unique())[1:]]
    return np.column_stack([np.ones(len(sample)), *dummies, sample["x"]])


@pytest.mark.parametrize("family", ["gaussian", "negative_binomial"])
def test_fifty_levels_equal_the_dense_fit(sample, frame, family):
    narrow = G.fit(frame, "y", ["x"], ["g", "k"], family=family)
    fit = W.fit_wide(frame, "y", ["x"], ["g", "k"], family=family)
    assert fit.beta == pytest.approx(narrow.beta, abs=1e-6) and fit.design.names == narrow.design.names
    assert fit.scale == pytest.approx(narrow.scale) and fit.dropped == 0 and fit.n == 3000
    x, y = dense(sample), sample["y"].to_numpy(float)
    mu = x @ narrow.beta if family == "gaussian" else np.exp(x @ narrow.beta)
    w = np.ones_like(mu) if family == "gaussian" else mu / (1 + mu)
    h = w * np.einsum("ij,jk,ik->i", x, np.linalg.inv((x * w[:, None]).T @ x), x)
    rows = fit.influence(frame).orderBy("i").toPandas()
    assert rows["leverage"].to_numpy() == pytest.approx(h, abs=1e-9)
    assert rows["fitted"].to_numpy() == pytest.approx(mu, abs=1e-5)
    variance = np.ones_like(mu) if family == "gaussian" else mu + mu * mu
    studentized = (y - mu) / np.sqrt(variance * narrow.scale) / np.sqrt(1 - h)
    assert rows["cooks"].to_numpy() == pytest.approx(studentized**2 / x.shape[1] * h / (1 - h), abs=1e-6)
    assert fit.robust_errors() == pytest.approx(np.sqrt(np.diag(narrow.robust)), rel=1e-4)
    terms = fit.coefficients(frame.sparkSession, errors=True).collect()
    assert [t.term for t in terms] == narrow.design.names


@pytest.mark.parametrize("levels", [500, 5000])
def test_many_levels_settle(spark, levels):
    rows = spark.range(8 * levels).select(
        (F.col("id") % levels).cast("string").alias("g"),
        (F.floor(F.col("id") / levels) % 4).cast("string").alias("k"),
        (1 + F.pmod(F.xxhash64("id"), F.lit(5))).alias("y"),
    )
    fit = W.fit_wide(rows, "y", factors=["g", "k"])
    residual = fit.predict(rows).withColumn("s", F.col("residual") / (1 + F.col("fitted")))
    for factor in ("g", "k"):
        worst = residual.groupBy(factor).agg(F.sum("s").alias("s")).agg(F.max(F.abs("s"))).first()[0]
        assert worst < 1e-6, "the score of every level is zero"
    assert len(fit.beta) == levels + 3


def test_leverage_of_five_hundred_levels_within_a_minute(spark):
    rows = spark.range(6000).select((F.col("id") % 500).cast("string").alias("g"), (F.pmod(F.xxhash64("id"), F.lit(7)) + 1).alias("y"), "id")
    began = time.time()
    fit = W.fit_wide(rows, "y", factors=["g"], family="gaussian")
    found = fit.influence(rows).agg(F.sum("leverage"), F.max("leverage"), F.min("leverage"), F.count("cooks")).first()
    assert found[0] == pytest.approx(500) and found[1] == pytest.approx(found[2]) == pytest.approx(1 / 12) and found[3] == 6000
    assert time.time() - began < 60


def test_missing_values_leave_the_fit_and_are_counted(spark):
    rows = [("a", 1.0, 1.0), ("a", 2.0, 1.0), ("b", 3.0, 5.0), ("b", 4.0, 5.0), (None, 9.0, 9.0), ("a", None, 9.0), ("b", math.nan, 9.0), ("b", 1.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    for fit in (G.fit(df, "y", factors=["g"], family="gaussian"), W.fit_wide(df, "y", factors=["g"], family="gaussian")):
        # the row without a factor and the one without a target are out
        assert fit.dropped == 2 and fit.n == 6
        means = {"a": np.mean([1, 1, 9]), "b": np.mean([5, 5, 9])}
        assert list(fit.beta) == pytest.approx([means["a"], means["b"] - means["a"]])
        fitted = {r.g: r.fitted for r in fit.predict(df).collect()}
        assert fitted[None] is None and fitted["b"] == pytest.approx(means["b"])
    both = G.fit(df, "y", ["x"], family="gaussian")
    assert both.dropped == 3 and np.isfinite(both.beta).all()
    marked = both.influence(df).collect()
    assert sum(r.leverage is None or math.isnan(r.leverage) for r in marked) == 2
    for fit in (G.fit, W.fit_wide):
        with pytest.raises(ValueError, match="no complete rows"):
            fit(df.filter("y is null"), "y", ["x"])
    assert sum(r.fitted is None for r in W.fit_wide(df, "y", ["x"], family="gaussian").predict(df).collect()) == 2


def test_a_wide_fit_that_does_not_settle_raises(spark):
    rows = spark.createDataFrame([("a", 0.0), ("a", 0.0), ("b", 2.0)], "f string, y double")
    with pytest.raises(RuntimeError, match="still moves"):
        W.fit_wide(rows, "y", factors=["f"], max_steps=4)
