"""Properties of the demand models on the smallest tables."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from ridepulse.operators import models as M
from ridepulse.plans import models as plans


@pytest.fixture(scope="module")
def rows(spark, sf):
    return plans.prepared(spark, sf).filter("date < '2021-06-01'").cache()


def test_trees_beat_the_mean(rows):
    train, validation = rows.filter("k % 10 < 7"), rows.filter("k % 10 >= 7")
    # one predictor decides the target here
    train, validation = (d.withColumn("demand", F.col("hour") % 5) for d in (train, validation))
    base = M.metrics(M.mean_baseline(train, validation)).first()
    model = M.fit_model(train, ["hour", "temp"], M.boosted(5, 3, 0.5))
    assert M.metrics(model.transform(validation)).first().rmse < base.rmse


def test_importance_finds_the_used_predictor(rows):
    known = rows.withColumn("demand", F.col("hour") % 5)
    model = M.fit_model(known, ["hour", "temp"], M.forest(5, 5))
    found = {r.predictor: r.importance for r in M.permutation_importance(model, known, ["hour", "temp"], [F.col("k")], 1).collect()}
    assert found["hour"] > 0.2 and found["hour"] > 5 * abs(found["temp"])


def test_scores_and_filter(spark):
    df = spark.createDataFrame([("a", "train", 3, 1.0), ("a", "train", 1, 1.0), ("a", "validation", 0, 2.0)], "model string, part string, demand int, prediction double")
    table = M.score_table(M.metrics(df, ["model", "part"]))
    assert {(r.metric, round(r.train, 6), r.validation) for r in table.collect()} == {("RMSE", 1.414214, 2.0), ("MAE", 1.0, 2.0)}
    assert M.filter_scores(table, "A", "ma").count() == 1 and M.filter_scores(table, "b").count() == 0


def test_forecast_has_fifteen_rounded_hours(spark, sf):
    _, found = plans.forecast_hours(spark, sf)
    rows = found.collect()
    assert len(rows) == 15 and found.schema["Predicted Demand"].dataType.simpleString() == "int"
    assert [r["High Demand"] for r in rows] == [r["Predicted Demand"] > 8 for r in rows]


def test_patience_keeps_the_best_prefix():
    assert M.patient_length([5, 4, 3, 3.5, 3.2, 3.1], 3) == (3, True)
    assert M.patient_length([5, 4, 3, 3.5, 3.2, 2.9], 4) == (6, False)
    assert M.patient_length([1, 2, 3], 5) == (1, False)


def test_patient_fit_stops_where_the_held_out_rows_say(rows):
    known = rows.withColumn("demand", (F.col("hour") % 5).cast("double"))
    ready = M.preprocessor(known, ["hour", "temp"]).fit(known).transform(known).select("features", M.TARGET, "k")
    train, held_out = ready.filter("k % 3 <> 0").cache(), ready.filter("k % 3 = 0").cache()
    model, keep = M.fit_patiently(train, held_out, rounds=12, patience=2, first=4, depth=2, rate=0.9)
    losses = model.evaluateEachIteration(held_out, "squared")
    assert keep == M.patient_length(losses, 2)[0] and losses[keep - 1] <= min(losses[:keep])


def test_patience_that_is_nearly_seen_is_not_paid_twice(monkeypatch):
    lengths = []

    class Fit:
        def __init__(self, length):
            self.length = length
            lengths.append(length)

        def fit(self, train):
            return self

        def evaluateEachIteration(self, held_out, loss):  # noqa: N802 - Spark's name
            return held_out[: self.length]

    monkeypatch.setattr(M, "boosted", Fit)
    falls = [100.0 - i for i in range(21)]
    assert M.fit_patiently(None, [*falls, *[90.0] * 500])[1] == 21 and lengths == [48, 51]
    lengths.clear()
    assert M.fit_patiently(None, [*falls, *[90.0] * 28, 5.0, *[90.0] * 500])[1] == 50 and lengths == [48, 51, 102]
    lengths.clear()
    assert M.fit_patiently(None, [1000.0 - i for i in range(1000)], rounds=200)[1] == 200 and lengths == [48, 96, 192, 200]


def test_folds_are_fitted_side_by_side(rows, monkeypatch):
    known = rows.withColumn("demand", (F.col("hour") % 5).cast("double"))
    args, params = (known, ["hour", "temp"], F.col("k"), 3), {"rounds": 2, "patience": 1, "first": 2, "depth": 2}
    one_by_one = M.kfold_scores(*args, parallelism=1, **params).collect()
    together, fit = threading.Barrier(3, timeout=60), M.fit_patiently
    monkeypatch.setattr(M, "fit_patiently", lambda *a, **k: (together.wait(), fit(*a, **k))[1])
    assert M.kfold_scores(*args, **params).collect() == one_by_one and [r.fold for r in one_by_one] == [0, 1, 2]


def test_every_row_lends_once_a_repeat(rows):
    few = rows.select("k", "temp").limit(997)
    lent = M.with_donors(few, ["k", "temp"], [F.col("k")], 3).groupBy("_repeat").agg(
        F.count("*").alias("n"), F.count_distinct("_other_k").alias("donors"), F.count_if(F.col("k") == F.col("_other_k")).alias("own")
    )
    assert all(r.n == r.donors == 997 and r.own < 20 for r in lent.collect()) and lent.count() == 3
    assert M.with_donors(few.filter("false"), ["temp"], [F.col("k")], 2).count() == 0


@pytest.mark.parametrize("n", [1, 2, 12, 30, 97, 360])
def test_bijection_of_positions(spark, n):
    for seed in range(4):
        got = [r[0] for r in spark.range(n).select(M.bijection(F.col("id"), n, seed)).collect()]
        assert sorted(got) == list(range(n))


def test_the_first_trees_of_a_forest(rows):
    known = rows.withColumn("demand", (F.col("hour") % 5).cast("double"))
    ready = M.preprocessor(known, ["hour", "temp"]).fit(known).transform(known).select("features", M.TARGET)
    model = M.forest(6, 4).fit(ready)
    own = [m.setPredictionCol(f"p{i}").setFeaturesCol("features") for i, m in enumerate(model.trees)]
    scored = ready
    for tree in own[:2]:
        scored = tree.transform(scored)
    want = scored.agg(F.sqrt(F.avg((F.col(M.TARGET) - (F.col("p0") + F.col("p1")) / 2) ** 2))).first()[0]
    errors = M.nested_errors(model, ready, [2, 6])
    assert errors[2] == pytest.approx(want) and errors[6] == pytest.approx(M.metrics(model.transform(ready)).first().rmse)


def test_halving_finds_the_best_point_of_the_whole_grid(rows):
    known = rows.withColumn("demand", (F.col("hour") % 5).cast("double"))
    axes, trees = {"maxDepth": [1, 2, 6], "minInstancesPerNode": [1, 50]}, [2, 6]
    one = M.halving_search(known, ["hour", "temp"], axes, trees, F.col("k"), folds=2, rungs=1).collect()
    halved = M.halving_search(known, ["hour", "temp"], axes, trees, F.col("k"), folds=2, rungs=2).collect()
    assert len(one) == len(halved) == 12 and sorted(r.rung for r in halved) == [0] * 8 + [1] * 4
    best = min(one, key=lambda r: r.rmse)
    last = min((r for r in halved if r.rung == 1), key=lambda r: r.rmse)
    assert tuple(last)[:3] == tuple(best)[:3] and last.rmse == pytest.approx(best.rmse)
