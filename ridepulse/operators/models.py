"""Demand models, their scores and the forecast."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product
from math import gcd
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.weather import is_high_demand, round_half_away
from ..session import settle
from .encoders import hash_draw, preprocessor, with_fold
from .features import forecast_features
from .ranking import BUCKET_ROWS, ordinal_shuffled

TARGET = "demand"
WEATHER = ["temp", "rhum", "wdsp", "rain"]
# The predictors of the forecast and of the explained model.
FORECAST = ["temp", "rhum", "dayofweek", "timesofday", "wdsp", "rainfall_intensity", "working_day", "hour", "season"]
ALL = ["temp_r", "rhum", "holiday", "dayofweek", "timesofday", "wind_speed_group", "rainfall_intensity", "peak", "working_day"]


def mean_baseline(train: DataFrame, df: DataFrame, target: str = TARGET) -> DataFrame:
    """The training mean as the prediction of every row."""
    return df.withColumn("prediction", train.agg(F.avg(target)).scalar())


def linear(predictors: Sequence[str] = WEATHER, target: str = TARGET) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(predictors), outputCol="features")
    return Pipeline(stages=[assembler, LinearRegression(labelCol=target, solver="normal")])


def forest(trees: int = 100, depth: int = 10, features: str = "all", target: str = TARGET, **more) -> RandomForestRegressor:
    """Random forest; ``features`` is the share of columns tried per node."""
    return RandomForestRegressor(
        labelCol=target, numTrees=trees, maxDepth=depth, featureSubsetStrategy=features, seed=42, **more
    )


def boosted(
    rounds: int = 100,
    depth: int = 3,
    rate: float = 0.1,
    subsample: float = 1.0,
    columns: str = "all",
    min_gain: float = 0.0,
    target: str = TARGET,
    validation: str | None = None,
) -> GBTRegressor:
    """Boosted trees; with a validation flag column training stops once the flagged rows stop improving."""
    model = GBTRegressor(
        labelCol=target,
        maxIter=rounds,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=subsample,
        featureSubsetStrategy=columns,
        minInfoGain=min_gain,
        seed=42,
    )
    return model.setValidationIndicatorCol(validation) if validation else model


def fit_model(train: DataFrame, predictors: Sequence[str], estimator: Estimator) -> PipelineModel:
    """Preprocessing of the predictors and the estimator as one saved-able pipeline."""
    stages = [*preprocessor(train, predictors).getStages(), estimator]
    return Pipeline(stages=stages).fit(train)


def metrics(predicted: DataFrame, by: Sequence[str] = (), target: str = TARGET) -> DataFrame:
    """RMSE, MAE and RMSE over the target's range."""
    error = F.col(target) - F.col("prediction")
    scored = predicted.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.max(target) - F.min(target)).alias("_range"),
    )
    return scored.withColumn("nrmse", F.try_divide("rmse", F.col("_range").cast("double"))).drop("_range")


def train_validation_scores(model: PipelineModel, name: str, train: DataFrame, validation: DataFrame) -> DataFrame:
    """Score rows (model, metric, train, validation) of one fitted model, in one job."""
    both = train.withColumn("part", F.lit("train")).unionByName(validation.withColumn("part", F.lit("validation")))
    scored = metrics(model.transform(both), ["part"])
    return score_table(scored.withColumn("model", F.lit(name)))


def score_table(scored: DataFrame) -> DataFrame:
    """Turn metrics per (model, part) into one row per model and metric with a column per part."""
    rows = F.array(
        F.struct(F.lit("RMSE").alias("metric"), F.col("rmse").alias("value")),
        F.struct(F.lit("MAE").alias("metric"), F.col("mae").alias("value")),
    )
    long = scored.select("model", "part", F.inline(rows))
    return long.groupBy("model", "metric").agg(
        F.max(F.when(F.col("part") == "train", F.col("value"))).alias("train"),
        F.max(F.when(F.col("part") == "validation", F.col("value"))).alias("validation"),
    )


def filter_scores(scores: DataFrame, model: str = "", metric: str = "") -> DataFrame:
    """Scores whose model and metric contain the given text, whatever its case."""
    return scores.filter(F.upper("model").contains(model.upper()) & F.upper("metric").contains(metric.upper()))


def against_baseline(scores: DataFrame, train: DataFrame, validation: DataFrame) -> DataFrame:
    """Score rows beside those of the training mean, and whether they are better."""
    both = train.withColumn("part", F.lit("train")).unionByName(validation.withColumn("part", F.lit("validation")))
    base = score_table(metrics(mean_baseline(train, both), ["part"]).withColumn("model", F.lit("mean")))
    named = base.select("metric", F.col("train").alias("baseline_train"), F.col("validation").alias("baseline_validation"))
    better = {f"better_{part}": F.col(part) < F.col(f"baseline_{part}") for part in ("train", "validation")}
    return scores.join(named, "metric").withColumns(better)


def grid_search(
    df: DataFrame,
    predictors: Sequence[str],
    axes: Mapping[str, Sequence],
    key: Column,
    folds: int = 3,
    parallelism: int = 2,
) -> CrossValidatorModel:
    """Forest settings with the best cross-validated RMSE. Preprocessing runs once, before the folds.

    ``axes`` are the values to try of any parameters of Spark's forest, such as ``maxDepth``, ``numTrees``,
    ``featureSubsetStrategy`` or ``minInstancesPerNode``.
    """
    stages = preprocessor(df, predictors)
    ready = with_fold(stages.fit(df).transform(df), hash_draw(key, 2022, folds), folds).select("features", TARGET, "fold")
    model = forest()
    builder = ParamGridBuilder()
    for name, values in axes.items():
        builder = builder.addGrid(model.getParam(name), list(values))
    grid = builder.build()
    search = CrossValidator(
        estimator=model,
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol=TARGET, metricName="rmse"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=42,
    )
    return search.fit(ready)


def first_trees(model: RandomForestRegressionModel, trees: int) -> RandomForestRegressionModel:
    """The forest of a fitted forest's first trees."""
    context = SparkContext._active_spark_context
    kind, own = context._jvm.org.apache.spark.ml.regression, model._java_obj.trees()
    part = context._gateway.new_array(kind.DecisionTreeRegressionModel, trees)
    for i in range(trees):
        part[i] = own[i]
    found = RandomForestRegressionModel(kind.RandomForestRegressionModel(model.uid, part, model.numFeatures))
    # a forest divides by the number of trees that it was told
    found._set(numTrees=trees).setFeaturesCol(model.getFeaturesCol())._transfer_params_to_java()
    return found


def nested_errors(model: RandomForestRegressionModel, df: DataFrame, trees: Sequence[int]) -> dict[int, float]:
    """RMSE of the first trees of one forest, for several numbers of trees, in one pass."""
    for n in trees:
        df = first_trees(model, n).setPredictionCol(f"_first_{n}").transform(df)
    errors = [F.sqrt(F.avg((F.col(TARGET) - F.col(f"_first_{n}")) ** 2)).alias(str(n)) for n in trees]
    row = df.agg(*errors).first()
    return {n: row[str(n)] for n in trees}


def halving_search(
    df: DataFrame,
    predictors: Sequence[str],
    axes: Mapping[str, Sequence],
    trees: Sequence[int],
    key: Column,
    folds: int = 3,
    rungs: int = 3,
    share: int = 3,
) -> DataFrame:
    """Every point of a grid (the axes and ``trees``) with the last rung it reached and its cross-validated RMSE there.

    The first rung takes a sample of the rows, each later one ``share`` times as many that include those before, the last
    one all rows; the best 1/``share`` of the points go on to the next. The points that differ in the number of trees alone
    come from one fit. Samples and folds follow from a hash of the key. One row per point reaches the driver.
    """
    names, sample = list(axes), hash_draw(key, 7, share ** (rungs - 1))
    stages = preprocessor(df, predictors)
    ready = with_fold(stages.fit(df).transform(df).withColumn("_sample", sample), hash_draw(key, 2022, folds), folds)
    ready = settle(ready.select("features", TARGET, "fold", "_sample"), "grid-rows")
    alive = [(*setting, n) for setting in product(*axes.values()) for n in trees]
    found: dict[tuple, tuple[int, float]] = {}
    for rung in range(rungs):
        rows = ready.filter(F.col("_sample") < share**rung)
        settings: dict[tuple, list[int]] = {}
        for *setting, n in alive:
            settings.setdefault(tuple(setting), []).append(n)
        for setting, numbers in settings.items():
            model, errors = forest(max(numbers)), {n: [] for n in numbers}
            for name, value in zip(names, setting):
                model.set(model.getParam(name), value)
            for fold in range(folds):
                fitted = model.fit(rows.filter(F.col("fold") != fold))
                for n, rmse in nested_errors(fitted, rows.filter(F.col("fold") == fold), numbers).items():
                    errors[n].append(rmse)
            for n in numbers:
                found[(*setting, n)] = rung, sum(errors[n]) / folds
        alive = sorted(alive, key=lambda p: (found[p][1], p))[: -(-len(alive) // share)]
    values = [*axes.values(), trees]
    kinds = ["int" if isinstance(v[0], int) else "double" if isinstance(v[0], float) else "string" for v in values]
    fields = ", ".join(f"{name} {kind}" for name, kind in zip([*names, "numTrees"], kinds))
    return df.sparkSession.createDataFrame([(*point, *score) for point, score in found.items()], f"{fields}, rung int, rmse double")


def patient_length(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds to keep: up to the least loss before ``patience`` rounds bring no gain; and whether that point was seen."""
    best = 0
    for at, loss in enumerate(losses):
        if loss < losses[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_patiently(
    train: DataFrame, held_out: DataFrame, rounds: int = 5000, patience: int = 30, first: int = 48, **params
) -> tuple[GBTRegressionModel, int]:
    """Boosted trees and the number of rounds to keep by the loss on the held-out rows.

    Every round of a fit is scored in one pass over the held-out rows. Where ``patience`` rounds without gain were not
    seen, the fit is made again, as the same seed grows the same trees first: with the rounds that patience still lacks,
    where half of it was seen, and where that was tried or less was seen, with twice the rounds.
    """
    length, extended = min(max(first, patience + 1), rounds), False
    while True:
        model = boosted(length, **params).fit(train)
        keep, seen = patient_length(model.evaluateEachIteration(held_out, "squared"), patience)
        if seen or length == rounds:
            return model, keep
        extended = not extended and 2 * (length - keep) >= patience
        length = min(keep + patience if extended else 2 * length, rounds)


def kfold_scores(df: DataFrame, predictors: Sequence[str], key: Column, folds: int = 3, parallelism: int = 8, **params) -> DataFrame:
    """Per fold: rounds kept by patience on its held-out rows, and RMSE and MAE of those rounds on both parts.

    Up to ``parallelism`` folds are fitted at the same time, as the jobs of a round are short and wait for each other.
    """
    cut = with_fold(df, hash_draw(key, 2022, folds), folds)

    def scores(fold: int) -> tuple:
        train, held_out = cut.filter(F.col("fold") != fold), cut.filter(F.col("fold") == fold)
        ready = preprocessor(train, predictors).fit(train)
        train, held_out = (settle(ready.transform(part).select("features", TARGET), "fold") for part in (train, held_out))
        model, keep = fit_patiently(train, held_out, **params)
        errors = [
            float(model.evaluateEachIteration(part, loss)[keep - 1]) for loss in ("squared", "absolute") for part in (train, held_out)
        ]
        return fold, keep, errors[0] ** 0.5, errors[1] ** 0.5, errors[2], errors[3]

    with ThreadPool(max(1, min(folds, parallelism))) as pool:
        found = pool.map(inheritable_thread_target(df.sparkSession)(scores), range(folds))
    names = "fold int, rounds_kept int, rmse_train double, rmse_validation double, mae_train double, mae_validation double"
    return df.sparkSession.createDataFrame(found, names)


def mean_over_folds(scores: DataFrame, model: str) -> DataFrame:
    """Fold scores as one row per metric, in the form of ``score_table``."""
    parts = [
        scores.agg(F.avg(f"rmse_{part}").alias("rmse"), F.avg(f"mae_{part}").alias("mae")).withColumn("part", F.lit(part))
        for part in ("train", "validation")
    ]
    return score_table(reduce(DataFrame.unionByName, parts).withColumn("model", F.lit(model)))


def bijection(at: Column, rows: int, seed: int) -> Column:
    """Another position for each of the positions 0 to ``rows`` - 1, no two the same, by arithmetic alone.

    Multiplication by a number without a factor in common with ``rows``, and a shift, are one-to-one on the remainders.
    """
    draw = random.Random(seed)
    factor = next(f for f in iter(lambda: draw.randrange(1, rows + 1), None) if gcd(f, rows) == 1)
    shift = draw.randrange(rows)
    wide = "decimal(38,0)" if rows > 1 << 31 else "long"
    return F.pmod(at.cast(wide) * F.lit(factor).cast(wide) + F.lit(shift).cast(wide), F.lit(rows).cast(wide)).cast("long")


def with_donors(df: DataFrame, columns: Sequence[str], key: Sequence[Column], repeats: int) -> DataFrame:
    """Every row ``repeats`` times, each with the columns of another row as ``_other_<column>``; every row lends once a repeat.

    Rows are numbered once, in a pseudo-random order of their key, and the numbering is written; a repeat then names each
    row's donor by arithmetic and finds it by one equi-join.
    """
    rows = df.count()
    if not rows:
        return df.withColumn("_repeat", F.lit(0)).withColumns({f"_other_{c}": F.col(c) for c in columns})
    numbered = settle(ordinal_shuffled(df, key, 2022, "_at", rows // BUCKET_ROWS + 1), "numbered")
    numbered = numbered.withColumn("_at", F.col("_at") - 1)
    donors = numbered.select(F.col("_at").alias("_donor"), *[F.col(c).alias(f"_other_{c}") for c in columns])
    named = [F.struct(F.lit(k).alias("_repeat"), bijection(F.col("_at"), rows, k).alias("_donor")) for k in range(repeats)]
    return numbered.select("*", F.inline(F.array(*named))).join(donors, "_donor").drop("_at", "_donor")


def permutation_importance(
    model: PipelineModel, df: DataFrame, predictors: Sequence[str], key: Sequence[Column], repeats: int = 10
) -> DataFrame:
    """Mean rise of the RMSE when one predictor is shuffled over the rows.

    The rows without a shuffle are scored once; one join with the donors serves all predictors and repeats.
    """
    base = df.select(*predictors, TARGET, *[k.alias(f"_k{i}") for i, k in enumerate(key)])
    mixed = with_donors(base, predictors, [F.col(f"_k{i}") for i in range(len(key))], repeats)
    options = []
    for swapped in predictors:
        values = [F.col(f"_other_{c}").alias(c) if c == swapped else F.col(c) for c in predictors]
        options.append(F.struct(F.lit(swapped).alias("_swap"), *values))
    variants = mixed.select("_repeat", TARGET, F.inline(F.array(*options)))
    scores = metrics(model.transform(variants), ["_repeat", "_swap"])
    plain = metrics(model.transform(base)).select("rmse").scalar()
    shuffled = scores.groupBy(F.col("_swap").alias("predictor")).agg(F.avg("rmse").alias("_shuffled"))
    return shuffled.select("predictor", (F.col("_shuffled") - plain).alias("importance"))


def actual_and_predicted(predicted: DataFrame) -> DataFrame:
    """Observed and predicted demand per day, as mean and as sum."""
    return predicted.groupBy("date").agg(
        F.avg(TARGET).alias("actual_mean"),
        F.avg("prediction").alias("predicted_mean"),
        F.sum(TARGET).alias("actual_sum"),
        F.sum("prediction").alias("predicted_sum"),
    )


def present(predicted: DataFrame) -> DataFrame:
    """Forecast columns under their report names."""
    return predicted.select(
        F.col("date").alias("Date"),
        F.col("hour").alias("Hour"),
        F.col("temp").alias("Temperature"),
        F.col("rhum").alias("Relative Humidity"),
        F.col("wdsp").alias("Wind Speed"),
        F.col("rainfall_intensity").alias("Rainfall Intensity"),
        F.col("predicted").alias("Predicted Demand"),
    )


def forecast_demand(model: PipelineModel, forecast: DataFrame, hours: int = 15) -> DataFrame:
    """Demand of the next hours, rounded, with the hours of high demand marked."""
    predicted = model.transform(forecast_features(forecast))
    predicted = predicted.withColumn("predicted", round_half_away(F.col("prediction")))
    soonest = predicted.orderBy("at_time").limit(hours)
    return present(soonest).withColumn("High Demand", is_high_demand(F.col("Predicted Demand")))
