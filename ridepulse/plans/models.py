"""Queries on encoders, regressions and demand models."""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import domain_ordinal
from ..operators import encoders as E
from ..operators import glm as G
from ..operators import hourly as H
from ..operators import models as M
from ..operators import wide as W
from ..session import scratch, settle
from ..sources.files import combine_forecast
from . import data
from .catalog import query
from .files import forecast_files
from .hours import TEST, TRAIN
from .profiles import rounded

def hour_key():
    return (F.datediff("date", F.lit("2021-03-01").cast("date")) * 24 + F.col("hour")).cast("long")


def key_column(df):
    return df.withColumn("k", hour_key())


K = "(date_diff('day', date '2021-03-01', date) * 24 + hour)"


def prepared(spark, sf):
    """Feature rows written once; every model step reads them from there."""
    return settle(key_column(data.features(spark, sf)), "features")


def split(spark, sf):
    return E.split(prepared(spark, sf), (F.col("k") * 7919) % 100)


# -- encoders ----------------------------------------------------------------------------------------------------------


@query(
    "E1_kmeans_bins",
    "select temp_bin, rhum_bin, count(*) as n, min(temp) as temp_from, max(temp) as temp_to from binned group by 1, 2",
)
def kmeans_bins(spark, sf):
    """Ten temperature and five humidity bins learnt on the training dates and applied to all hours."""
    return data.binned_features(spark, sf).groupBy("temp_bin", "rhum_bin").agg(
        F.count("*").alias("n"), F.min("temp").alias("temp_from"), F.max("temp").alias("temp_to")
    )


LEVELS = ["Afternoon", "Evening", "Morning", "Night"]


@query(
    "E2_one_hot",
    "select k, " + ", ".join(f"case when timesofday = '{v}' and hour < 23 then 1e0 else 0e0 end as hot_{i}" for i, v in enumerate(LEVELS))
    + f" from (select *, {K} as k from features)",
)
def one_hot(spark, sf):
    """Fitted on the hours before 23; the last hour gets a level the fit never saw."""
    f = key_column(data.features(spark, sf))
    seen = f.withColumn("timesofday", F.when(F.col("hour") < 23, F.col("timesofday")).otherwise("Late"))
    model = E.preprocessor(f, ["timesofday"]).fit(f.filter("hour < 23"))
    hot = vector_to_array(F.col("features"))
    return model.transform(seen).select("k", *[hot[i].alias(f"hot_{i}") for i in range(4)])


@query(
    "E3_standardized",
    f"""select {K} as k, """
    + ", ".join(f"round(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 6) as {c}_std" for c in ("temp", "rhum", "wdsp"))
    + " from fact",
)
def standardized(spark, sf):
    columns = ["temp", "rhum", "wdsp"]
    scaled = E.standardized(key_column(data.fact(spark, sf)), columns)
    return rounded(scaled.select("k", *[f"{c}_std" for c in columns]), *[f"{c}_std" for c in columns])


@query(
    "E4_ordinal",
    """select wind_speed_group, rainfall_intensity,
       case wind_speed_group when 'Calm / Light Breeze' then 0 when 'Breeze' then 1 when 'Moderate Breeze' then 2
        when 'Strong Breeze / Near Gale' then 3 when 'Gale / Storm' then 4 else -1 end as wind,
       case rainfall_intensity when 'no rain' then 0 when 'drizzle' then 1 when 'light rain' then 2 when 'moderate rain' then 3
        when 'heavy rain' then 4 else -1 end as rain,
       -1 as unknown, count(*) as n from features group by all""",
)
def ordinal(spark, sf):
    return (
        data.features(spark, sf)
        .groupBy("wind_speed_group", "rainfall_intensity")
        .agg(F.count("*").alias("n"))
        .select(
            "*",
            domain_ordinal("wind_speed_group").alias("wind"),
            domain_ordinal("rainfall_intensity").alias("rain"),
            domain_ordinal("season", F.col("rainfall_intensity")).alias("unknown"),
        )
    )


@query(
    "E5_preprocessor",
    f"""select {K} as k, case when working_day then 0e0 else 1e0 end as working_no, case when working_day then 1e0 else 0e0 end as working_yes,
        cast(case rainfall_intensity when 'no rain' then 0 when 'drizzle' then 1 when 'light rain' then 2 when 'moderate rain' then 3 else 4 end as double) as rain_level,
        round((temp - avg(temp) over ()) / stddev_pop(temp) over (), 6) as temp_scaled from features""",
)
def preprocessed(spark, sf):
    """A predictor on no list (wind_bft) is dropped without a word."""
    f = prepared(spark, sf)
    names = ["working_day", "rainfall_intensity", "temp", "wind_bft"]
    vectors = E.preprocessor(f, names).fit(f).transform(f).select("k", vector_to_array("features").alias("v"))
    return vectors.select(
        "k",
        F.col("v")[0].alias("working_no"),
        F.col("v")[1].alias("working_yes"),
        F.col("v")[2].alias("rain_level"),
        F.round(F.col("v")[3], 6).alias("temp_scaled"),
    )


@query(
    "E6_polynomial",
    f"""select {K} as k, round(temp, 6) as p0, round(temp*temp, 6) as p1, round(temp*temp*temp, 6) as p2, round(cast(wdsp as double), 6) as p3,
        round(temp*wdsp, 6) as p4, round(temp*temp*wdsp, 6) as p5, round(cast(wdsp*wdsp as double), 6) as p6,
        round(temp*wdsp*wdsp, 6) as p7, round(cast(wdsp*wdsp*wdsp as double), 6) as p8 from fact""",
)
def polynomial(spark, sf):
    expanded = E.polynomial(key_column(data.fact(spark, sf)), ["temp", "wdsp"])
    v = vector_to_array(F.col("poly"))
    return expanded.select("k", *[F.round(v[i], 6).alias(f"p{i}") for i in range(9)])


def _power_sql(p: str, v: str = "v") -> str:
    """The transform of values that are not negative."""
    return f"(case when abs({p}) < 1e-12 then ln(1 + {v}) else (exp({p} * ln(1 + {v})) - 1) / {p} end)"


#: The same search in SQL: 21 points over a bracket that grows until its best point is inside, then again around it.
POWER_SQL = f"""with recursive amounts as (select cast(demand as double) as v, count(*) as n from fact group by 1),
    middle as (select sum(v * n) / sum(n) as m, sum(n) as total, sum(n * ln(1 + v)) as jacobian from amounts),
    search as (select 0 as step, -2e0 as low, 2e0 as high, false as held, cast(null as double) as best
     union all select step + 1,
      case when held or i not in (0, 20) then best - (high - low) / 20 when i = 0 then low - 2 * (high - low) else low end,
      case when held or i not in (0, 20) then best + (high - low) / 20 when i = 0 then high else high + 2 * (high - low) end,
      held or i not in (0, 20), best from (
      select step, low, high, held, arg_max(p, score) as best, arg_max(i, score) as i from (
       select step, low, high, held, i, p, any_value(total) / -2e0 * ln(sum(n * t * t) / any_value(total) - (sum(n * t) / any_value(total)) ** 2)
         + (p - 1) * any_value(jacobian) as score
       from (select *, {_power_sql("p")} - {_power_sql("p", "m")} as t from (
        select step, low, high, held, i, low + (high - low) / 20 * i as p from search, range(21) r(i) where not held or high - low > 5e-6) points, amounts, middle)
       group by step, low, high, held, i, p) group by step, low, high, held))
    select round(any_value(p), 4) as power, round(sum((v - a) ** 3) / count(*) / (sum((v - a) ** 2) / count(*)) ** 1.5, 4) as skew_before,
     round(sum((t - b) ** 3) / count(*) / (sum((t - b) ** 2) / count(*)) ** 1.5, 4) as skew_after, count(*) as n
    from (select *, avg(v) over () as a, avg(t) over () as b from (select v, p, {_power_sql("p")} as t
     from (select cast(demand as double) as v from fact), (select arg_max(best, step) as p from search)))"""


@query("E7_yeo_johnson", POWER_SQL)
def yeo_johnson(spark, sf):
    f = settle(data.fact(spark, sf).select("demand"), "demand")
    power = E.yeo_johnson_power(f, "demand")
    changed = E.yeo_johnson(F.col("demand").cast("double"), power)
    return f.agg(
        F.round(F.lit(power), 4).alias("power"),
        F.round(F.skewness("demand"), 4).alias("skew_before"),
        F.round(F.skewness(changed), 4).alias("skew_after"),
        F.count("*").alias("n"),
    )


@query("E8_split", f"select {K} as k, demand, ({K} * 7919) % 100 < 70 as train from fact")
def split_rows(spark, sf):
    train, validation = E.split(key_column(data.fact(spark, sf)), (F.col("k") * 7919) % 100)
    both = train.withColumn("train", F.lit(True)).unionByName(validation.withColumn("train", F.lit(False)))
    return both.select("k", "demand", "train")


@query("E9_folds", f"select cast(({K} * 7919) % 5 as integer) as fold, count(*) as n from fact group by 1")
def folds(spark, sf):
    return E.with_fold(key_column(data.fact(spark, sf)), F.col("k") * 7919, 5).groupBy("fold").agg(F.count("*").alias("n"))


# -- baselines and linear models ---------------------------------------------------------------------------------------


@query(
    "M1_mean_baseline",
    f"""select {K} as k, demand, (select avg(demand) from fact where ({K} * 7919) % 100 < 70) as prediction
        from fact where ({K} * 7919) % 100 >= 70""",
)
def mean_baseline(spark, sf):
    train, validation = split(spark, sf)
    return M.mean_baseline(train, validation).select("k", "demand", "prediction")


@query(
    "M2_linear_one_predictor",
    "select round(regr_slope(demand, temp), 6) as slope, round(regr_intercept(demand, temp), 6) as intercept from fact",
)
def linear_one(spark, sf):
    fitted = M.linear(["temp"]).fit(data.fact(spark, sf).select("temp", "demand")).stages[-1]
    return spark.range(1).select(
        F.round(F.lit(float(fitted.coefficients[0])), 6).alias("slope"), F.round(F.lit(float(fitted.intercept)), 6).alias("intercept")
    )


def orthogonal_sql(terms: list[str]) -> str:
    """Least squares by making each term orthogonal to the ones before it on the training rows."""
    named = ", ".join(f"cast({term} as double) as t{i}" for i, term in enumerate(terms, 1))
    sql = f"(select demand as y, ({K} * 7919) % 100 < 70 as tr, {named} from fact)"
    for i in range(1, len(terms) + 1):
        parts = "".join(f" - sum(t{i} * z{j}) filter (where tr) over () / sum(z{j} * z{j}) filter (where tr) over () * z{j}" for j in range(1, i))
        sql = f"(select *, t{i} - avg(t{i}) filter (where tr) over (){parts} as z{i} from {sql})"
    fit = "".join(f" + sum(y * z{j}) filter (where tr) over () / sum(z{j} * z{j}) filter (where tr) over () * z{j}" for j in range(1, len(terms) + 1))
    return f"(select tr, y, avg(y) filter (where tr) over (){fit} as p from {sql})"


def fitted_sql(model: str, terms: list[str], digits: int) -> str:
    """Both errors on both parts of the least-squares fit."""
    return f"""select '{model}' as model, unnest(['RMSE', 'MAE']) as metric,
        unnest([round(sqrt(avg((y - p) * (y - p)) filter (where tr)), {digits}), round(avg(abs(y - p)) filter (where tr), {digits})]) as train,
        unnest([round(sqrt(avg((y - p) * (y - p)) filter (where not tr)), {digits}), round(avg(abs(y - p)) filter (where not tr), {digits})]) as validation
        from {orthogonal_sql(terms)}"""


@query(
    "M2_linear_weather",
    fitted_sql("linear regression", M.WEATHER, 5),
)
def linear_weather(spark, sf):
    train, validation = split(spark, sf)
    scores = M.train_validation_scores(M.linear().fit(train), "linear regression", train, validation)
    return rounded_to(scores, 5)


def rounded_to(scores, digits):
    return scores.withColumns({c: F.round(c, digits) for c in ("train", "validation")})


# centred and scaled, the same space of cubics is far from singular
_CENTRED = ["(temp - 7.5e0) / 10", "(wdsp - 30) / 2e1", "(rhum - 70) / 2e1"]
CUBICS = [" * ".join(f"({x})" for x in c) for d in (1, 2, 3) for c in combinations_with_replacement(_CENTRED, d)]


@query("M2_polynomial_regression", fitted_sql("polynomial regression", CUBICS, 4))
def polynomial_regression(spark, sf):
    """Least squares on all products of temperature, wind and humidity up to the third degree."""
    train, validation = split(spark, sf)
    stages = [
        VectorAssembler(inputCols=["temp", "wdsp", "rhum"], outputCol="v"),
        PolynomialExpansion(degree=3, inputCol="v", outputCol="features"),
        LinearRegression(labelCol="demand"),
    ]
    scores = M.train_validation_scores(Pipeline(stages=stages).fit(train), "polynomial regression", train, validation)
    return rounded_to(scores, 4)


def beaten_sql(*models: str, part: str = f"({K} * 7919) % 100 < 70") -> str:
    """Every model is better than the training mean, whose errors these are."""
    def errors(rows: str) -> str:
        return f"[sqrt(avg((y - m) * (y - m)) filter (where {rows})), avg(abs(y - m)) filter (where {rows})]"

    names = ", ".join(f"'{m}'" for m in models)
    return f"""select model, metric, round(a, 6) as baseline_train, round(b, 6) as baseline_validation, true as better_train, true as better_validation
        from (select unnest(['RMSE', 'MAE']) as metric, unnest({errors("tr")}) as a, unnest({errors("not tr")}) as b from (
         select y, tr, avg(y) filter (where tr) over () as m from (select demand as y, {part} as tr from fact))),
        (select unnest([{names}]) as model)"""


def beside_baseline(scores, train, validation):
    """The scores themselves differ between tree libraries; that they beat the mean does not."""
    beside = M.against_baseline(scores, train, validation).drop("train", "validation")
    return beside.withColumns({c: F.round(c, 6) for c in ("baseline_train", "baseline_validation")})


_KEPT: dict[tuple[str, str, str], str] = {}


def kept(spark, sf, name, make):
    """The path of something that ``make`` writes there once per application and set of tables: a model, its scores."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _KEPT:
        path = scratch(spark, name)
        make(path)
        _KEPT[key] = path
    return _KEPT[key]


def kept_scores(spark, sf, name, make):
    return spark.read.parquet(kept(spark, sf, name, lambda path: make().write.parquet(path)))


def forest_scores(spark, sf):
    def make():
        train, validation = split(spark, sf)
        return M.train_validation_scores(M.fit_model(train, M.ALL, M.forest(100, 10)), "random forest", train, validation)

    return kept_scores(spark, sf, "forest-scores", make)


FEATURE_SETS = [
    ("weather only", M.WEATHER, (100, 5)),
    ("with hour", [*M.ALL, "hour"], (100, 10)),
    ("season and wind", [*M.ALL[:5], "wdsp", "hour", "season"], (100, 10, "sqrt")),
]


def feature_set_scores(spark, sf):
    def make():
        train, validation = split(spark, sf)
        scores = [
            M.train_validation_scores(M.fit_model(train, p, M.forest(*size)), f"random forest, {n}", train, validation)
            for n, p, size in FEATURE_SETS
        ]
        return reduce(DataFrame.unionByName, scores)

    return kept_scores(spark, sf, "forest-set-scores", make)


def boosted_scores(spark, sf):
    def make():
        train, validation = split(spark, sf)
        model = M.fit_model(train, M.FORECAST, M.boosted(100, 4, 0.1, 0.7, "0.5", 0.001))
        return M.train_validation_scores(model, "boosted trees", train, validation)

    return kept_scores(spark, sf, "boosted-scores", make)


@query("M3_forest")
def random_forest(spark, sf):
    """RMSE and MAE of a forest of 100 trees on both parts; tree libraries differ, so no SQL states them."""
    return rounded_to(forest_scores(spark, sf), 6)


@query("M3_forest_beats_mean", beaten_sql("random forest"))
def forest_beats_mean(spark, sf):
    return beside_baseline(forest_scores(spark, sf), *split(spark, sf))


@query("M3_forest_feature_sets")
def forest_feature_sets(spark, sf):
    """Scores with weather only, all features, and with the hour and a square-root share of columns per node."""
    return rounded_to(feature_set_scores(spark, sf), 6)


@query("M3_feature_sets_beat_mean", beaten_sql(*[f"random forest, {n}" for n, *_ in FEATURE_SETS]))
def feature_sets_beat_mean(spark, sf):
    return beside_baseline(feature_set_scores(spark, sf), *split(spark, sf))


@query("M4_boosted_trees")
def boosted_trees(spark, sf):
    """RMSE and MAE of 100 rounds on both parts."""
    return rounded_to(boosted_scores(spark, sf), 6)


@query("M4_boosted_beats_mean", beaten_sql("boosted trees"))
def boosted_beats_mean(spark, sf):
    return beside_baseline(boosted_scores(spark, sf), *split(spark, sf))


AXES = {"maxDepth": [3, 6], "numTrees": [5, 10], "featureSubsetStrategy": ["all", "sqrt"], "minInstancesPerNode": [1, 4]}


def grid_scores(spark, sf):
    def make():
        found = M.grid_search(prepared(spark, sf), M.FORECAST, AXES, F.col("k"))
        rows = [
            (*[{p.name: v for p, v in point.items()}[name] for name in AXES], float(rmse))
            for point, rmse in zip(found.getEstimatorParamMaps(), found.avgMetrics)
        ]
        return spark.createDataFrame(rows, "max_depth int, trees int, features string, smallest_leaf int, rmse double")

    return kept_scores(spark, sf, "grid-scores", make)


@query("M5_grid_search")
def grid_search(spark, sf):
    """Every setting of four axes with its cross-validated RMSE."""
    return grid_scores(spark, sf).withColumn("rmse", F.round("rmse", 6))


@query(
    "M5_grid_beats_mean",
    """select unnest([3, 6]) as max_depth, trees, features, smallest_leaf, rmse as baseline, true as better
       from (select unnest([5, 10]) as trees, features, smallest_leaf from (select unnest(['all', 'sqrt']) as features, smallest_leaf
       from (select unnest([1, 4]) as smallest_leaf))), (select round(stddev_pop(demand), 6) as rmse from fact)""",
)
def grid_beats_mean(spark, sf):
    """Every setting of four axes beside the error of the mean."""
    baseline = data.fact(spark, sf).agg(F.stddev_pop("demand")).scalar()
    beside = [F.round(baseline, 6).alias("baseline"), (F.col("rmse") < baseline).alias("better")]
    return grid_scores(spark, sf).select("max_depth", "trees", "features", "smallest_leaf", *beside)


#: The settings of the halving search; each comes with every number of trees.
HALVED, TREES = {"maxDepth": [3, 6, 9], "featureSubsetStrategy": ["all", "sqrt"], "minInstancesPerNode": [1, 4]}, [4, 8, 16]


def halved_scores(spark, sf):
    return kept_scores(
        spark, sf, "halved-scores", lambda: M.halving_search(prepared(spark, sf), M.FORECAST, HALVED, TREES, F.col("k"), folds=2)
    )


@query("M5_halving_search")
def halving_search(spark, sf):
    """All 36 points with the rung they reached and their RMSE there; points that differ in trees alone share a fit."""
    return halved_scores(spark, sf).withColumn("rmse", F.round("rmse", 6))


FOLDS = 5


def fold_scores(spark, sf):
    return kept_scores(
        spark, sf, "fold-scores", lambda: M.kfold_scores(prepared(spark, sf), M.FORECAST, F.col("k"), FOLDS, depth=3, rate=0.2)
    )


@query("M6_kfold_scores")
def kfold(spark, sf):
    """Five folds, each stopped by 30 rounds without gain on the rows it holds out: rounds kept and scores."""
    scores = fold_scores(spark, sf)
    return scores.withColumns({c: F.round(c, 6) for c in scores.columns if c[:4] in ("rmse", "mae_")})


@query("M6_kfold_beats_mean", beaten_sql(f"boosted trees, {FOLDS} folds"))
def kfold_beats_mean(spark, sf):
    """The mean of the folds' scores beside the mean of the usual split."""
    scores = M.mean_over_folds(fold_scores(spark, sf), f"boosted trees, {FOLDS} folds")
    return beside_baseline(scores, *split(spark, sf))


PREDICTED = f"(select *, {K} as k, (hour / 8e0) as prediction from fact)"


def simple_prediction(spark, sf):
    """A stand-in prediction that both engines can make."""
    return key_column(data.fact(spark, sf)).withColumn("prediction", F.col("hour") / F.lit(8.0))


@query(
    "M7_metrics",
    f"""select round(sqrt(avg((demand - prediction) * (demand - prediction))), 6) as rmse, round(avg(abs(demand - prediction)), 6) as mae,
        round(sqrt(avg((demand - prediction) * (demand - prediction))) / (max(demand) - min(demand)), 6) as nrmse from {PREDICTED}""",
)
def metrics(spark, sf):
    return rounded(M.metrics(simple_prediction(spark, sf)), "rmse", "mae", "nrmse")


@query("M8_permutation_importance")
def importance(spark, sf):
    f = prepared(spark, sf)
    model = M.fit_model(f, M.ALL, M.forest(100, 10))
    return M.permutation_importance(model, f, M.ALL, [F.col("k")])


REPEATS = 10


@query(
    "M8_shuffled_rows",
    f"""select unnest(range({REPEATS})) as repeat, n, temps, rhums, true as moved from (
       select count(*) as n, round(sum(temp), 3) as temps, cast(sum(rhum) as bigint) as rhums from fact)""",
)
def shuffled_rows(spark, sf):
    """What the rows of each repeat borrow is what all rows have, and most of them borrow from another row."""
    rows = key_column(data.fact(spark, sf)).select("k", "temp", "rhum")
    lent = M.with_donors(rows, ["k", "temp", "rhum"], [F.col("k")], REPEATS)
    return lent.groupBy(F.col("_repeat").cast("long").alias("repeat")).agg(
        F.count("*").alias("n"),
        F.round(F.sum("_other_temp"), 3).alias("temps"),
        F.sum("_other_rhum").cast("long").alias("rhums"),
        ((F.count_if(F.col("_other_k") != F.col("k")) > 0.99 * F.count("*")) & (F.count_distinct("_other_k") == F.count("*"))).alias("moved"),
    )


@query(
    "M8_unused_predictor",
    "select 'wind_bft' as predictor, 0e0 as importance, false as used union all select 'hour', null, true",
)
def unused_predictor(spark, sf):
    """A predictor that the model's preprocessing drops has no importance at all; the hour has."""
    f = prepared(spark, sf)
    model = M.fit_model(f, ["hour", "temp"], M.forest(5, 5))
    found = M.permutation_importance(model, f, ["hour", "temp", "wind_bft"], [F.col("k")], 3).filter("predictor <> 'temp'")
    used = F.col("importance") > 1e-9
    return found.select("predictor", F.when(~used, F.round("importance", 9)).alias("importance"), used.alias("used"))


# -- regressions with robust errors ------------------------------------------------------------------------------------


def saturated(spark, sf, family):
    """With one factor alone the fitted values are the group means, which SQL can check."""
    f = prepared(spark, sf)
    return f, G.fit(f, "demand", factors=["timesofday"], family=family)


GROUP = "(select timesofday, count(*) as n, avg(demand) as mu, var_pop(demand) as v from features group by 1)"


@query("M9_negative_binomial_one_factor", f"select timesofday, n, round(mu, 6) as fitted, round(1e0 / n, 9) as leverage from {GROUP}")
def negative_binomial_one_factor(spark, sf):
    f, fit = saturated(spark, sf, "negative_binomial")
    rows = fit.influence(f).groupBy("timesofday").agg(
        F.count("*").alias("n"), F.round(F.max("fitted"), 6).alias("fitted"), F.round(F.max("leverage"), 9).alias("leverage")
    )
    return rows


WEATHER_AND_HOLIDAY = ["temp_r", "wdsp", "rhum", "rain", "holiday"]


def equations_sql(numbers: list[str], rows: str, factors: tuple | list = ()) -> str:
    """Totals of the design columns; the mean score of each is zero at the fit."""
    parts = ["select 'Intercept' as term, count(*) as total from d"]
    parts += [f"select '{c}', sum(cast({c} as integer) + 0e0) from d" if c != "rain" else "select 'rain', sum(rain) from d" for c in numbers]
    parts += [
        f"select '{c}[' || cast({c} as varchar) || ']', count(*) from d where cast({c} as varchar) > (select min(cast({c} as varchar)) from d) group by {c}"
        for c in factors
    ]
    return f"with d as (select * from {rows}) select term, round(cast(total as double), 3) as total, 0e0 as score from ({' union all '.join(parts)})"


def equations(fit, df):
    """The fit seen from its equations, which SQL can state."""
    return fit.score_equations(df).select("term", F.round("total", 3).alias("total"), F.abs(F.round("score", 6)).alias("score"))


@query("M9_negative_binomial_weather", equations_sql(WEATHER_AND_HOLIDAY, "features"))
def negative_binomial_weather(spark, sf):
    f = prepared(spark, sf).withColumn("holiday", F.col("holiday").cast("int"))
    return equations(G.fit(f, "demand", WEATHER_AND_HOLIDAY), f)


@query("M9_negative_binomial_afternoon", equations_sql(WEATHER_AND_HOLIDAY, "features where timesofday = 'Afternoon'"))
def negative_binomial_afternoon(spark, sf):
    """The model for one period of the day."""
    f = prepared(spark, sf).filter("timesofday = 'Afternoon'").withColumn("holiday", F.col("holiday").cast("int"))
    return equations(G.fit(f, "demand", WEATHER_AND_HOLIDAY), f)


BASE = "Afternoon"


@query(
    "M10_linear_with_factors",
    f"""select case when timesofday = '{BASE}' then 'Intercept' else 'timesofday[' || timesofday || ']' end as term,
        round(mu - case when timesofday = '{BASE}' then 0 else (select mu from {GROUP} where timesofday = '{BASE}') end, 6) as estimate,
        round(sqrt(se + case when timesofday = '{BASE}' then 0 else (select n * v / ((n - 1e0) * (n - 1)) from {GROUP} where timesofday = '{BASE}') end), 6) as robust_error
        from (select *, n * v / ((n - 1e0) * (n - 1)) as se from {GROUP})""",
)
def linear_with_factors(spark, sf):
    """One factor: differences of group means, and HC3 errors from the group variances."""
    _, fit = saturated(spark, sf, "gaussian")
    return rounded(fit.coefficients(spark).drop("z"), "estimate", "robust_error")


FACTORS = ["rainfall_intensity", "temp_bin", "rhum_bin", "wind_speed_group", "timesofday"]


@query("M10_linear_all_factors", equations_sql(["holiday", "working_day", "peak"], "binned", FACTORS))
def linear_all_factors(spark, sf):
    binned = settle(key_column(data.binned_features(spark, sf)), "features")
    binned = binned.withColumns({c: F.col(c).cast("int") for c in ("holiday", "working_day", "peak")})
    return equations(G.fit(binned, "demand", ["holiday", "working_day", "peak"], FACTORS, family="gaussian"), binned)


@query(
    "M11_cooks_distance",
    f"""select {K} as k, round((demand - mu) * (demand - mu) / (mu + mu * mu) / 4e0 / n / ((1 - 1e0 / n) * (1 - 1e0 / n)), 6) as cooks
        from features f join {GROUP} g on f.timesofday = g.timesofday""",
)
def cooks_distance(spark, sf):
    f, fit = saturated(spark, sf, "negative_binomial")
    return rounded(fit.influence(f).select("k", "cooks"), "cooks")


@query(
    "M11_without_influential",
    f"""select count(*) as n, count(*) filter (where d > 4e0 / total) as flagged, cast(sum(demand) filter (where d <= 4e0 / total) as bigint) as kept_demand
        from (select demand, (demand - mu) * (demand - mu) / (mu + mu * mu) / 4e0 / n / ((1 - 1e0 / n) * (1 - 1e0 / n)) as d,
        count(*) over () as total from features f join {GROUP} g on f.timesofday = g.timesofday)""",
)
def without_influential(spark, sf):
    f, fit = saturated(spark, sf, "negative_binomial")
    marked = fit.influence(f)
    kept = G.without_influential(marked, fit.n).agg(F.sum("demand")).scalar()
    return marked.agg(
        F.count("*").alias("n"), F.count_if(F.col("cooks") > F.lit(4 / fit.n)).alias("flagged"), F.max(kept).alias("kept_demand")
    )


DAYS = "(select date, count(*) as n, avg(demand) as mu from fact group by 1)"


@query("M9_many_levels", f"select date, n, round(mu, 6) as fitted from {DAYS} where mu > 0")
def negative_binomial_many_levels(spark, sf):
    """A level for each of more than four hundred days: the fitted values are the means of the days."""
    f = data.fact(spark, sf).select("date", "demand")
    f = settle(f.join(f.filter("demand > 0").select("date").distinct(), "date", "left_semi"), "days")
    rows = W.fit_wide(f, "demand", factors=["date"]).predict(f).groupBy("date")
    return rows.agg(F.count("*").alias("n"), F.round(F.max("fitted"), 6).alias("fitted"))


@query(
    "M10_many_levels",
    """select 'day ' || cast(date as varchar) as level, cast(sum(demand) as bigint) as observed, cast(sum(demand) as double) as fitted from fact group by date
       union all select 'hour ' || cast(hour as varchar), cast(sum(demand) as bigint), cast(sum(demand) as double) from fact group by hour
       union all select 'temp', cast(null as bigint), round(sum(temp * demand), 3) from fact""",
)
def linear_many_levels(spark, sf):
    """Days, hours and temperature together: at the fit every level's fitted values add up to what was observed."""
    f = data.fact(spark, sf).select("date", "hour", "temp", "demand")
    rows = settle(W.fit_wide(f, "demand", ["temp"], ["date", "hour"], family="gaussian").predict(f), "fitted")
    sums = [F.sum("demand").cast("long").alias("observed"), F.round(F.sum("fitted"), 3).alias("fitted")]
    levels = [rows.groupBy(F.concat_ws(" ", F.lit(name), c).alias("level")).agg(*sums) for name, c in (("day", "date"), ("hour", "hour"))]
    temp = rows.agg(F.lit(None).cast("long").alias("observed"), F.round(F.sum(F.col("temp") * F.col("fitted")), 3).alias("fitted"))
    return levels[0].unionByName(levels[1]).unionByName(temp.select(F.lit("temp").alias("level"), "observed", "fitted"))


@query("M11_many_levels", f"select f.date, hour, round(1e0 / n, 9) as leverage from fact f join {DAYS} d on f.date = d.date")
def leverage_many_levels(spark, sf):
    f = data.fact(spark, sf).select("date", "hour", "demand")
    fit = W.fit_wide(f, "demand", factors=["date"], family="gaussian")
    return fit.influence(f).select("date", "hour", F.round("leverage", 9).alias("leverage"))


@query(
    "M15_information",
    f"""select round(ll, 4) as log_likelihood, round(-2 * ll + 8, 4) as aic, round(-2 * ll + 4 * ln(n), 4) as bic, round(dev - (n - 4) * ln(n), 4) as bic_deviance
        from (select sum(demand * ln(mu) - (demand + 1) * ln(1 + mu)) as ll, count(*) as n,
        2 * sum(case when demand > 0 then demand * ln(demand / mu) else 0 end - (demand + 1) * ln((1 + demand) / (1 + mu))) as dev
        from features f join {GROUP} g on f.timesofday = g.timesofday)""",
)
def information(spark, sf):
    f, fit = saturated(spark, sf, "negative_binomial")
    found = fit.information(f)
    return found.select(*[F.round(c, 4).alias(c) for c in found.columns])


@query(
    "M17_residuals",
    f"select {K} as k, demand as observed, round(mu, 6) as fitted, round(demand - mu, 6) as residual from features f join {GROUP} g on f.timesofday = g.timesofday",
)
def residuals(spark, sf):
    f, fit = saturated(spark, sf, "gaussian")
    rows = fit.predict(f).select("k", F.col("demand").alias("observed"), "fitted", "residual")
    return rounded(rows, "fitted", "residual")


@query("M17_residual_mean", "select 0e0 as residual_mean, count(*) as n from fact")
def residual_mean(spark, sf):
    f, fit = saturated(spark, sf, "gaussian")
    return fit.predict(f).agg(F.abs(F.round(F.avg("residual"), 6)).alias("residual_mean"), F.count("*").alias("n"))


# -- scores, forecast, saved models ------------------------------------------------------------------------------------


@query(
    "A30_actual_and_predicted",
    f"""select date, round(avg(demand), 6) as actual_mean, round(avg(prediction), 6) as predicted_mean, cast(sum(demand) as bigint) as actual_sum,
        round(sum(prediction), 6) as predicted_sum from {PREDICTED} where date between '{TEST[0]}' and '{TEST[1]}' group by 1""",
)
def actual_and_predicted(spark, sf):
    days = M.actual_and_predicted(H.sample_dates(simple_prediction(spark, sf), *TEST))
    return rounded(days, "actual_mean", "predicted_mean", "predicted_sum")


@query(
    "P15_report_columns",
    """select date as "Date", hour as "Hour", temp as "Temperature", rhum as "Relative Humidity", wdsp as "Wind Speed",
       rainfall_intensity as "Rainfall Intensity", cast(round(hour / 8e0) as integer) as "Predicted Demand" from features""",
)
def report_columns(spark, sf):
    f = data.features(spark, sf)
    return M.present(f.withColumn("predicted", F.round(F.col("hour") / F.lit(8.0)).cast("int")))


@query(
    "M18_score_table",
    f"""with scored as (select 'hour over eight' as model, part, sqrt(avg((demand - prediction) * (demand - prediction))) as rmse,
        avg(abs(demand - prediction)) as mae from (select *, case when date <= '{TRAIN[1]}' then 'train' else 'validation' end as part from {PREDICTED}) group by 2)
        select 'hour over eight' as model, 'RMSE' as metric, round(max(rmse) filter (where part = 'train'), 6) as train,
        round(max(rmse) filter (where part = 'validation'), 6) as validation from scored""",
)
def score_table(spark, sf):
    part = F.when(F.col("date") <= F.lit(TRAIN[1]).cast("date"), "train").otherwise("validation")
    scored = M.metrics(simple_prediction(spark, sf).withColumn("part", part), ["part"])
    table = M.score_table(scored.withColumn("model", F.lit("hour over eight")))
    return rounded(M.filter_scores(table, "HOUR", "rmse"), "train", "validation")


#: Rounds, depth and rate of the forecast model.
FORECAST_MODEL = (100, 3, 0.1)


def forecast_model(spark, sf):
    """The kept forecast model, trained where none is kept yet."""
    def make(path):
        M.fit_model(prepared(spark, sf), M.FORECAST, M.boosted(*FORECAST_MODEL)).write().save(path)

    return PipelineModel.load(kept(spark, sf, "forecast-model", make))


def forecast_hours(spark, sf):
    """Forecast document and the kept model in, the next fifteen hours of demand out."""
    return data.fact(spark, sf), M.forecast_demand(forecast_model(spark, sf), combine_forecast(forecast_files(spark, sf)))


@query("M16_demand_forecast")
def demand_forecast(spark, sf):
    """The report of the next hours: their weather, the demand foreseen, and whether it is high."""
    return forecast_hours(spark, sf)[1]


@query(
    "M16_forecast_hours",
    """select cast(at_time as date) as "Date", cast(hour(at_time) as integer) as "Hour", temp as "Temperature", true as plausible
       from (select date + to_hours(cast(hour as bigint)) as at_time, temp from weather where hour <> 23 order by 1 limit 15)""",
)
def forecast_is_plausible(spark, sf):
    """The forecast hours, and that their demand is within what was ever observed."""
    f, hours = forecast_hours(spark, sf)
    seen = f.agg(F.struct(F.min("demand").alias("lo"), F.max("demand").alias("hi"))).scalar()
    return hours.select("Date", "Hour", "Temperature", F.col("Predicted Demand").between(seen["lo"], seen["hi"]).alias("plausible"))


@query(
    "O2_next_hours",
    "select date + to_hours(cast(hour as bigint)) as at_time, temp from weather where hour <> 23 order by 1 limit 15",
)
def next_hours(spark, sf):
    return combine_forecast(forecast_files(spark, sf)).orderBy("at_time").limit(15).select("at_time", "temp")


@query("S15_saved_model", "select count(*) as n, cast(0 as bigint) as different from fact")
def saved_model(spark, sf):
    """A model read back predicts what it predicted before it was saved."""
    f = prepared(spark, sf)
    model = M.fit_model(f, M.FORECAST, M.boosted(*FORECAST_MODEL))
    path = scratch(spark, "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    before = model.transform(f).select("k", F.col("prediction").alias("before"))
    after = loaded.transform(f).select("k", F.col("prediction").alias("after"))
    joined = before.join(after, "k")
    return joined.agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("before") - F.col("after")) > 1e-9).alias("different"))
