"""Fitted column transformations. What a fit learns is a few numbers; applying it is an expression."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import Bucketizer, OneHotEncoder, PolynomialExpansion, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import DOMAIN_ORDER
from ..session import settle
from .ranking import cut_points

# How each predictor enters a model.
CATEGORICAL = ["timesofday", "dayofweek", "holiday", "peak", "hour", "working_day", "season", "month"]
NUMERIC = ["rain", "temp", "rhum", "wdsp", "temp_r"]
ORDINAL = ["wind_speed_group", "rainfall_intensity"]


#: Ranges of values whose sums are kept at hand while bins are sought.
RANGES = 2048


def kmeans_edges(df: DataFrame, value: str, bins: int, max_steps: int = 300) -> list[float]:
    """Inner bin edges from one-dimensional k-means that starts at the centres of equal-width bins.

    Values are cut into ranges whose counts and sums are fetched once; a step adds them up. Only where an edge falls
    between two values of one range does a step ask Spark for the sums on both sides. Missing values are left out, and
    NaN counts as missing; without values, or with equal values alone, all edges are that value.
    """
    given = F.col(value).cast("double")
    found = df.filter(given.isNotNull() & ~F.isnan(given)).groupBy(given.alias("_v")).agg(F.count("*").alias("n"))
    counts = settle(found, "value-counts")
    cuts = counts.agg(cut_points(F.col("_v"), RANGES)).first()[0] or []
    sums = [F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.sum("n").alias("n"), F.sum(F.col("_v") * F.col("n")).alias("s")]

    def by_bin(edges: Sequence[float]) -> list:
        cut = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol="_v", outputCol="bin").transform(counts)
        return cut.groupBy("bin").agg(*sums).orderBy("bin").collect()

    ranges = by_bin(cuts) if cuts else []
    if not ranges:
        return []
    low, high = ranges[0].lo, ranges[-1].hi
    if low == high:
        return [low] * (bins - 1)
    width = (high - low) / bins
    centres = [low + width * (i + 0.5) for i in range(bins)]
    for _ in range(max_steps):
        edges = [(a + b) / 2 for a, b in zip(centres, centres[1:])]
        parts = ranges
        if any(r.lo < e <= r.hi for r in ranges for e in edges):
            parts = by_bin(edges)
        n, s = [0] * bins, [0.0] * bins
        for part in parts:
            at = bisect_right(edges, part.lo)
            n[at], s[at] = n[at] + part.n, s[at] + part.s
        moved = [s[i] / n[i] if n[i] else centres[i] for i in range(bins)]
        if max(abs(a - b) for a, b in zip(moved, centres)) < 1e-9:
            break
        centres = sorted(moved)
    else:
        raise RuntimeError(f"k-means still moves after {max_steps} steps")
    return [(a + b) / 2 for a, b in zip(centres, centres[1:])]


def bin_of(value: Column, edges: Sequence[float]) -> Column:
    """Number of inner edges at or below the value."""
    found = F.lit(0)
    for edge in edges:
        found = found + F.when(value >= F.lit(float(edge)), 1).otherwise(0)
    return F.when(value.isNotNull(), found)


def standardized(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Columns minus mean over population deviation, both taken from ``fit_on``."""
    source = df if fit_on is None else fit_on
    stats = source.agg(
        F.struct(*[s for c in columns for s in (F.avg(c).alias(f"{c}_m"), F.stddev_pop(c).alias(f"{c}_s"))])
    ).scalar()
    scaled = {f"{c}_std": F.try_divide(F.col(c) - stats[f"{c}_m"], stats[f"{c}_s"]) for c in columns}
    return df.withColumns(scaled)


def ordinal_sql(column: str) -> str:
    cases = " ".join(f"WHEN '{level}' THEN {i}" for i, level in enumerate(DOMAIN_ORDER[column]))
    return f"CASE {column} {cases} ELSE -1 END"


def preprocessor(df: DataFrame, predictors: Sequence[str], output: str = "features") -> Pipeline:
    """Stages for the listed predictors: one-hot categories, ordinals, standardised numbers.

    Predictors on none of the lists are dropped. An unseen category becomes all zeros. Mean and population
    deviation are measured here in one aggregate and written into the stage, so a saved pipeline carries them.
    """
    categorical = [c for c in CATEGORICAL if c in predictors]
    ordinal = [c for c in ORDINAL if c in predictors]
    numeric = [c for c in NUMERIC if c in predictors]
    parts = [f"CAST({c} AS STRING) AS {c}_cat" for c in categorical]
    parts += [f"CAST({ordinal_sql(c)} AS DOUBLE) AS {c}_ord" for c in ordinal]
    if numeric:
        stats = df.agg(*[s for c in numeric for s in (F.avg(c).alias(f"{c}_m"), F.stddev_pop(c).alias(f"{c}_s"))]).first()
        for c in numeric:
            deviation = stats[f"{c}_s"] or 1.0
            parts.append(f"(CAST({c} AS DOUBLE) - {stats[f'{c}_m']!r}D) / {deviation!r}D AS {c}_num")
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")]
    if categorical:
        indexed, encoded = [f"{c}_idx" for c in categorical], [f"{c}_hot" for c in categorical]
        stages.append(
            StringIndexer(
                inputCols=[f"{c}_cat" for c in categorical],
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            )
        )
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True, handleInvalid="error"))
    inputs = [f"{c}_hot" for c in categorical] + [f"{c}_ord" for c in ordinal] + [f"{c}_num" for c in numeric]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output))
    return Pipeline(stages=stages)


def polynomial(df: DataFrame, columns: Sequence[str], degree: int = 3, output: str = "poly") -> DataFrame:
    """All products of the columns up to the degree, without the constant."""
    assembled = VectorAssembler(inputCols=list(columns), outputCol="_v").transform(df)
    return PolynomialExpansion(degree=degree, inputCol="_v", outputCol=output).transform(assembled).drop("_v")


def yeo_johnson(value: Column, power: Column | float) -> Column:
    """The Yeo-Johnson transform; the power may differ from row to row."""
    power = power if isinstance(power, Column) else F.lit(float(power))
    up, down, other = F.log1p(F.greatest(value, F.lit(0.0))), F.log1p(F.greatest(-value, F.lit(0.0))), 2 - power
    positive = F.when(F.abs(power) < 1e-12, up).otherwise(F.try_divide(F.exp(power * up) - 1, power))
    negative = F.when(F.abs(other) < 1e-12, -down).otherwise(-F.try_divide(F.exp(other * down) - 1, other))
    return F.when(value >= 0, positive).otherwise(negative)


#: Points of the power that one aggregate tries.
PROBES = 21


def yeo_johnson_likelihood(counts: DataFrame, powers: Column) -> DataFrame:
    """Log-likelihood per power, over counts ``n`` of values ``v``; minus infinity where the transform overflows.

    Squares are taken around the transform of the mean value, so that a narrow spread far from zero keeps its digits.
    """
    v, n, power = F.col("v"), F.col("n"), F.col("power")
    middle = counts.agg(F.sum(v * n) / F.sum(n)).scalar()
    tried = counts.withColumn("_middle", middle).withColumn("power", F.explode(powers))
    tried = tried.withColumn("t", yeo_johnson(v, power) - yeo_johnson(F.col("_middle"), power))
    sums = tried.groupBy("power").agg(
        F.sum(n).alias("n"),
        F.sum(n * F.signum(v) * F.log1p(F.abs(v))).alias("jacobian"),
        (F.sum(n * F.col("t")) / F.sum(n)).alias("mean"),
        (F.sum(n * F.col("t") * F.col("t")) / F.sum(n)).alias("square"),
    )
    variance = F.col("square") - F.col("mean") ** 2
    score = -F.col("n") / 2 * F.log(variance) + (power - 1) * F.col("jacobian")
    finite = (variance > 0) & (variance < F.lit(math.inf))
    return sums.select("power", F.when(finite, score).otherwise(F.lit(-math.inf)).alias("score"))


def yeo_johnson_power(df: DataFrame, value: str, low: float = -2.0, high: float = 2.0, tolerance: float = 5e-6) -> float:
    """Power of the largest likelihood: the bracket grows until its best point is inside, and then narrows around it.

    A round is one aggregate over the counts of distinct values, for all points it tries. Missing values are left out;
    values that are all equal, or none, keep the power 1. Raises where the likelihood still rises at a power of a million.
    """
    given = F.col(value).cast("double")
    found = df.filter(given.isNotNull() & ~F.isnan(given)).groupBy(given.alias("v")).agg(F.count("*").alias("n"))
    counts = settle(found, "value-counts")
    if len(counts.limit(2).collect()) < 2:
        return 1.0
    bracketed = False
    while not bracketed or high - low > tolerance:
        width = high - low
        grid = [low + width / (PROBES - 1) * i for i in range(PROBES)]
        scores = {r.power: r.score for r in yeo_johnson_likelihood(counts, F.array(*map(F.lit, grid))).collect()}
        at = max(range(PROBES), key=lambda i: (scores[grid[i]], -i))
        if at in (0, PROBES - 1) and not bracketed:
            if width > 1e6:
                raise ArithmeticError(f"the likelihood still rises at a power of {grid[at]}")
            low, high = (low - 2 * width, low + width) if at == 0 else (high - width, high + 2 * width)
            continue
        bracketed = True
        best, step = grid[at], width / (PROBES - 1)
        low, high = best - step, best + step
    return best


def hash_draw(key: Column, seed: int, size: int) -> Column:
    """Whole number below ``size`` that depends only on the key and the seed."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(size)).cast("int")


def split(df: DataFrame, draw: Column, train_percent: int = 70) -> tuple[DataFrame, DataFrame]:
    """Train and validation rows by a draw of 0 to 99 per row, so reruns agree on every cluster."""
    return df.filter(draw < train_percent), df.filter(draw >= train_percent)


def with_fold(df: DataFrame, draw: Column, folds: int, name: str = "fold") -> DataFrame:
    """Fold number from a draw of any whole number per row, such as ``hash_draw`` gives."""
    return df.withColumn(name, F.pmod(draw, F.lit(folds)).cast("int"))
