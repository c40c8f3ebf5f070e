"""Linear and negative-binomial regression with robust errors and influence measures.

Rows that share their predictors shrink to one cell with count, sum and sum of squares of the target. Each
step of the fit is one aggregate over the cells; only matrices of predictors by predictors reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle


@dataclass
class Design:
    """Intercept, dummy columns of factors (first level in alphabetical order dropped) and numbers."""

    numeric: list[str]
    levels: dict[str, list[str]] = field(default_factory=dict)

    @classmethod
    def of(cls, df: DataFrame, numeric: Sequence[str] = (), factors: Sequence[str] = ()) -> Design:
        levels = {}
        if factors:
            row = df.agg(*[F.array_sort(F.collect_set(F.col(f).cast("string"))).alias(f) for f in factors]).first()
            levels = {f: list(row[f]) for f in factors}
        return cls(list(numeric), levels)

    @property
    def inputs(self) -> list[str]:
        return [*self.levels, *self.numeric]

    @property
    def names(self) -> list[str]:
        dummies = [f"{f}[{level}]" for f, levels in self.levels.items() for level in levels[1:]]
        return ["Intercept", *dummies, *self.numeric]

    def columns(self) -> list[Column]:
        """The design of a row; a missing level or number is a null, not the base level."""
        dummies = [
            F.when(F.col(f).isNotNull(), F.when(F.col(f).cast("string") == level, 1.0).otherwise(0.0))
            for f, levels in self.levels.items()
            for level in levels[1:]
        ]
        return [F.lit(1.0), *dummies, *[F.col(c).cast("double") for c in self.numeric]]


def complete(df: DataFrame, target: str, numeric: Sequence[str] = (), factors: Sequence[str] = ()) -> DataFrame:
    """Rows whose target and predictors are all there; a NaN counts as missing."""
    numbers = [F.col(c).cast("double") for c in (target, *numeric)]
    there = [c.isNotNull() & ~F.isnan(c) for c in numbers] + [F.col(f).isNotNull() for f in factors]
    return df.filter(reduce(lambda a, b: a & b, there))


def _dot(xs: Sequence[Column], weights: Sequence[float]) -> Column:
    """The weighted sum as a tree, which stays shallow for wide designs."""
    terms = [x * F.lit(float(b)) for x, b in zip(xs, weights)]
    while len(terms) > 1:
        terms = [reduce(lambda a, b: a + b, terms[i : i + 2]) for i in range(0, len(terms), 2)]
    return terms[0]


Weigh = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _sums(cells: DataFrame, p: int, weigh: Weigh) -> tuple[np.ndarray, np.ndarray]:
    """Sum of w x x' and of v x over all cells, where ``weigh`` gives w and v of a batch.

    Each task adds up its own batches in numpy and hands on one array; Spark adds up the arrays. The
    coefficients travel in the function, so no step compiles a plan of its own.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix, vector = np.zeros((p, p)), np.zeros(p)
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy())
                w, v = weigh(x, batch["n"].to_numpy(float), batch["sy"].to_numpy(), batch["syy"].to_numpy())
                matrix += (x * w[:, None]).T @ x
                vector += v @ x
        yield pd.DataFrame({"part": [np.concatenate([matrix.ravel(), vector])]})

    totals = (
        cells.select("x", "n", "sy", "syy")
        .mapInPandas(partial, "part array<double>")
        .select(F.posexplode("part"))
        .groupBy("pos")
        .agg(F.sum("col").alias("total"))
        .collect()
    )
    flat = np.zeros(p * p + p)
    for row in totals:
        flat[row.pos] = row.total
    return flat[: p * p].reshape(p, p), flat[p * p :]


@dataclass
class Fit:
    design: Design
    target: str
    family: str
    alpha: float
    beta: np.ndarray
    covariance: np.ndarray
    robust: np.ndarray
    n: int
    scale: float
    iterations: int
    #: Rows left out of the fit because the target or a predictor is missing.
    dropped: int = 0

    def _mean(self, xs: Sequence[Column]) -> Column:
        eta = _dot(xs, self.beta)
        return F.exp(eta) if self.family == "negative_binomial" else eta

    def _variance(self, mu: Column) -> Column:
        return mu + F.lit(self.alpha) * mu * mu if self.family == "negative_binomial" else F.lit(1.0)

    def _weight(self, mu: Column) -> Column:
        return mu / (1 + F.lit(self.alpha) * mu) if self.family == "negative_binomial" else F.lit(1.0)

    def coefficients(self, spark) -> DataFrame:
        """Estimate and robust standard error per design column."""
        errors = np.sqrt(np.diag(self.robust))
        rows = [
            (name, float(b), float(s), float(b / s) if s > 0 else None)
            for name, b, s in zip(self.design.names, self.beta, errors)
        ]
        return spark.createDataFrame(rows, "term string, estimate double, robust_error double, z double")

    def predict(self, df: DataFrame) -> DataFrame:
        """Observed, fitted and residual per row."""
        mu = self._mean(self.design.columns())
        return df.withColumn("fitted", mu).withColumn("residual", F.col(self.target) - F.col("fitted"))

    def influence(self, df: DataFrame) -> DataFrame:
        """Leverage, studentised residual and Cook's distance per row; the quadratic form is taken batch by batch."""
        xs, p = self.design.columns(), len(self.beta)
        inverse = self.covariance / self.scale

        @F.pandas_udf("double")
        def form(x: pd.Series) -> pd.Series:
            rows = np.array(x.tolist(), float).reshape(len(x), p)
            return pd.Series(((rows @ inverse) * rows).sum(1))

        mu, h = F.col("fitted"), F.col("leverage")
        leverage = self._weight(mu) * form(F.array(*xs))
        out = self.predict(df).withColumn("leverage", F.when(mu.isNotNull(), leverage))
        pearson = F.col("residual") / F.sqrt(self._variance(mu) * F.lit(self.scale))
        out = out.withColumn("studentized", F.when(h < 1, pearson / F.sqrt(1 - h)))
        return out.withColumn("cooks", F.when(h < 1, F.col("studentized") ** 2 / p * h / (1 - h)))

    def score_equations(self, df: DataFrame) -> DataFrame:
        """Per design column its total and the mean score, which is zero where the likelihood is largest."""
        mu = F.col("fitted")
        share = F.col("residual") / (1 + F.lit(self.alpha) * mu) if self.family == "negative_binomial" else F.col("residual")
        rows = complete(df, self.target, self.design.numeric, list(self.design.levels))
        parts = self.predict(rows).select(F.posexplode(F.array(*self.design.columns())), share.alias("_share"))
        names = F.array(*[F.lit(name) for name in self.design.names])
        return parts.groupBy("pos").agg(F.sum("col").alias("total"), F.avg(F.col("col") * F.col("_share")).alias("score")).select(
            F.get(names, F.col("pos")).alias("term"), "total", "score"
        )

    def information(self, df: DataFrame) -> DataFrame:
        """Log-likelihood, AIC, and BIC in the likelihood and the deviance form."""
        y, mu, a = F.col(self.target).cast("double"), F.col("fitted"), F.lit(self.alpha)
        df = complete(df, self.target, self.design.numeric, list(self.design.levels))
        rows, p = self.predict(df), len(self.beta)
        if self.family == "negative_binomial":
            r = 1 / self.alpha
            # ln of gamma(y + r) / (gamma(r) y!), a product over whole numbers below y
            steps = F.when(y > 0, F.sequence(F.lit(0), (y - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
            ratio = F.aggregate(steps, F.lit(0.0), lambda s, k: s + F.log((k + F.lit(r)) / (k + 1)))
            constant = df.groupBy(self.target).agg(F.count("*").alias("_n")).agg(F.sum(F.col("_n") * ratio)).scalar()
            body = F.sum(y * F.log(a * mu) - (y + r) * F.log(1 + a * mu))
            growth = F.when(y > 0, y * F.log(F.when(y > 0, y).otherwise(1.0) / mu)).otherwise(0.0)
            deviance = F.sum(2 * (growth - (y + r) * F.log((1 + a * y) / (1 + a * mu))))
            found = rows.agg(body.alias("_b"), deviance.alias("deviance"), F.count("*").alias("n")).withColumn(
                "log_likelihood", F.col("_b") + constant
            )
        else:
            found = rows.agg(F.sum(F.col("residual") ** 2).alias("deviance"), F.count("*").alias("n")).withColumn(
                "log_likelihood",
                -F.col("n") / 2 * (F.log(F.lit(2 * math.pi) * F.col("deviance") / F.col("n")) + 1),
            )
        return found.select(
            "log_likelihood",
            (-2 * F.col("log_likelihood") + 2 * p).alias("aic"),
            (-2 * F.col("log_likelihood") + p * F.log("n")).alias("bic"),
            (F.col("deviance") - (F.col("n") - p) * F.log("n")).alias("bic_deviance"),
        )


def fit(
    df: DataFrame,
    target: str,
    numeric: Sequence[str] = (),
    factors: Sequence[str] = (),
    family: str = "negative_binomial",
    alpha: float = 1.0,
    tolerance: float = 1e-10,
    max_steps: int = 50,
) -> Fit:
    """Fit by iterated weighted least squares; the Gaussian family takes a single step.

    Rows with a missing target or predictor are left out and counted in ``dropped``. Raises where the fit does not
    settle, and where no row is complete.
    """
    kept = complete(df, target, numeric, factors)
    design = Design.of(kept, numeric, factors)
    p = len(design.names)
    y = F.col(target).cast("double")
    found = kept.groupBy(*design.inputs).agg(F.count("*").alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy"))
    cells = settle(found.select("n", "sy", "syy", F.array(*design.columns()).alias("x")), "cells")
    n, total = cells.agg(F.sum("n"), F.sum("sy")).first()
    if not n:
        raise ValueError("no complete rows to fit")
    if family == "gaussian":
        matrix, right = _sums(cells, p, lambda x, n, sy, syy: (n, sy))
        beta, steps = np.linalg.solve(matrix, right), 1
    else:
        beta, steps, moved = np.zeros(p), 0, math.inf
        beta[0] = math.log(total / n)
        while not moved <= tolerance and steps < max_steps:
            matrix, right = _sums(cells, p, _log_link_step(beta, alpha))
            new = np.linalg.solve(matrix, right)
            moved, beta, steps = float(np.max(np.abs(new - beta))), new, steps + 1
        if not moved <= tolerance:
            raise RuntimeError(f"the fit still moves by {moved} after {max_steps} steps")
    inverse = np.linalg.inv(matrix)
    spread, score = _sums(cells, p, _squared_scores(beta, inverse, family, alpha))
    scale = score[0] / (n - p) if family == "gaussian" else 1.0
    dropped = df.count() - n
    return Fit(design, target, family, alpha, beta, inverse * scale, inverse @ spread @ inverse, n, scale, steps, dropped)


def _log_link_step(beta: np.ndarray, alpha: float) -> Weigh:
    def weigh(x, n, sy, syy):
        eta = x @ beta
        mu = np.exp(eta)
        w = mu / (1 + alpha * mu)
        return n * w, w * (n * eta + (sy - n * mu) / mu)

    return weigh


def _squared_scores(beta: np.ndarray, inverse: np.ndarray, family: str, alpha: float) -> Weigh:
    """Squared scores over squared room left by the leverage, and plain squared residuals (on the intercept)."""

    def weigh(x, n, sy, syy):
        eta = x @ beta
        mu = eta if family == "gaussian" else np.exp(eta)
        w = np.ones_like(mu) if family == "gaussian" else mu / (1 + alpha * mu)
        slope = np.ones_like(mu) if family == "gaussian" else 1 / (1 + alpha * mu)
        squared = syy - 2 * mu * sy + n * mu * mu
        room = 1 - w * np.einsum("ij,jk,ik->i", x, inverse, x)
        # a cell that determines its own fit has no residual to weigh
        safe = np.where(room > 1e-12, room, np.inf)
        return squared * (slope / safe) ** 2, squared

    return weigh


def without_influential(rows: DataFrame, n: int) -> DataFrame:
    """Rows whose Cook's distance does not exceed 4/n, or that have none: those alone in their level."""
    return rows.filter(F.coalesce(F.col("cooks") <= F.lit(4 / n), F.lit(True)))
