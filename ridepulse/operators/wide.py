"""Regressions on factors with many levels, without sums of predictors by predictors.

A row of the design has one 1 per factor, so it travels as level numbers and the numeric predictors. A Newton step is
solved by conjugate gradients: each product of the information matrix with a vector is one pass over the cells, summed in
tasks, and only vectors as long as the coefficients reach the driver. Leverage comes from a tall-skinny QR: every task
reduces its weighted rows to a triangle, triangles are stacked and reduced in a tree, and the leverage of a row is its
squared norm after a triangular solve.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .glm import Design, complete

#: Rows that a task turns into a dense block at once, and triangles that are stacked at once.
BLOCK, FAN = 2048, 8


@dataclass(frozen=True)
class Columns:
    """Where the levels of each factor and the numeric predictors stand among the coefficients."""

    factors: list[str]
    places: list[dict[str, int]]
    numeric: list[str]
    size: int

    @classmethod
    def of(cls, design: Design) -> Columns:
        places, at = [], 1
        for levels in design.levels.values():
            # the first level is in the intercept
            places.append({level: at + i - 1 if i else -1 for i, level in enumerate(levels)})
            at += len(levels) - 1
        return cls(list(design.levels), places, design.numeric, at + len(design.numeric))

    def codes(self, batch: pd.DataFrame) -> np.ndarray:
        """Per row and factor the place of its coefficient, -1 for the base level, -2 for null and unknown levels."""
        found = [batch[f].map(place).fillna(-2).to_numpy(np.int64) for f, place in zip(self.factors, self.places)]
        return np.column_stack(found) if found else np.zeros((len(batch), 0), np.int64)

    def eta(self, codes: np.ndarray, numbers: np.ndarray, beta: np.ndarray) -> np.ndarray:
        """The linear predictor; NaN where a level is unknown or a number is missing."""
        known = np.where(codes >= 0, beta[np.maximum(codes, 0)], 0.0).sum(1)
        out = beta[0] + known + numbers @ beta[self.size - len(self.numeric) :]
        return np.where((codes == -2).any(1), np.nan, out)

    def scatter(self, codes: np.ndarray, numbers: np.ndarray, v: np.ndarray, squared: bool = False) -> np.ndarray:
        """The sum of v times the design rows (or their squares)."""
        out = np.zeros(self.size)
        out[0] = v.sum()
        for column in codes.T:
            used = column >= 0
            out += np.bincount(column[used], weights=v[used], minlength=self.size)
        if self.numeric:
            out[self.size - len(self.numeric) :] = v @ (numbers**2 if squared else numbers)
        return out

    def dense(self, codes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), self.size))
        out[:, 0] = 1
        for column in codes.T:
            used = column >= 0
            out[np.flatnonzero(used), column[used]] = 1
        out[:, self.size - len(self.numeric) :] = numbers
        return out


def _numbers(batch: pd.DataFrame, columns: Columns) -> np.ndarray:
    return batch[columns.numeric].to_numpy(float) if columns.numeric else np.zeros((len(batch), 0))


def _vectors(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = len(batch)
    return (np.array(batch[c].tolist(), kind).reshape(rows, -1) for c, kind in (("codes", np.int64), ("numbers", float)))


def _summed(cells: DataFrame, size: int, part) -> np.ndarray:
    """The sum over all cells of a vector that ``part`` makes of codes, numbers, n, sum and sum of squares."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                codes, numbers = _vectors(batch)
                total += part(codes, numbers, batch["n"].to_numpy(float), batch["sy"].to_numpy(), batch["syy"].to_numpy())
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at.astype(np.int32), "v": total[at]})

    out = np.zeros(size)
    for row in cells.mapInPandas(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[row.at] = row.v
    return out


def _mean_of(family: str, eta: np.ndarray) -> np.ndarray:
    return eta if family == "gaussian" else np.exp(eta)


def _weight_of(family: str, alpha: float, mu: np.ndarray) -> np.ndarray:
    return np.ones_like(mu) if family == "gaussian" else mu / (1 + alpha * mu)


@dataclass
class WideFit:
    design: Design
    columns: Columns
    target: str
    family: str
    alpha: float
    beta: np.ndarray
    cells: DataFrame
    n: int
    dropped: int
    steps: int
    products: int
    scale: float
    triangle: np.ndarray | None = None

    @property
    def _mean(self) -> Callable:
        return partial(_mean_of, self.family)

    @property
    def _weight(self) -> Callable:
        return partial(_weight_of, self.family, self.alpha)

    def _mapped(self, df: DataFrame, names: Sequence[str], make) -> DataFrame:
        """The rows with columns that ``make`` gives of codes, numbers and the target."""
        columns, target = self.columns, self.target
        inputs = [F.col(f).cast("string").alias(f) for f in columns.factors]
        inputs += [F.col(c).cast("double").alias(c) for c in columns.numeric]
        out = ", ".join(f"{name} double" for name in names)

        @F.pandas_udf(f"struct<{out.replace(' double', ': double')}>")
        def run(batch: pd.DataFrame) -> pd.DataFrame:
            codes, numbers = columns.codes(batch), _numbers(batch, columns)
            return pd.DataFrame(dict(zip(names, make(codes, numbers, batch["_y"].to_numpy(float)))))

        rows = df.withColumn("_found", run(F.struct(*inputs, F.col(target).cast("double").alias("_y"))))
        # a missing number is null again outside numpy
        kept = {name: F.when(~F.isnan(F.col("_found")[name]), F.col("_found")[name]) for name in names}
        return rows.withColumns(kept).drop("_found")

    def predict(self, df: DataFrame) -> DataFrame:
        """Fitted value and residual per row; null where a predictor is missing or a level was not in the fit."""
        columns, beta, mean = self.columns, self.beta, self._mean

        def make(codes, numbers, y):
            mu = mean(columns.eta(codes, numbers, beta))
            return mu, y - mu

        return self._mapped(df, ["fitted", "residual"], make)

    def factor(self) -> np.ndarray:
        """The triangle R of the weighted design, R'R = X'WX, by QR in a tree; the triangle alone reaches the driver."""
        if self.triangle is None:
            self.triangle = _triangle(self.cells, self.columns, self.beta, self._mean, self._weight)
        return self.triangle

    def influence(self, df: DataFrame) -> DataFrame:
        """Fitted value, residual, leverage, studentised residual and Cook's distance per row."""
        columns, beta, triangle, alpha = self.columns, self.beta, self.factor(), self.alpha
        mean, weight, scale, family = self._mean, self._weight, self.scale, self.family

        def make(codes, numbers, y):
            mu = mean(columns.eta(codes, numbers, beta))
            h = np.full(len(mu), np.nan)
            for at in range(0, len(mu), BLOCK):
                part = slice(at, at + BLOCK)
                solved = _solve_lower(triangle, columns.dense(codes[part], numbers[part]))
                h[part] = weight(mu[part]) * (solved**2).sum(1)
            h[np.isnan(mu)] = np.nan
            variance = np.ones_like(mu) if family == "gaussian" else mu + alpha * mu * mu
            room = np.where(h < 1 - 1e-12, 1 - h, np.nan)
            studentized = (y - mu) / np.sqrt(variance * scale) / np.sqrt(room)
            return mu, y - mu, h, studentized, studentized**2 / columns.size * h / room

        return self._mapped(df, ["fitted", "residual", "leverage", "studentized", "cooks"], make)

    def coefficients(self, spark, errors: bool = False) -> DataFrame:
        """Estimate per design column, with its robust (HC3) error where asked for: that needs the triangle."""
        found = self.robust_errors() if errors else [None] * self.columns.size
        rows = [(name, float(b), None if e is None else float(e)) for name, b, e in zip(self.design.names, self.beta, found)]
        return spark.createDataFrame(rows, "term string, estimate double, robust_error double")

    def robust_errors(self) -> np.ndarray:
        """Root of the diagonal of the sandwich, summed as squares of solved rows."""
        columns, beta, triangle, alpha = self.columns, self.beta, self.factor(), self.alpha
        mean, weight, family = self._mean, self._weight, self.family

        def part(codes, numbers, n, sy, syy):
            mu, out = mean(columns.eta(codes, numbers, beta)), np.zeros(columns.size)
            squared = syy - 2 * mu * sy + n * mu * mu
            slope = np.ones_like(mu) if family == "gaussian" else 1 / (1 + alpha * mu)
            for at in range(0, len(mu), BLOCK):
                s = slice(at, at + BLOCK)
                half = _solve_lower(triangle, columns.dense(codes[s], numbers[s]))
                room = 1 - weight(mu[s]) * (half**2).sum(1)
                share = squared[s] * (slope[s] / np.where(room > 1e-12, room, np.inf)) ** 2
                out += share @ np.linalg.solve(triangle, half.T).T ** 2
            return out

        return np.sqrt(_summed(self.cells, columns.size, part))


def _solve_lower(triangle: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows times the inverse of an upper triangle: the forward solve R'z = x for each row."""
    return np.linalg.solve(triangle.T, rows.T).T


def _triangle(cells: DataFrame, columns: Columns, beta: np.ndarray, mean, weight) -> np.ndarray:
    size = columns.size

    def reduced(blocks: Iterator[np.ndarray]) -> np.ndarray:
        r = np.zeros((0, size))
        for block in blocks:
            r = np.linalg.qr(np.vstack([r, block]), mode="r")
        return r

    def row(r: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"r": [r.astype("<f8").tobytes()]})

    def triangle_of(raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, "<f8").reshape(-1, size)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def blocks() -> Iterator[np.ndarray]:
            for batch in batches:
                for at in range(0, len(batch), BLOCK):
                    part = batch.iloc[at : at + BLOCK]
                    codes, numbers = _vectors(part)
                    w = part["n"].to_numpy(float) * weight(mean(columns.eta(codes, numbers, beta)))
                    yield columns.dense(codes, numbers) * np.sqrt(w)[:, None]

        found = reduced(blocks())
        if len(found):
            yield row(found)

    def further(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = reduced(triangle_of(raw) for batch in batches for raw in batch["r"])
        if len(found):
            yield row(found)

    now = settle(cells.mapInPandas(first, "r binary"), "triangles")
    while (count := now.count()) > 1:
        now = settle(now.repartition(-(-count // FAN)).mapInPandas(further, "r binary"), "triangles")
    return np.linalg.qr(triangle_of(now.first()["r"]), mode="r")


def fit_wide(
    df: DataFrame,
    target: str,
    numeric: Sequence[str] = (),
    factors: Sequence[str] = (),
    family: str = "negative_binomial",
    alpha: float = 1.0,
    tolerance: float = 1e-9,
    max_steps: int = 50,
) -> WideFit:
    """The fit of ``glm.fit`` by Newton steps and conjugate gradients, for factors with thousands of levels.

    Rows with a missing target or predictor are left out and counted in ``dropped``. Level names and vectors as long as
    the coefficients reach the driver, nothing that grows with their square. Raises where a fit does not settle.
    """
    kept = complete(df, target, numeric, factors)
    design = Design.of(kept, numeric, factors)
    columns, y = Columns.of(design), F.col(target).cast("double")
    inputs = [F.col(f).cast("string").alias(f) for f in columns.factors]
    inputs += [F.col(c).cast("double").alias(c) for c in columns.numeric]
    grouped = kept.select(*inputs, y.alias("_y")).groupBy(*columns.factors, *columns.numeric)
    sums = grouped.agg(F.count("*").alias("n"), F.sum("_y").alias("sy"), F.sum(F.col("_y") * F.col("_y")).alias("syy"))

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["n", "sy", "syy"]].copy()
            out["codes"], out["numbers"] = list(columns.codes(batch)), list(_numbers(batch, columns))
            yield out

    cells = settle(sums.mapInPandas(coded, "n long, sy double, syy double, codes array<long>, numbers array<double>"), "cells")
    n, total = cells.agg(F.sum("n"), F.sum("sy")).first()
    if not n:
        raise ValueError("no complete rows to fit")
    size, beta, gaussian = columns.size, np.zeros(columns.size), family == "gaussian"
    beta[0] = total / n if gaussian else math.log(total / n)
    products, moved, steps = 0, math.inf, 0
    while not moved <= tolerance and steps < max_steps:
        now = beta

        def gradient(codes, numbers, n, sy, syy):
            eta = columns.eta(codes, numbers, now)  # noqa: B023 - used before the next step
            mu = eta if gaussian else np.exp(eta)
            slope = 1.0 if gaussian else 1 / (1 + alpha * mu)
            w = n if gaussian else n * mu / (1 + alpha * mu)
            return np.concatenate([columns.scatter(codes, numbers, (sy - n * mu) * slope), columns.scatter(codes, numbers, w, True)])

        def product(direction: np.ndarray) -> np.ndarray:
            def part(codes, numbers, n, sy, syy):
                w = n if gaussian else n * (mu := np.exp(columns.eta(codes, numbers, now))) / (1 + alpha * mu)  # noqa: B023
                return columns.scatter(codes, numbers, w * columns.eta(codes, numbers, direction))

            return _summed(cells, size, part)

        found = _summed(cells, 2 * size, gradient)
        g, diagonal = found[:size], np.maximum(found[size:], np.finfo(float).tiny)
        # far from the end a rough step is enough
        rough = 1e-13 if gaussian else min(0.01, moved if steps > 1 else 0.01) ** 2
        step, used = _conjugate(product, g, diagonal, max(rough, 1e-13))
        products += used
        beta, moved, steps = beta + step, float(np.max(np.abs(step))), steps + 1
    if not moved <= tolerance:
        raise RuntimeError(f"the fit still moves by {moved} after {max_steps} steps")
    scale = 1.0
    if gaussian:
        def errors(codes, numbers, n, sy, syy):
            mu = columns.eta(codes, numbers, beta)
            return np.array([(syy - 2 * mu * sy + n * mu * mu).sum()])

        scale = float(_summed(cells, 1, errors)[0]) / max(n - size, 1)
    dropped = df.count() - n
    return WideFit(design, columns, target, family, alpha, beta, cells, n, dropped, steps, products, scale)


def _conjugate(product, right: np.ndarray, diagonal: np.ndarray, tolerance: float, most: int = 1000) -> tuple[np.ndarray, int]:
    """Solve by conjugate gradients, preconditioned by the diagonal; how many products it took."""
    x, r = np.zeros_like(right), right.copy()
    z = r / diagonal
    d, size = z.copy(), float(r @ z)
    goal, used = tolerance * size, 0
    while size > goal and size > 0 and used < most:
        q = product(d)
        used += 1
        length = size / float(d @ q)
        x, r = x + length * d, r - length * q
        z = r / diagonal
        size, before = float(r @ z), size
        d = z + size / before * d
    return x, used
