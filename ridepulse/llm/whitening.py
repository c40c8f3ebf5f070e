"""Whitening of embeddings by spectrum slicing.

The covariance comes from exact whole-number sums, so it does not depend on how the rows are spread. Its leading
eigenvalues are isolated one by one: the signs in an LDL' factorisation of the shifted covariance count the eigenvalues
above the shift, and halving intervals by that count leaves one eigenvalue in each. Rayleigh quotient iteration then
converges on its vector, and counts just above and below the value certify its number. Only numbers bounded by the
dimension (sums, covariance, vectors) reach the driver; rows stay in Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
#: Entries become floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Eigenvalues below this share of the largest are rounding noise and have no component.
NOISE = 1e-10
#: Rows multiplied at once.
ROWS = 4096
SAFE = 1 << 53
EPS = float(np.finfo(float).eps)


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed the shift: positive pivots of LDL' with symmetric pivoting.

    Pivots are single entries or, where the diagonal is too small against its column, 2 x 2 blocks, which have one
    eigenvalue of either sign. A pivot of exactly zero counts as not above the shift.
    """
    a = matrix - shift * np.eye(len(matrix))
    bound, above = (1 + 17**0.5) / 8, 0
    while len(a):
        below = np.abs(a[1:, 0])
        if not len(below) or not below.max(initial=0.0):
            above += bool(a[0, 0] > 0)
            a = a[1:, 1:]
            continue
        r = 1 + int(below.argmax())
        largest = below[r - 1]
        if abs(a[0, 0]) < bound * largest:
            others = np.abs(a[r])
            others[r] = 0
            if abs(a[0, 0]) * others.max() >= bound * largest**2:
                pass
            elif abs(a[r, r]) >= bound * others.max():
                order = [r, *(i for i in range(len(a)) if i != r)]
                a = a[np.ix_(order, order)]
            else:
                order = [0, r, *(i for i in range(1, len(a)) if i != r)]
                a = a[np.ix_(order, order)]
                block, side = a[:2, :2], a[2:, :2]
                above += 1
                a = a[2:, 2:] - side @ np.linalg.solve(block, side.T)
                continue
        above += bool(a[0, 0] > 0)
        a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0] / a[0, 0])
    return above


def slices(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int, int]]:
    """Intervals (low, high, first, last) that hold the eigenvalues numbered first to last, from the largest down.

    Halving goes on until an interval holds one eigenvalue, or is so narrow that those in it are equal to rounding.
    """
    radius = float(np.abs(matrix).sum(1).max(initial=0.0))
    low, high = -radius - EPS, radius * (1 + 4 * EPS) + EPS
    narrow = 16 * EPS * len(matrix) * max(radius, np.finfo(float).tiny)
    open_, found = [(low, high, len(matrix), 0)], []
    while open_:
        low, high, at_low, at_high = open_.pop()
        # at_low and at_high: how many eigenvalues exceed the ends
        if at_low == at_high or at_high >= wanted:
            continue
        if at_low - at_high == 1 or high - low <= narrow:
            found.append((low, high, at_high + 1, at_low))
            continue
        middle = (low + high) / 2
        count = inertia(matrix, middle)
        open_ += [(low, middle, at_low, count), (middle, high, count, at_high)]
    return sorted(found, key=lambda s: s[2])


def _solve(matrix: np.ndarray, shift: float, vector: np.ndarray) -> np.ndarray:
    shifted = matrix - shift * np.eye(len(matrix))
    try:
        out = np.linalg.solve(shifted, vector)
    except np.linalg.LinAlgError:
        # the shift is an eigenvalue to the last bit
        out = np.linalg.solve(shifted + EPS * np.abs(matrix).max() * np.eye(len(matrix)), vector)
    return out / np.linalg.norm(out)


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns; as many as exceed the noise, ``wanted`` at most."""
    size, values, vectors = len(matrix), [], np.zeros((len(matrix), 0))
    scale = float(np.abs(matrix).sum(1).max(initial=0.0))
    if not scale:
        return np.zeros(0), vectors
    draw = np.random.default_rng(0)
    for low, high, first, last in slices(matrix, min(wanted, size)):
        group = []
        for _ in range(first, last + 1):
            vector = draw.standard_normal(size)

            def apart(v: np.ndarray) -> np.ndarray:
                for _ in range(2):
                    v = v - vectors @ (vectors.T @ v)
                return v / np.linalg.norm(v)

            vector, value = apart(vector), (low + high) / 2
            if last == first:
                # more halving, until iteration at the middle is sure to find this value and no neighbour
                for _ in range(6):
                    middle = (low + high) / 2
                    low, high = (middle, high) if inertia(matrix, middle) >= first else (low, middle)
                value = (low + high) / 2
            vector = apart(_solve(matrix, value, vector))
            best = np.inf
            for _ in range(40):
                quotient = float(vector @ matrix @ vector)
                value = min(max(quotient, low), high)
                left = float(np.linalg.norm(matrix @ vector - quotient * vector))
                if left <= 4 * EPS * scale or left >= best and best <= 64 * EPS * size * scale:
                    break
                best = min(best, left)
                vector = apart(_solve(matrix, value, vector))
            value = float(vector @ matrix @ vector)
            group.append(value)
            vectors = np.column_stack([vectors, vector])
        slack = 64 * EPS * size * scale
        if inertia(matrix, max(group) + slack) > first - 1 or inertia(matrix, min(group) - slack) < last:
            raise ArithmeticError(f"eigenvalues {first} to {last} are not where they were isolated")
        values += group
    order = sorted(range(len(values)), key=lambda i: -values[i])[:wanted]
    order = [i for i in order if values[i] > NOISE * max(values)]
    return np.array([values[i] for i in order]), vectors[:, order]


def whole(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The positions of the vectors that count, and their entries as whole numbers."""
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    lengths = np.where(np.asarray(column.is_valid()), lengths, 0)
    filled = np.flatnonzero(lengths)
    if not len(filled):
        return filled, np.zeros((0, 0), np.int64)
    width = int(lengths[filled[0]])
    if (lengths[filled] != width).any():
        raise ValueError("vectors of different lengths")
    flat = column.take(pa.array(filled)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)
    finite = np.isfinite(flat).all(1)
    scaled = np.floor(SCALE * flat[finite])
    if (np.abs(scaled) > SAFE).any():
        raise ValueError("an entry is too large for a whole number")
    return filled[finite], scaled.astype(np.int64) + SHIFT


@dataclass(frozen=True)
class Fit:
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray


def _summed(df: DataFrame, vector: str, per_batch) -> dict[int, int]:
    """Exact sums over all rows of the numbers that ``per_batch`` makes of a matrix of whole numbers.

    Each task hands on one row per number; as many numbers as the dimension, or its square, reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            rows = whole(batch.column(0))[1]
            for at in range(0, len(rows), ROWS):
                part = per_batch(rows[at : at + ROWS])
                if total is not None and len(total) != len(part):
                    raise ValueError("vectors of different lengths")
                total = part if total is None else [a + b for a, b in zip(total, part)]
        if total is not None:
            cells = pa.array(range(len(total)), pa.int32())
            yield pa.RecordBatch.from_arrays([cells, pa.array([str(v) for v in total])], ["cell", "part"])

    parts = df.select(F.col(vector).alias("_vector")).mapInArrow(run, "cell int, part string")
    cells = parts.groupBy("cell").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s"))
    return {r["cell"]: int(r["s"]) for r in cells.collect()}


def _products(rows: np.ndarray) -> np.ndarray:
    """X'X exactly: by floating point where every sum stays below 2 ** 53, else by Python's whole numbers."""
    largest = int(np.abs(rows).max(initial=0))
    if largest * largest * max(len(rows), 1) < SAFE:
        return (rows.astype(float).T @ rows.astype(float)).astype(np.int64)
    return rows.T.astype(object) @ rows.astype(object)


def fit(df: DataFrame, vector: str, components: int = COMPONENTS) -> Fit:
    """Sums, covariance and components of all vectors that are not null and hold neither nulls nor non-finite entries.

    Rows are centred by the whole numbers nearest to the means before they are multiplied, and the rest of the mean is
    taken out in whole numbers of any size, so each covariance is exact before its one rounding. Empty vectors count
    as null. No vectors, or vectors that are all equal, have no components. Vectors of different lengths are an error.
    """
    first = _summed(df, vector, lambda rows: [len(rows), rows.size, *map(int, rows.sum(0))])
    n, sums = first.get(0, 0), [first[i] for i in range(2, len(first))]
    if not n:
        return Fit(0, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    size = len(sums)
    if first[1] != n * size:
        raise ValueError("vectors of different lengths")
    centre = np.array([round(s / n) if abs(s) < SAFE else s // n for s in sums], np.int64)
    upper = np.triu_indices(size)
    found = _summed(df, vector, lambda rows: list(map(int, _products(rows - centre)[upper])))
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    matrix = np.zeros((size, size))
    for k, (i, j) in enumerate(zip(*upper)):
        matrix[i, j] = matrix[j, i] = (n * found[k] - rest[i] * rest[j]) / (n * n)
    values, vectors = leading(matrix, components)
    return Fit(n, sums, float(np.trace(matrix)), values, vectors)


def _whitened(rows: np.ndarray, model: Fit) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S, exact, and the whitened components."""
    if model.n * int(np.abs(rows).max(initial=0)) >= 1 << 62:
        centred = rows.astype(object) * model.n - np.array(model.sums, object)
    else:
        centred = rows * model.n - np.array(model.sums, np.int64)
    return centred, centred.astype(float) / model.n @ model.vectors / np.sqrt(model.values)


def identity_error(df: DataFrame, vector: str, model: Fit) -> float | None:
    """The largest absolute entry of the whitened rows' covariance minus the identity; None without components."""
    size = len(model.values)
    if not size:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + size * size)
        for batch in batches:
            rows = whole(batch.column(0))[1]
            for at in range(0, len(rows), ROWS):
                white = _whitened(rows[at : at + ROWS], model)[1]
                total += np.concatenate([white.sum(0), (white.T @ white).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["cell", "part"])

    parts = df.select(F.col(vector).alias("_vector")).mapInArrow(run, "cell int, part double")
    found = {r["cell"]: r["s"] for r in parts.groupBy("cell").agg(F.sum("part").alias("s")).collect()}
    total = np.array([found[i] for i in range(size + size * size)]) / model.n
    mean, square = total[:size], total[size:].reshape(size, size)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(size)).max())


def whiten(df: DataFrame, key: str, vector: str, model: Fit) -> DataFrame:
    """One row per vector that counts and component: key, component (from 1), whitened, deviation, explained, eigenvalue.

    ``deviation`` is the exact sum of (n * x - S) ** 2 over the dimensions, null where that does not fit a long. Null
    and repeated keys keep their rows; other columns of the table are not looked at. No components give no rows.
    """
    size, explained = len(model.values), model.values / model.trace if model.trace else model.values
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, rows = whole(batch.column(1))
            names = batch.column(0).take(pa.array(kept))
            for at in range(0, len(rows) if size else 0, ROWS):
                centred, white = _whitened(rows[at : at + ROWS], model)
                count = len(white)
                if int(np.abs(centred).max(initial=0)) ** 2 * centred.shape[1] < 1 << 63:
                    deviation = pa.array((centred.astype(np.int64) ** 2).sum(1))
                else:
                    exact = [sum(int(v) ** 2 for v in row) for row in centred]
                    deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
                row = pa.array(np.repeat(np.arange(count), size))
                columns = [
                    names.slice(at, count).take(row), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), count)),
                    deviation.take(row), pa.array(white.ravel()), pa.array(np.tile(explained, count)),
                    pa.array(np.tile(model.values, count)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["_key", "component", "deviation", "whitened", "explained", "eigenvalue"])

    out = f"_key {kind}, component int, deviation long, whitened double, explained double, eigenvalue double"
    white = df.select(F.col(key).alias("_key"), F.col(vector).alias("_vector")).mapInArrow(run, out)
    return white.withColumnRenamed("_key", key)
