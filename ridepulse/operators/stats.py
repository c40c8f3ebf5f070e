"""Rank tests and serial correlation without a global sort."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle
from .profile import by_each
from .ranking import running_total


def average_ranks(df: DataFrame, value: str) -> DataFrame:
    """Rank of each distinct value, ties sharing their mean rank. Works on value counts, not on rows."""
    return ranks_of_counts(settle(df.groupBy(value).agg(F.count("*").alias("ties")), "value-counts"), value)


def ranks_of_counts(counts: DataFrame, value: str) -> DataFrame:
    ranked = running_total(counts, value, "ties", "upto")
    return ranked.select(value, "ties", (F.col("upto") - (F.col("ties") - 1) / F.lit(2.0)).alias("avg_rank"))


@F.pandas_udf(T.DoubleType())
def chi_square_tail(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
    """P(X > statistic) for whole degrees of freedom, by the finite series."""

    def tail(x: float, k: int) -> float:
        half = x / 2
        if half <= 0:
            return 1.0
        if k % 2 == 0:
            return sum(math.exp(i * math.log(half) - half - math.lgamma(i + 1)) for i in range(k // 2))
        series = sum(math.exp((i - 0.5) * math.log(half) - half - math.lgamma(i + 0.5)) for i in range(1, (k + 1) // 2))
        return math.erfc(math.sqrt(half)) + series

    return pd.Series([tail(x, int(k)) for x, k in zip(statistic, freedom)])


def kruskal_wallis(df: DataFrame, target: str, factors: Sequence[str]) -> DataFrame:
    """H with tie correction and its degrees of freedom for every factor, from one pass of value counts."""
    counts = settle(by_each(df, factors, [F.count("*").alias("n")], fixed=[target]), "factor-counts")
    whole = counts.filter(F.col("factor") == factors[0]).groupBy(target).agg(F.sum("n").alias("ties"))
    ranks = ranks_of_counts(whole, target)
    ties = F.col("ties").cast("double")
    total = ranks.agg(
        F.struct(F.sum(ties).alias("n"), F.sum(ties * ties * ties - ties).alias("t"))
    ).scalar()
    size = total["n"]
    sums = (
        counts.join(ranks, target)
        .groupBy("factor", "level")
        .agg(F.sum(F.col("n") * F.col("avg_rank")).alias("rank_sum"), F.sum("n").alias("n"))
    )
    raw = sums.groupBy("factor").agg(
        F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n")).alias("s"), (F.count("*") - 1).alias("freedom")
    )
    h = 12 / (size * (size + 1)) * F.col("s") - 3 * (size + 1)
    return raw.select("factor", (h / (1 - total["t"] / (size * size * size - size))).alias("h"), "freedom")


def kruskal_decision(df: DataFrame, target: str, factors: Sequence[str], level: float = 0.05) -> DataFrame:
    """The same with the p-value and whether the target differs between the factor's levels."""
    tested = kruskal_wallis(df, target, factors)
    return tested.withColumn("p_value", chi_square_tail("h", "freedom")).withColumn(
        "related", F.col("p_value") < F.lit(level)
    )


def with_lags(df: DataFrame, index: str, value: str, lags: int, width: int = 4096) -> DataFrame:
    """Columns ``lag_1`` .. ``lag_n`` of a series with a gapless integer index.

    The series is cut into chunks; the last rows of a chunk are copied in front of the next one, so each chunk
    is a task of its own and nothing is sorted as a whole.
    """
    if width < lags:
        raise ValueError("a chunk must be at least as long as the largest lag")
    own = F.floor(F.col(index) / width)
    at_end = F.col(index) - own * width >= width - lags
    copies = df.withColumn("_own", own).withColumn(
        "_chunk", F.explode(F.when(at_end, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    by_time = Window.partitionBy("_chunk").orderBy(index)
    shifted = {f"lag_{k}": F.lag(value, k).over(by_time) for k in range(1, lags + 1)}
    return copies.withColumns(shifted).filter("_chunk = _own").drop("_chunk", "_own")


def durbin_watson(residuals: DataFrame, index: str, residual: str) -> DataFrame:
    """Squared steps over squared residuals; 2 means no serial correlation."""
    e = F.col(residual)
    step = e - F.col("lag_1")
    return with_lags(residuals, index, residual, 1).agg((F.sum(step * step) / F.sum(e * e)).alias("durbin_watson"))


def autocorrelation(series: DataFrame, index: str, value: str, lags: int) -> DataFrame:
    """Autocorrelation at lag 0 to ``lags``."""
    mean = series.agg(F.avg(value)).scalar()
    centred = series.select(index, (F.col(value) - mean).alias("_e"))
    e = F.col("_e")
    sums = with_lags(centred, index, "_e", lags).agg(
        F.sum(e * e).alias("c0"), *[F.sum(e * F.col(f"lag_{k}")).alias(f"c{k}") for k in range(1, lags + 1)]
    )
    rows = [F.struct(F.lit(k).alias("lag"), (F.col(f"c{k}") / F.col("c0")).alias("acf")) for k in range(lags + 1)]
    return sums.select(F.inline(F.array(*rows)))


def partial_autocorrelation(series: DataFrame, index: str, value: str, lags: int) -> DataFrame:
    """Partial autocorrelation from the autocorrelations by the Durbin-Levinson recursion.

    Only the short vector of autocorrelations reaches the driver.
    """
    r = [row.acf for row in autocorrelation(series, index, value, lags).orderBy("lag").collect()]
    partial, phi = [1.0], []
    for k in range(1, lags + 1):
        rest = r[k] - sum(phi[j] * r[k - 1 - j] for j in range(k - 1))
        scale = 1 - sum(phi[j] * r[j + 1] for j in range(k - 1))
        last = rest / scale
        phi = [phi[j] - last * phi[k - 2 - j] for j in range(k - 1)] + [last]
        partial.append(last)
    rows = ", ".join(f"({k}, CAST({v!r} AS DOUBLE))" for k, v in enumerate(partial))
    return series.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(lag, pacf)")
