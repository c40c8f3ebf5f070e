"""Counts, distributions and group statistics of demand and duration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import DOMAIN_ORDER
from ..functions.text import percent_string
from ..session import settle
from .joins import spread_join
from .ranking import exact_percentiles

# Limits of the battery buckets.
BATTERY_LIMITS = [0, 30, 50, 80, 100]


def value_counts(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    """Frequency of each known value, or its share; sort by ``n`` or ``share`` descending to read it."""
    known = df.filter(F.col(column).isNotNull())
    counts = known.groupBy(column).agg(F.count("*").alias("n"))
    if not normalize:
        return counts
    return counts.select(column, (F.col("n") / known.agg(F.count("*")).scalar()).alias("share"))


def share_of_total(groups: DataFrame, amount: str, name: str = "share") -> DataFrame:
    """Share of each of a few groups, such as weekdays; the window only sees the aggregated groups."""
    whole = Window.partitionBy(F.lit(0))
    return groups.withColumn(name, F.col(amount) / F.sum(amount).over(whole))


def battery_bucket(battery: Column) -> Column:
    """Left-closed buckets below 100; a full or unknown battery falls in none."""
    labels = DOMAIN_ORDER["battery_status"]
    bucket = F.when((battery >= BATTERY_LIMITS[0]) & (battery < BATTERY_LIMITS[1]), labels[0])
    for low, high, label in zip(BATTERY_LIMITS[1:-1], BATTERY_LIMITS[2:], labels[1:]):
        bucket = bucket.when((battery >= low) & (battery < high), label)
    return bucket


def battery_status(df: DataFrame, battery: str) -> DataFrame:
    """Count and share per battery bucket; a bucket without rentals shows null."""
    counted = (
        df.select(battery_bucket(F.col(battery)).alias("battery_status"))
        .filter(F.col("battery_status").isNotNull())
        .groupBy("battery_status")
        .agg(F.count("*").alias("counts"))
    )
    shares = share_of_total(counted, "counts", "per").withColumn("per100", percent_string(F.col("per")))
    labels = df.sparkSession.sql(
        "SELECT * FROM VALUES " + ", ".join(f"('{label}')" for label in DOMAIN_ORDER["battery_status"]) + " AS t(battery_status)"
    )
    return labels.join(shares, "battery_status", "left")


def by_each(df: DataFrame, factors: Sequence[str], aggregates: Sequence[Column], fixed: Sequence[str] = ()) -> DataFrame:
    """The same aggregates once per factor from one scan, as rows (factor, level, ...).

    Each row is repeated per factor and combined map-side, so the shuffle carries groups, not rows.
    """
    pairs = [F.struct(F.lit(f).alias("factor"), F.col(f).cast("string").alias("level")) for f in factors]
    return df.select("*", F.inline(F.array(*pairs))).groupBy(*fixed, "factor", "level").agg(*aggregates)


def zero_summary(df: DataFrame, by: Sequence[str] = (), value: str = "demand") -> DataFrame:
    """Share of zeros in percent, mean, sample variance and deviation, row count."""
    v = F.col(value)
    return df.groupBy(*by).agg(
        (F.try_divide(F.count_if(v == 0), F.count("*")) * 100).alias("zeros_pct"),
        F.avg(v).alias("mean"),
        F.var_samp(v).alias("var"),
        F.stddev_samp(v).alias("std"),
        F.count("*").alias("n"),
    )


def describe(df: DataFrame, value: str, probs: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Count, mean, deviation, extremes, exact percentiles and variance of one column."""
    counts = df.groupBy(value).agg(F.count("*").alias("_n"))
    names = [f"p{round(p * 100)}" for p in probs]
    exact = exact_percentiles(counts, value, "_n", probs, names)
    return df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.var_samp(value).alias("variance"),
    ).join(exact)


def box_stats(df: DataFrame, value: str, factors: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and outlier count per level of each factor.

    Rows are first counted per (factor, level, value). Exact quartiles then come from the ranks of the counts, so a
    level that holds most rows or values is as cheap as any other. An unknown level is a level; a level without a
    known value is left out.
    """
    counted = by_each(df, factors, [F.count("*").alias("n")], fixed=[value]).filter(F.col(value).isNotNull())
    # a null level would be lost in the joins by level
    known = F.when(F.col("level").isNull(), F.lit("-")).otherwise(F.concat(F.lit("v"), F.col("level")))
    counts = settle(counted.withColumn("level", known), "box-counts")
    v, n = F.col(value), F.col("n")
    quartiles = exact_percentiles(counts, value, "n", (0.25, 0.5, 0.75), ("q1", "median", "q3"), ["factor", "level"])
    low = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    high = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = (v >= low) & (v <= high)
    return (
        spread_join(counts, quartiles, ["factor", "level"], "inner")
        .withColumn("level", F.when(F.col("level") != "-", F.substr("level", F.lit(2))))
        .groupBy("factor", "level", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(n)).alias("outliers"),
            F.sum(n).alias("n"),
        )
    )


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed on both sides; a constant is one bin."""
    span = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    width = (span["hi"] - span["lo"]) / F.lit(float(bins))
    at = F.when(F.col(value).isNotNull(), F.coalesce(F.try_divide(F.col(value) - span["lo"], width), F.lit(0.0)))
    bin_no = F.least(F.floor(at), F.lit(bins - 1)).cast("int")
    return df.groupBy(bin_no.alias("bin")).agg(F.count("*").alias("n"))


def tallest_bar(counts: DataFrame, label: str) -> DataFrame:
    """The most frequent value; the smallest one on a tie."""
    return counts.orderBy(F.col("n").desc(), F.col(label)).limit(1)


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair from one aggregate, as rows (left, right, corr)."""
    pairs = [(a, b) for a in columns for b in columns if a <= b]
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = []
    for a, b in pairs:
        for left, right in {(a, b), (b, a)}:
            rows.append(F.struct(F.lit(left).alias("left"), F.lit(right).alias("right"), F.col(f"`{a}|{b}`").alias("corr")))
    return one.select(F.inline(F.array(*rows)))


def skewness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population skewness per column."""
    one = df.agg(*[F.skewness(c).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("skew")) for c in columns]
    return one.select(F.inline(F.array(*rows)))


def dispersion(df: DataFrame, value: str = "demand") -> DataFrame:
    """Variance over mean; above 2 counts are called overdispersed."""
    ratio = F.try_divide(F.var_samp(value), F.avg(value))
    return df.agg(ratio.alias("dispersion")).withColumn("overdispersed", F.col("dispersion") > 2)


def unusual_days(daily: DataFrame, amount: str, deviations: float = 2.0) -> DataFrame:
    """Days above the mean by more than the given number of sample deviations."""
    stats = daily.agg(F.struct(F.avg(amount).alias("mean"), F.stddev_samp(amount).alias("std"))).scalar()
    return daily.filter(F.col(amount) > stats["mean"] + F.lit(deviations) * stats["std"])


def outlier_share(df: DataFrame, limit: int, value: str = "demand") -> DataFrame:
    """Outlier count and percentage, and the mean with and without them."""
    v = F.col(value)
    return df.agg(
        F.count_if(v > limit).alias("outliers"),
        F.round(F.try_divide(F.count_if(v > limit), F.count("*")) * 100, 2).alias("outliers_pct"),
        F.round(F.avg(v), 2).alias("mean_all"),
        F.round(F.avg(F.when(v <= limit, v)), 2).alias("mean_without"),
    )
