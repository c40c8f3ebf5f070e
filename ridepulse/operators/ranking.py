"""Positions inside groups of any size.

A window over a whole group puts the group into one task. Here the group is first cut into buckets
that follow the sort order. Rows per bucket are counted with map-side combine, the small bucket table
is summed up per group, and the row number is only taken inside a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .joins import spread_join

#: Rows that one task may sort.
BUCKET_ROWS = 1_000_000
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def time_bucket(ts: Column, seconds: int) -> Column:
    """Number of the fixed-width time slice that holds the timestamp."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(EPOCH), ts)
    return F.floor(micros / F.lit(seconds * 1e6))


def ordinal_in_buckets(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[Column],
    name: str = "ordinal",
    descending: bool = False,
) -> DataFrame:
    """Exact 1-based position per ``keys`` by ``order``.

    ``bucket`` must rise (or fall, with ``descending``) along ``order``; its width is what bounds a task.
    """
    rows = df.withColumn("_bucket", bucket)
    group = [F.col(k) for k in keys] or [F.lit(0)]
    step = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    before = Window.partitionBy(*group).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        rows.join(offsets, [*keys, "_bucket"])
        .withColumn(name, (F.row_number().over(inside) + F.col("_before")).cast("long"))
        .drop("_bucket", "_before")
    )


def ordinal_by_time(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    name: str = "ordinal",
    descending: bool = False,
    ties: Sequence[Column] = (),
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Position of each row per key by time, oldest or newest first."""
    first = F.col(ts).desc() if descending else F.col(ts).asc()
    return ordinal_in_buckets(df, keys, time_bucket(F.col(ts), bucket_seconds), [first, *ties], name, descending)


def ordinal_shuffled(df: DataFrame, key: Sequence[Column], seed: int, name: str, buckets: int) -> DataFrame:
    """Number all rows 1..n in a pseudo-random order that depends only on the key and the seed.

    A task sorts one bucket, so ``buckets`` has to follow the number of rows; ``buckets_for`` does.
    """
    draw = F.xxhash64(F.lit(seed), *key)
    return ordinal_in_buckets(df, [], F.pmod(draw, F.lit(buckets)), [draw, *key], name)


def buckets_for(df: DataFrame) -> int:
    """So many buckets that each holds about ``BUCKET_ROWS`` rows."""
    return df.count() // BUCKET_ROWS + 1


def running_total(counts: DataFrame, value: str, n: str, name: str = "upto", keys: Sequence[str] = ()) -> DataFrame:
    """Cumulative ``n`` along the distinct values of each key.

    Values are dealt to ranges that Spark cuts at sampled quantiles, so outliers or a hot key leave the ranges equal.
    The ranges are written, as their sums and their rows have to agree.
    """
    cut = settle(counts.repartitionByRange(*keys, value).withColumn("_bucket", F.spark_partition_id()), "ranges")
    group = [F.col(k) for k in keys] or [F.lit(0)]
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "_bucket")
        .agg(F.sum(n).alias("_n"))
        .select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.join(offsets, [*keys, "_bucket"])
        .withColumn(name, F.sum(n).over(inside) + F.col("_before"))
        .drop("_bucket", "_before")
    )


#: Ranges that a key's values are cut into to find the ranks of its percentiles.
CUTS = 64


def cut_points(value: Column, cuts: int) -> Column:
    """Aggregate: values that cut the rows into about equal parts, rising. The sketch behind it has a bounded size."""
    sketch = F.kll_sketch_agg_double(value.cast("double"), F.lit(800))
    return F.array_distinct(F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / cuts) for i in range(1, cuts)])))


def exact_percentiles(
    counts: DataFrame, value: str, n: str, probs: Sequence[float], names: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Interpolated percentiles per key from value counts, by rank, with no sort of all values.

    A sketch of the values cuts each key into ranges, rows are counted per range, and only the ranges that hold a wanted
    rank are ranked. The sketch decides where the cuts lie and nothing else, so the result is exact. Unknown values have no
    rank. Keys without a known value are left out; without keys that is one row of nulls.
    """
    known, v = counts.filter(F.col(value).isNotNull()), F.col(value)
    spans = known.groupBy(*keys).agg(cut_points(v, CUTS).alias("_cuts"), F.sum(n).alias("_total"))
    if keys:
        rows = spread_join(known, spans, keys, "inner")
    else:
        rows = known.withColumn("_span", spans.select(F.struct("_cuts", "_total")).scalar()).select("*", "_span.*").drop("_span")
    # NaN is above every number here, as it is in an order
    rows = rows.withColumn("_range", F.size(F.filter("_cuts", lambda cut: cut < v.cast("double")))).drop("_cuts")
    group = [F.col(k) for k in keys] or [F.lit(0)]
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "_range").agg(F.sum(n).alias("_n"), F.max("_total").alias("_total"))
    sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    at = [F.lit(float(p)) * (F.col("_total") - 1) for p in probs]
    wanted = [rank for place in at for rank in (F.floor(place), F.ceil(place))]
    held = [(F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n")) for rank in wanted]
    ranges = sums.filter(F.exists(F.array(*held), lambda hit: hit)).select(*keys, "_range", "_before")
    inside = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = spread_join(rows, ranges, [*keys, "_range"], "inner").withColumn("_upto", F.sum(n).over(inside) + F.col("_before"))

    # the first value that reaches a rank, in the range that holds it
    firsts = [
        F.min(F.when((F.col("_before") <= rank) & (F.col("_upto") > rank), v)).alias(f"_{side}{i}")
        for i, place in enumerate(at)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place)))
    ]
    found = ranked.groupBy(*keys).agg(F.max("_total").alias("_total"), *firsts)
    between = [
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (place - F.floor(place))).cast("double").alias(name)
        for i, (place, name) in enumerate(zip(at, names))
    ]
    return found.select(*keys, *between)
