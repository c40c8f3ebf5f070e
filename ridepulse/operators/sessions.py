"""Rental starts inferred from gaps between GPS messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import time_bucket


def infer_starts(
    df: DataFrame, key: str, ts: str, gap_seconds: int, name: str = "session_start", slice_seconds: int | None = None
) -> DataFrame:
    """Give each row the time its run of messages began; a gap of ``gap_seconds`` or more starts a new run.

    Messages in one time slice no wider than the gap always share a run. So each slice shrinks to its first
    and last message with map-side combine, and only slices, never messages, go through a window per key.
    """
    width = slice_seconds or max(gap_seconds // 6, 1)
    if width > gap_seconds:
        raise ValueError("a slice must not be wider than the gap")
    rows = df.withColumn("_slice", time_bucket(F.col(ts), width))
    by_time = Window.partitionBy(key).orderBy("_slice")
    previous = F.lag("_last").over(by_time)
    opens = previous.isNull() | (F.col("_first") >= F.timestamp_add("SECOND", F.lit(gap_seconds), previous))
    slices = (
        rows.groupBy(key, "_slice")
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
        .withColumn("_opened", F.when(opens, F.col("_first")))
        .withColumn(
            name,
            F.last("_opened", ignorenulls=True).over(by_time.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .select(key, "_slice", name)
    )
    return rows.join(slices, [key, "_slice"]).drop("_slice")
