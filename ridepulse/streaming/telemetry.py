"""Streaming twins of the message jobs: unique messages, inferred rentals and hourly totals."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .landing import batch_folder

def message_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """Messages from a growing set of parquet files."""
    return spark.readStream.schema(schema).parquet(path)


def event_time(stream: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermarks need a zoned timestamp; the session zone is UTC, so the clock reading stays the same."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def store_unique(stream: DataFrame, key: list[str], ts: str, table: str, checkpoint: str) -> DataFrame:
    """Append the messages whose key the table does not have yet, however late they come; gives the table.

    The table is laid out by batch and by the date of ``ts``, so a batch reads the dates it holds and no others, and a
    batch that runs again replaces its own output. Messages without a time are kept under a date of null. Copies
    inside a batch are combined before the shuffle; the dates of a batch reach the driver.
    """
    spark, rest = stream.sparkSession, [c for c in stream.columns if c not in key]
    schema = f"{', '.join(f'{c} {t}' for c, t in stream.dtypes)}, day date, batch string"

    def known() -> DataFrame:
        return spark.read.schema(schema).parquet(table)

    def store(batch: DataFrame, batch_id: int) -> None:
        own = batch_folder(batch, batch_id)
        first = batch.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_rest"))
        rows = first.select(*[F.col(c) if c in key else F.col(f"_rest.{c}").alias(c) for c in batch.columns])
        rows = settle(rows.withColumn("day", F.to_date(ts)), "messages")
        # the stored keys of these days, named one by one so that no other folder is read; a null is a day and a key
        # like any other
        days = [r.day for r in rows.select("day").distinct().collect()]
        of_days = F.col("day").isin([d for d in days if d is not None])
        if None in days:
            of_days = of_days | F.col("day").isNull()
        old = known().filter(of_days).filter(F.col("batch") != own.partition("=")[2])
        same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(old[c]) for c in ["day", *key]])
        rows.join(old, same, "left_anti").write.mode("overwrite").partitionBy("day").parquet(f"{table}/{own}")

    spark.createDataFrame([], stream.schema).withColumn("day", F.lit(None).cast("date")).write.mode("ignore").partitionBy("day").parquet(f"{table}/batch=none")
    query = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return known().select(*stream.columns)


def inferred_rentals(stream: DataFrame, key: str, ts: str, gap: str = "6 hours", delay: str = "1 hour") -> DataFrame:
    """Rentals as runs of messages without a longer gap; a run comes out once the watermark has passed its end.

    Runs are merged inside each input partition before the shuffle (a setting of the session), so a busy bike sends
    few rows.
    """
    return (
        event_time(stream, ts, delay)
        .groupBy(key, F.session_window(ts, gap).alias("run"))
        .agg(F.min(ts).alias("started"), F.max(ts).alias("last_seen"), F.count("*").alias("messages"))
        .drop("run")
    )


def hourly_totals(stream: DataFrame, ts: str, value: str, delay: str = "1 hour") -> DataFrame:
    """Count and mean per hour, emitted when the hour is complete."""
    return (
        event_time(stream, ts, delay)
        .groupBy(F.window(ts, "1 hour").alias("hour"))
        .agg(F.count("*").alias("total"), F.avg(value).alias("mean_value"))
        .select(F.col("hour.start").alias("hour_start"), "total", "mean_value")
    )


def run_available(stream: DataFrame, table: str, checkpoint: str, conf: Mapping[str, str] | None = None) -> DataFrame:
    """Process everything that has arrived, append the results to a table and return the table.

    ``conf`` holds settings of this query alone; the session's own are put back once the query has taken them.
    """
    spark = stream.sparkSession
    before = {name: spark.conf.get(name, None) for name in conf or {}}
    for name, value in (conf or {}).items():
        spark.conf.set(name, value)
    try:
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", table)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    return spark.read.schema(stream.schema).parquet(table)
