"""Writing into stores that keep the first row of a key, and run logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def insert_ignore(existing: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The incoming rows to append: one per key, the first by ``order``, and none whose key is stored already."""
    key = list(key)
    rest = [*order, *[c for c in incoming.columns if c not in [*key, *order]]]
    first = incoming.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_first"))
    rows = first.select(*[F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in incoming.columns])
    return rows.join(existing.select(*key), key, "left_anti")


def land_if_absent(df: DataFrame, path: str) -> None:
    """Write a landing folder unless it is there already."""
    df.write.mode("ignore").parquet(path)


def log_run(spark: SparkSession, path: str, run_at: str, counts: DataFrame) -> None:
    """Append one audit row with the processed and error counts of a run."""
    counts.select(
        F.lit(run_at).cast("timestamp_ntz").alias("run_at"),
        F.col("processed").cast("long").alias("processed"),
        F.col("errors").cast("long").alias("errors"),
    ).write.mode("append").parquet(path)


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def save_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, null_text: str = "NULL") -> None:
    """Headered CSV with a column order and a marker for nulls."""
    picked = df.select(*columns) if columns else df
    picked.write.mode("overwrite").option("header", True).option("nullValue", null_text).csv(path)
