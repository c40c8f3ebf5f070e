"""Exactly-once pickup of landed files.

The stream's checkpoint remembers which files were read, so no file needs a processed mark. A file that does
not parse leaves rows in the error table instead of stopping the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import PING_SCHEMA

CORRUPT = "_corrupt_record"


def new_files(
    spark: SparkSession, folder: str, schema: str = PING_SCHEMA, multi_line: bool = True, max_files: int = 1000
) -> DataFrame:
    """Stream of the rows of JSON array files that appear in a folder, with the file each came from."""
    return (
        spark.readStream.format("json")
        .schema(f"{schema}, {CORRUPT} STRING")
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
        .withColumn("file", F.col("_metadata.file_name"))
    )


def batch_folder(batch: DataFrame, batch_id: int) -> str:
    """A folder name of its own for each batch of each checkpoint."""
    return f"batch={batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    table: str,
    errors: str,
    checkpoint: str,
    schema: str = PING_SCHEMA,
    multi_line: bool = True,
) -> None:
    """Append the rows of files not seen before to a table, and broken records to an error table."""

    def store(batch: DataFrame, batch_id: int) -> None:
        good, bad = batch.filter(f"{CORRUPT} IS NULL").drop(CORRUPT), batch.filter(f"{CORRUPT} IS NOT NULL")
        # one folder per batch of a checkpoint: a batch that runs again replaces its own output only, and a new
        # checkpoint on the same table adds to it
        folder = batch_folder(batch, batch_id)
        good.write.mode("overwrite").parquet(f"{table}/{folder}")
        bad.select("file", CORRUPT).write.mode("overwrite").json(f"{errors}/{folder}")

    query = (
        new_files(spark, folder, schema, multi_line)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
