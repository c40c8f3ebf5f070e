"""Rentals kept up to date batch by batch.

The store is four tables: raw messages of rentals not yet processed, finished rentals, their coordinates and the run log.
A batch writes a version of each table and then one row into the list of versions; readers and later batches see a
version from that row on, so a batch that broke off halfway is never seen, and running it again replaces what it left.
Finished rentals lie in folders by the date they started, and a batch reads the folders of its own dates only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pings import PING_KEY
from ..operators.rentals import RENTAL_KEY, process_batch
from ..session import settle
from ..sources.store import insert_ignore
from .landing import batch_folder

RENTAL_SCHEMA = "last_rental_start TIMESTAMP_NTZ, bike_id BIGINT, battery_start INT, battery_end INT, duration INT"
COORDINATE_SCHEMA = "date TIMESTAMP_NTZ, bike_id BIGINT, latitude DOUBLE, longitude DOUBLE"
PING_SCHEMA = """bike_id BIGINT, last_rental_start TIMESTAMP_NTZ, last_gps_time TIMESTAMP_NTZ, battery INT,
    latitude DOUBLE, longitude DOUBLE"""
LOG_SCHEMA = "processed BIGINT, errors BIGINT, batch_id BIGINT"
VERSION_SCHEMA = "number BIGINT, version STRING"

TABLES = {"rentals": RENTAL_SCHEMA, "coordinates": COORDINATE_SCHEMA, "log": LOG_SCHEMA, "raw": PING_SCHEMA}
#: Tables whose versions are laid out by the date of a column.
BY_DAY = {"rentals": "last_rental_start", "coordinates": "date"}


@dataclass
class RentalStore:
    """Tables below one folder, one subfolder per version; ``create`` lays down what is missing of an empty store.

    One writer at a time. Streams with checkpoints of their own may take turns: a version is named after the query and
    its batch, and follows the version before it by name.
    """

    spark: SparkSession
    folder: str

    @classmethod
    def create(cls, spark: SparkSession, folder: str) -> RentalStore:
        spark.createDataFrame([], VERSION_SCHEMA).write.mode("ignore").parquet(f"{folder}/versions")
        store = cls(spark, folder)
        for table, schema in TABLES.items():
            # a folder of no version, so that the table can be read before its first row
            store._write(spark.createDataFrame([], schema), table, "none", "ignore")
        return store

    def versions(self) -> list[str]:
        """Names of the complete versions, oldest first; a row per batch that ever ran."""
        rows = self.spark.read.schema(VERSION_SCHEMA).parquet(f"{self.folder}/versions").orderBy("number").collect()
        return [r.version for r in rows]

    def _write(self, df: DataFrame, table: str, version: str, mode: str = "overwrite") -> None:
        path, day = f"{self.folder}/{table}/version={version}", BY_DAY.get(table)
        if day:
            # a date's rows lie together, a long date's in several files
            df.withColumn("day", F.to_date(day)).write.mode(mode).partitionBy("day").parquet(path)
        else:
            df.write.mode(mode).parquet(path)

    def read(self, table: str, versions: list[str] | None = None) -> DataFrame:
        """A table with its version (and day), by default over all complete versions."""
        day = ", day DATE" if table in BY_DAY else ""
        rows = self.spark.read.schema(f"{TABLES[table]}, version STRING{day}").parquet(f"{self.folder}/{table}")
        return rows.filter(F.col("version").isin(self.versions() if versions is None else versions))

    @property
    def rentals(self) -> DataFrame:
        return self.read("rentals").drop("version", "day")

    @property
    def coordinates(self) -> DataFrame:
        return self.read("coordinates").drop("version", "day")

    @property
    def log(self) -> DataFrame:
        return self.read("log")

    @property
    def raw(self) -> DataFrame:
        """Messages of the rentals that are still open, as the newest version left them."""
        return self.read("raw", self.versions()[-1:]).drop("version")

    def finished_on(self, days: list, versions: list[str]) -> DataFrame:
        """Keys of the finished rentals that started on these dates; no other date's folder is read."""
        of_days = F.col("day").isin([d for d in days if d is not None])
        if None in days:
            of_days = of_days | F.col("day").isNull()
        return self.read("rentals", versions).filter(of_days).select(*RENTAL_KEY)

    def apply(self, messages: DataFrame, batch_id: int) -> None:
        """Add messages, process the rentals a newer start has closed, purge them, log the run.

        A late message of a finished rental leaves the rental row as it is, still adds its coordinates and is purged
        again. A batch whose version is complete already changes nothing. The dates of its rentals reach the driver.
        """
        name, versions = batch_folder(messages, batch_id).partition("=")[2], self.versions()
        if name in versions:
            return
        known = self.read("raw", versions[-1:]).drop("version")
        fresh = insert_ignore(known, messages.select(*known.columns), PING_KEY, ["battery"])
        pending = settle(known.unionByName(fresh), "pending")
        batch = process_batch(pending)
        rentals = settle(batch.rentals, "batch-rentals")
        days = [r.day for r in rentals.select(F.to_date("last_rental_start").alias("day")).distinct().collect()]
        self._write(rentals.join(self.finished_on(days, versions), RENTAL_KEY, "left_anti"), "rentals", name)
        self._write(batch.coordinates, "coordinates", name)
        self._write(batch.log.withColumn("batch_id", F.lit(batch_id).cast("long")), "log", name)
        self._write(batch.remaining, "raw", name)
        self.spark.createDataFrame([(len(versions), name)], VERSION_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.folder}/versions")


def stream_rentals(messages: DataFrame, store: RentalStore, checkpoint: str) -> None:
    """Run the store over everything a message stream has available."""
    query = (
        messages.writeStream.foreachBatch(store.apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
