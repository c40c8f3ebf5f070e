"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on, or that keep skewed joins splittable.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # runs of messages shrink before they are shuffled
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # building a plan records a stack trace per column otherwise
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which all executors can reach.

    A machine-local folder is only made up when the session runs in local mode and names none.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ridepulse-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created or removed here."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Later steps then neither repeat its work nor depend on the executors that did it, and the optimizer
    knows its real size when it picks a join.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
