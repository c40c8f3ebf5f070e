"""Equi-joins whose left side may hold one key a third of the time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join so that adaptive execution can split the hot partitions of the left side.

    It only splits where both sides come straight from a shuffle for the join. An aggregated right side is
    already partitioned by the key and would be joined in place. A hash of the key as a further join column
    gives that side, which is small by comparison, a shuffle of its own.
    """
    key = F.xxhash64(*on)
    return left.withColumn("_key", key).join(right.withColumn("_key", key), [*on, "_key"], how).drop("_key")
