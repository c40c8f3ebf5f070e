"""Weighted rendezvous sharding: every record goes to the shard that draws the best score for its key.

The score of a shard is ``-ln(u) / weight`` with ``u`` uniform in (0, 1) from a hash of the key and the shard, and
the smallest wins. A shard's share is its weight's share, and a new shard only takes records into itself, as the
other scores do not change. No record looks at another one, so a hot source or text costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, part_of, part_starts, place_in, store, store_sorted

#: Bits of the hash that make up the draw; all of them fit a double.
DRAW_BITS = 52


def _draw(key: Column, shard: Column) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit("/"), shard.cast("string"))), 1, DRAW_BITS // 4)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << DRAW_BITS))


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], shard: str = "shard", grown: str | None = None) -> DataFrame:
    """Add the shard (0 to len(weights) - 1) of each row, decided by its key and the weights alone.

    ``grown`` names a further column with the shard there would be if one more shard of weight 1 joined. Rows with
    equal keys share a shard. A null key counts as a key of its own; null and empty texts are like any other column.
    An empty table gives an empty table. An existing column called ``shard`` or ``grown`` is replaced.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    name, scores = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("null")), fresh(df.columns, "_scores")
    loads = F.array(*[F.lit(float(w)) for w in [*weights, 1.0][: len(weights) + bool(grown)]])
    drawn = F.transform(loads, lambda w, i: F.struct((-F.log(_draw(name, i)) / w).alias("score"), i.alias("shard")))
    rows = df.withColumn(scores, drawn)
    rows = rows.withColumn(shard, F.array_min(F.slice(scores, 1, len(weights)))["shard"].cast("int"))
    if grown:
        rows = rows.withColumn(grown, F.array_min(scores)["shard"].cast("int"))
    return rows.drop(scores)


def number_in_shards(rows: DataFrame, order: Sequence[str], shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Add a gapless position from 0 inside each shard, by ``order``; ties keep their input order.

    The narrow rows are stored in one total order by shard. A slot is then the row's global position less that of the
    shard's first row, so no task holds a shard.
    """
    row = fresh(rows.columns, "_row")
    ranked = store_sorted(rows, [shard, *order], "shards", row)
    parts = part_starts(ranked, F.lit(1), row=row).select("_part", "_start")
    before = Window.partitionBy(F.lit(0)).orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        ranked.groupBy(F.col(shard).alias("_shard"))
        .agg(F.count("*").alias("_n"))
        .select("_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    )
    place = F.col("_start") + place_in(row) - F.col("_first")
    return (
        ranked.withColumn("_part", part_of(row))
        .join(store(parts, "shard-parts"), "_part")
        .join(store(firsts, "shard-firsts"), F.col(shard) == F.col("_shard"))
        .select(*[F.col(c) for c in rows.columns if c != slot], place.cast("long").alias(slot))
    )


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    """Write whole rows below one folder per shard; every task writes its own files."""
    df.write.partitionBy(shard).parquet(path)
