"""Helpers the operators share: stored intermediates, global row positions, text rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]+"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back, so that no later step depends on the executors that made it."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def fresh(columns: Sequence[str], name: str) -> str:
    """A column name based on ``name`` that no column has yet, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def store_rows(df: DataFrame, name: str, row: str = "_row") -> DataFrame:
    """Store with a row id that rises in the order of the rows: partition number above bit 33, position below it."""
    return store(df.withColumn(row, F.monotonically_increasing_id()), name)


def store_sorted(df: DataFrame, order: Sequence[str], name: str, row: str = "_row") -> DataFrame:
    """Store in a total order over all partitions, with such a row id.

    The rows' input position breaks ties, so even one key with most of the rows is cut over many partitions.
    """
    tie = fresh(df.columns, "_tie")
    numbered = df.withColumn(tie, F.monotonically_increasing_id())
    spread = numbered.repartitionByRange(*order, tie).sortWithinPartitions(*order, tie).drop(tie)
    return store_rows(spread, name, row)


def part_of(row: str | Column) -> Column:
    """The partition in a row id."""
    return F.shiftright(F.col(row) if isinstance(row, str) else row, 33)


def place_in(row: str) -> Column:
    """The position inside its partition in a row id."""
    return F.col(row).bitwiseAND(F.lit((1 << 33) - 1))


def part_starts(rows: DataFrame, value: Column, keys: Sequence[str] = (), row: str = "_row") -> DataFrame:
    """Per partition (and key): the total of ``value`` over the partitions before it, and in it.

    One row per partition and key, so the window runs over a table as short as the list of files.
    """
    group = [F.col(k) for k in keys] or [F.lit(0)]
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy(*keys, part_of(row).alias("_part"))
        .agg(F.sum(value).cast("long").alias("_in"))
        .withColumn("_start", F.coalesce(F.sum("_in").over(before), F.lit(0)))
    )


def row_key(key: str, text: str) -> Column:
    """A digest of key and text, nulls told apart from empty values: rows with equal digests have equal results."""
    known = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("-")) for c in (key, text)]
    return F.md5(F.concat(known[0], F.lit("\0"), known[1]))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once per row, however often lambdas inside refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_grams(words: Column, gram: int) -> Column:
    """The hash of every run of ``gram`` words."""

    def at(word: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(gram)])

    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - (gram - 1), F.lit(0))), at)


def drawn(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About twice ``rows`` of the rows, or all of fewer, by a hash of their key: the same rows on any cluster.

    What a task returns of a sample then does not grow with the number of tasks.
    """
    share = min(1.0, 2 * rows / max(df.count(), 1))
    return df.filter(F.pmod(F.xxhash64(key), F.lit(1 << 31)) < int(share * (1 << 31)))
