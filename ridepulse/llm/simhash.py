"""SimHash near-duplicates with bit-sliced comparison.

Distinct fingerprints meet in blocks that agree on all bytes but two: fingerprints that differ in at most two bits
always share such a block, and as only 16 bits are free a block never holds more than 65,536 fingerprints, whatever
the data. Inside a block the free bits are stored as bit planes. A fingerprint is compared with thousands of others
at once: the planes that differ are added into carry-save counters, and a slab of the block is abandoned as soon as
every distance in it exceeds the radius. A block hands on a spanning forest of its links, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, row_key, store
from .graph import components

SEED = 42
RADIUS = 2
BYTES = 8
#: Fingerprints of a block that are compared in one go.
SLAB = 8192
#: Shingles counted at a time in a long text.
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = 3) -> int:
    """The SimHash of a whole text as an unsigned 64-bit number; without words it is 0."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined, lengths = b" ".join(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts, span = ends - lengths, min(words, len(parts))
    starts, ends = starts[: len(parts) - span + 1], ends[span - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str, text: str, words: int = 3) -> DataFrame:
    """``key``, a digest of key and text, and the fingerprint as a signed long, per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in batch.column("_text")], "<u8").view("<i8")
            columns = [batch.column("_key"), batch.column("_digest"), pa.array(found)]
            yield pa.RecordBatch.from_arrays(columns, ["_key", "_digest", "_print"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("_key"), row_key(key, text).alias("_digest"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"_key {kind}, _digest string, _print long")


class Slab:
    """Up to ``SLAB`` fingerprints as vertical bit planes; bit i of a plane belongs to fingerprint i."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.size, self.radius = len(prints), radius
        bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        packed = np.packbits(bits, axis=0, bitorder="little")
        self.planes = [int.from_bytes(packed[:, k].tobytes(), "little") for k in range(64)]
        self.full = (1 << self.size) - 1
        self.counters = max(1, radius.bit_length())

    def within(self, query: int, among: int) -> int:
        """The fingerprints of ``among`` at most ``radius`` bits from the query, as a bit set."""
        counts, over, alive, waiting = [0] * self.counters, 0, among, None
        for k, plane in enumerate(self.planes):
            differ = plane ^ self.full if query >> k & 1 else plane
            if not differ:
                continue
            if waiting is None:
                waiting = differ
                continue
            # two planes go into the counters together: sum and carry of three bits
            low = counts[0]
            part = low ^ waiting
            carry, counts[0], waiting = (low & waiting) | (part & differ), part ^ differ, None
            alive, over = self._settle(counts, carry, over, alive)
            if not alive:
                return 0
        if waiting is not None:
            carry, counts[0] = counts[0] & waiting, counts[0] ^ waiting
            alive, over = self._settle(counts, carry, over, alive)
        return alive

    def _settle(self, counts: list[int], carry: int, over: int, alive: int) -> tuple[int, int]:
        for k in range(1, self.counters):
            counts[k], carry = counts[k] ^ carry, counts[k] & carry
        over |= carry
        more, equal = 0, self.full
        for k in reversed(range(self.counters)):
            if self.radius >> k & 1:
                equal &= counts[k]
            else:
                more |= equal & counts[k]
                equal &= ~counts[k]
        return alive & ~(over | more), over


def forest(prints: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Edges that connect exactly what links of at most ``radius`` bits connect; indices into ``prints``."""
    if len(prints) < 2:
        return
    slabs = [Slab(prints[at : at + SLAB], radius) for at in range(0, len(prints), SLAB)]
    unseen, values = [s.full for s in slabs], prints.tolist()
    for first in range(len(prints)):
        if not unseen[first // SLAB] >> first % SLAB & 1:
            continue
        unseen[first // SLAB] &= ~(1 << first % SLAB)
        queue = [first]
        while queue:
            at = queue.pop()
            for k, slab in enumerate(slabs):
                near = slab.within(values[at], unseen[k]) if unseen[k] else 0
                unseen[k] &= ~near
                while near:
                    low = near & -near
                    found = k * SLAB + low.bit_length() - 1
                    near ^= low
                    queue.append(found)
                    yield at, found


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that join what the radius joins. Takes one column ``_print``.

    The radius must leave equal bytes to block on; with ``radius`` bytes free a block is bounded by 256 ** radius.
    """
    if not 1 <= radius <= 2:
        raise ValueError("blocks are bounded for a radius of 1 or 2 bits")
    masks = [~sum(0xFF << 8 * b for b in free) & (2**64 - 1) for free in combinations(range(BYTES), radius)]
    masks = [m - 2**64 if m >= 2**63 else m for m in masks]
    tables = F.posexplode(F.array(*[F.col("_print").bitwiseAND(F.lit(m)) for m in masks])).alias("table", "same")
    blocks = prints.select("_print", tables).groupBy("table", "same").agg(F.collect_list("_print").alias("block"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [[], []]
            for block in batch.column("block"):
                values = np.sort(np.array(block.values, np.int64))
                for a, b in forest(values.view("<u8"), radius):
                    ends[0].append(values[a])
                    ends[1].append(values[b])
                if len(ends[0]) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], ["a", "b"])
                    ends = [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], ["a", "b"])

    return blocks.filter(F.size("block") > 1).select("block").mapInArrow(compare, "a long, b long")


def near_duplicates(df: DataFrame, key: str, text: str, words: int = 3, radius: int = RADIUS) -> DataFrame:
    """Per row: ``key``, ``_digest`` (of key and text), ``_print``, ``_component``, the smallest key reachable, and ``_root``.

    ``_root`` is the root fingerprint of the group, which tells groups apart whatever their keys.

    Null and empty texts have fingerprint 0 and are linked like any other; a null key never names a component with
    other keys in it, so a component of null keys only is null. Repeated rows each get a row. Other columns are not
    looked at. An empty table gives no rows.
    """
    rows = store(fingerprints(df, key, text, words), "prints")
    prints = store(rows.groupBy("_print").agg(F.min("_key").alias("_least")), "distinct-prints")
    roots = store(components(links(prints.select("_print"), radius)), "print-roots")
    rooted = prints.join(roots, F.col("_print") == F.col("node"), "left").withColumn("_root", F.coalesce("root", "_print"))
    rooted = store(rooted.select("_print", "_root", "_least"), "print-components")
    least = store(rooted.groupBy("_root").agg(F.min("_least").alias("_component")), "components")
    named = store(rooted.select("_print", "_root").join(least, "_root").select("_print", "_component", "_root"), "named-prints")
    return rows.join(named, "_print").select(F.col("_key").alias(key), "_digest", "_print", "_component", "_root")


def representatives(df: DataFrame, key: str, text: str, words: int = 3, radius: int = RADIUS) -> DataFrame:
    """One row of each component: a row with the smallest key, and among equal keys the smallest digest.

    Rows whose key and text repeat leave one row, that whose columns have the smallest hash, so reruns agree. All columns
    come back as they were.
    """
    digest = fresh(df.columns, "_row_digest")
    found = store(near_duplicates(df, key, text, words, radius), "near-duplicates")
    first = F.min(F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.col("_digest").alias("d"))).alias("m")
    chosen = found.groupBy("_root").agg(first).select(F.col("m.d").alias(digest))
    counts = found.groupBy(F.col("_digest").alias(digest)).agg(F.count("*").alias("_n"))
    kept = store(chosen.join(counts, digest), "representatives")
    rows = df.withColumn(digest, row_key(key, text))
    single = rows.join(kept.filter("_n = 1").select(digest), digest, "left_semi")
    several = rows.join(kept.filter("_n > 1").select(digest), digest, "left_semi")
    whole = F.struct(*df.columns)
    several = several.groupBy(digest).agg(F.min_by(whole, F.xxhash64(*df.columns)).alias("_whole")).select("_whole.*")
    return single.select(*df.columns).unionByName(several)
