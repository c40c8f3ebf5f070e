"""Token files: every document one zstandard frame under a shared dictionary, in blocks with an offset index.

A token folder holds ``blocks`` (Parquet rows: joined frames, keys, frame offsets and token counts, dictionary hash)
and ``dictionary`` (its hash and bytes). Blocks are in ascending key order and carry their first and last key, so a
document is read by pruning to its block and decompressing its own short frame.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drawn, part_of, part_starts, store
from .tokens import encoded, encoder

#: The dictionary is trained on so many documents, those with the smallest key hash, and so many characters of each,
#: from a place that another hash picks.
SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS = 2000, 4096
DICTIONARY_BYTES = 64 << 10
#: A block is closed at so many bytes of frames or documents.
BLOCK_BYTES, BLOCK_DOCUMENTS = 4 << 20, 4096
LEVEL = 3
FIELDS = (
    "first_key {key}, last_key {key}, keys array<{key}>, frames binary, offsets array<int>, counts array<long>, "
    "tokens long, width int, dictionary_hash string"
)


def width_of(path: str, end_id: int) -> int:
    """Bytes per serialized id: two where the vocabulary allows it."""
    return 2 if max(end_id, encoder(path).tokenizer.get_vocab_size() - 1) < 1 << 16 else 4


def _serial(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def train_dictionary(df: DataFrame, key: str, text: str, path: str, end_id: int = 0) -> bytes:
    """A dictionary from a bounded sample; where it is too small to train on, the sample itself serves as one."""
    width, end = width_of(path, end_id), np.array([end_id], "<u4").tobytes()
    room = F.greatest(F.length(text) - SAMPLE_CHARACTERS, F.lit(0)) + 1
    head = F.col(text).substr((F.pmod(F.xxhash64(F.lit(1), key), room) + 1).cast("int"), F.lit(SAMPLE_CHARACTERS)).alias("head")
    draw = F.xxhash64(key).alias("draw")
    found = drawn(df, key, SAMPLE_DOCUMENTS).select(draw, head).filter(F.length("head") > 0).orderBy("draw", "head").limit(SAMPLE_DOCUMENTS).collect()
    samples = [_serial(ids + end, width) for ids in encoded(path, pa.array([r["head"] for r in found], pa.string()))]
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def write_tokens(df: DataFrame, key: str, text: str, folder: str, path: str, end_id: int = 0) -> None:
    """Write the ids of every text and ``end_id`` in ascending key order; null texts count as empty.

    Equal keys stay separate documents in input order, null keys come first. Further columns are not stored. An
    empty table gives a folder without blocks.
    """
    spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()
    raw, width = train_dictionary(df, key, text, path, end_id), width_of(path, end_id)
    digest, end = hashlib.sha256(raw).hexdigest(), np.array([end_id], "<u4").tobytes()
    spark.createDataFrame([(digest, raw)], "hash string, bytes binary").write.parquet(f"{folder}/dictionary")
    fields = FIELDS.format(key=kind)
    rows = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    ordered = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange("_key", "_tie")
    ordered = ordered.sortWithinPartitions("_key", "_tie").drop("_tie")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstd.ZstdCompressor(level=LEVEL, dict_data=_dictionary(raw, LEVEL), write_content_size=True)
        keys: list = []
        frames: list[bytes] = []
        counts: list[int] = []

        def block() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist()
            values = [keys[0], keys[-1], keys, b"".join(frames), offsets, counts, sum(counts), width, digest]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

        for batch in batches:
            kind = batch.schema.field("_key").type
            types = [kind, kind, pa.list_(kind), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.string()]
            names = [f.strip().split()[0] for f in fields.split(",")]
            size = sum(map(len, frames))
            for name, ids in zip(batch.column("_key"), encoded(path, batch.column("_text"))):
                keys.append(name.as_py())
                frames.append(packer.compress(_serial(ids + end, width)))
                counts.append(len(ids) // 4 + 1)
                size += len(frames[-1])
                if size > BLOCK_BYTES or len(frames) >= BLOCK_DOCUMENTS:
                    yield block()
                    size = 0
                    keys, frames, counts = [], [], []
        if keys:
            yield block()

    blocks = ordered.mapInArrow(compress, fields).withColumn("block", F.monotonically_increasing_id())
    # frames are compressed already
    blocks.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def _dictionary(raw: bytes, level: int | None = None) -> zstd.ZstdCompressionDict | None:
    """The dictionary, digested once where it is to compress many short frames."""
    found = zstd.ZstdCompressionDict(raw) if raw else None
    if found and level is not None:
        found.precompute_compress(level=level)
    return found


def _opener(spark: SparkSession, folder: str):
    """The stored dictionary, checked against its hash."""
    row = spark.read.parquet(f"{folder}/dictionary").first()
    raw = bytes(row["bytes"])
    if hashlib.sha256(raw).hexdigest() != row["hash"]:
        raise ValueError("the dictionary does not match its hash")
    return raw, row["hash"]


def read_tokens(spark: SparkSession, folder: str, key: str = "doc_id", only: list | None = None) -> DataFrame:
    """One row per document in the files: key, block, n_tokens, place (tokens before it in its block) and ids.

    ``only`` lists keys to fetch: blocks are pruned by their key range and no other frame is decompressed.
    """
    raw, digest = _opener(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["first_key"].dataType.simpleString()
    if only is not None:
        near = F.lit(False)
        for wanted_key in only:
            # null keys come first, so a block that starts with one may hold any key up to its last
            near = near | (F.coalesce(F.col("first_key") <= wanted_key, F.lit(True)) & (F.col("last_key") >= wanted_key))
        blocks = blocks.filter(near)
    wanted = None if only is None else set(only)

    def decompress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstd.ZstdDecompressor(dict_data=_dictionary(raw))
        for batch in batches:
            for at in range(batch.num_rows):
                # one block at a time
                row = batch.slice(at, 1).to_pylist()[0]
                if row["dictionary_hash"] != digest:
                    raise ValueError("a block was written with another dictionary")
                serial, found, place, frames = f"<u{row['width']}", [], 0, memoryview(row["frames"])
                size = 0
                for k, (name, count) in enumerate(zip(row["keys"], row["counts"])):
                    if wanted is None or name in wanted:
                        ids = opener.decompress(frames[row["offsets"][k] : row["offsets"][k + 1]])
                        ids = np.frombuffer(ids, serial).astype("<u4").tobytes()
                        found.append((name, row["block"], len(ids) // 4, place, ids))
                        size += len(ids)
                    place += count
                    if size > 2 * BLOCK_BYTES:
                        yield _rows(found, batch.schema.field("first_key").type)
                        found, size = [], 0
                if found:
                    yield _rows(found, batch.schema.field("first_key").type)

    names = ["keys", "frames", "offsets", "counts", "width", "dictionary_hash", "block", "first_key"]
    out = f"{key} {kind}, block long, n_tokens long, place long, ids binary"
    return blocks.select(*names).mapInArrow(decompress, out)


def _rows(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], ["key", "block", "n_tokens", "place", "ids"])


def block_starts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of all documents before each block; from the index alone."""
    blocks = spark.read.parquet(f"{folder}/blocks").select("block", "tokens")
    parts = store(part_starts(blocks, F.col("tokens"), row="block"), "token-parts").select("_part", "_start")
    before = Window.partitionBy("_part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("_part", part_of("block")).withColumn("_before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    return store(placed.join(parts, "_part").select("block", (F.col("_before") + F.col("_start")).alias("first")), "token-blocks")
