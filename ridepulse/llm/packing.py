"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of its documents' tokens. A window of the target length is filled by serving the queues in
turn, each with its share of the window; what a share lacks to a whole token is the queue's deficit and is carried
into the next window. A queue's served tokens after window w are its fluid share rounded to whole tokens, so the
state at any window follows from the totals alone: a partition starts with the deficits its predecessor would hand on
and no partition waits for another. A queue that runs empty leaves its share to the others.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, part_of, part_starts, store, store_rows
from .tokens import encoded

#: Window counts are worked out in tables of so many numbers, of which the last few are kept.
TABLE_CELLS, TABLES = 1 << 18, 16
#: Output rows are handed on in batches of about so many bytes.
BATCH_BYTES = 4 << 20


#: Columns of a piece beside those that are kept.
OUTPUT = ("start", "length", "doc_tokens", "sequence_id", "offset", "ids")


class Mixture:
    """How many tokens of each queue the first w windows hold, for any w."""

    def __init__(self, totals: Sequence[int], shares: Sequence[float], length: int):
        self.length, self.totals = length, np.array(totals, np.int64)
        self.shares = np.array(shares, float)
        self.all = int(self.totals.sum())
        self.end = float(np.max((self.totals + 2) / self.shares)) if len(totals) else 0.0
        self.block = max(1, TABLE_CELLS // max(1, len(totals)))
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _served(self, time: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(time[:, None] * self.shares + 0.5), 0, self.totals).astype(np.int64)

    def served(self, windows: np.ndarray) -> np.ndarray:
        """Tokens of each queue in the windows before each given one; a row per window.

        The time at which the queues together have served that many is found by bisection down to neighbouring
        doubles. Queues that step at the very same time step in their order.
        """
        want = np.minimum(windows.astype(np.int64) * self.length, self.all)
        low, high = np.full(len(want), -1.0), np.full(len(want), self.end)
        while True:
            mid = low + (high - low) / 2
            open_ = (mid > low) & (mid < high)
            if not open_.any():
                break
            enough = self._served(mid).sum(1) >= want
            high, low = np.where(open_ & enough, mid, high), np.where(open_ & ~enough, mid, low)
        below, above = self._served(low), self._served(high)
        below[want == 0] = above[want == 0] = 0
        step = above - below
        earlier = np.cumsum(step, 1) - step
        return below + np.clip((want - below.sum(1))[:, None] - earlier, 0, step)

    def around(self, queue: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last window that tokens start..end of the queues can be in, one window of slack included."""
        slack, share = len(self.totals) + 2, self.shares[queue]
        first = self._served((start + 0.5) / share).sum(1) - slack
        last = self._served((end - 0.5) / share).sum(1) + slack
        return np.maximum(first // self.length, 0), np.minimum(last, self.all) // self.length


    def table(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """``served`` for the windows of one block and the one after, and where in a window each queue begins."""
        if block not in self.tables:
            while len(self.tables) >= TABLES:
                self.tables.pop(next(iter(self.tables)))
            served = self.served(np.arange(block * self.block, (block + 1) * self.block + 1))
            own = np.diff(served, axis=0)
            self.tables[block] = served, np.cumsum(own, 1) - own
        return self.tables[block]

    def cut(self, queue: int, start: int, end: int, first: int, last: int) -> list[np.ndarray]:
        """Pieces of tokens start..end of a queue, in order: from, to, window and offset in it."""
        parts = []
        for block in range(first // self.block, last // self.block + 1):
            served, before = self.table(block)
            edge = served[:, queue]
            lo, hi = np.searchsorted(edge, start, "right") - 1, np.searchsorted(edge, end, "left")
            k = np.arange(max(0, lo), min(hi, self.block))
            a, b = np.maximum(edge[k], start), np.minimum(edge[k + 1], end)
            kept = a < b
            k, a, b = k[kept], a[kept], b[kept]
            parts.append((a, b, block * self.block + k, before[k, queue] + a - edge[k]))
        return [np.concatenate(x) for x in zip(*parts)]


def _queue_names(df: DataFrame, queue: str) -> list:
    """All sources; each has a queue of its own."""
    found = df.select(F.col(queue).cast("string").alias("q")).distinct()
    return sorted((row.q for row in found.collect()), key=lambda q: (q is not None, q))


def pack(
    df: DataFrame,
    text: str,
    queue: str,
    keep: Sequence[str],
    path: str,
    length: int = 2048,
    end_id: int = 1,
    targets: Mapping[str, float] | None = None,
    rest: float | None = None,
) -> DataFrame:
    """Pack the tokens of all rows into sequences of ``length``; one output row per piece of a document.

    A document is the ids of its whole text (null: none) and then ``end_id``, so an empty one is a piece of one token.
    ``targets`` are the wanted token shares per source, and ``rest`` the share that all sources not named there have
    together, dealt by their tokens; a source without a share is an error. By default shares are those of the tokens. Every source is a queue, however many there are; a window costs time in proportion to them. Shares hold in every window to less than a token per queue until a queue is empty. Null is a source like any
    other. Rows with equal contents are packed each. Only the last sequence may be short. An empty table gives no rows.

    Output: the ``keep`` columns, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit);
    kept columns with these names are replaced.
    """
    keep = [c for c in keep if c.lower() not in OUTPUT]
    lane_of = {name: i for i, name in enumerate(_queue_names(df, queue))}
    end = np.array([end_id], "<u4").tobytes()
    taken = [*keep, text]
    lane, ids, n, before, row = (fresh(taken, c) for c in ("_lane", "_ids", "_n", "_before", "_row"))
    kept = df.select(*keep).schema
    rows = df.select(*keep, F.col(queue).cast("string").alias(lane), F.col(text).cast("string").alias(ids))

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        served = [0] * len(lane_of)
        for batch in batches:
            lanes = [lane_of[value] for value in batch.column(lane).to_pylist()]
            out, size, at = [], 0, 0
            for found in encoded(path, batch.column(ids)):
                out.append(found + end)
                size += len(out[-1])
                if size > BATCH_BYTES or at + len(out) == len(lanes):
                    part, own = batch.slice(at, len(out)), lanes[at : at + len(out)]
                    counts, starts = [len(x) // 4 for x in out], []
                    for q, tokens in zip(own, counts):
                        starts.append(served[q])
                        served[q] += tokens
                    more = [pa.array(own, pa.int32()), pa.array(out, pa.binary()), pa.array(counts, pa.int64()), pa.array(starts, pa.int64())]
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *more], [*keep, lane, ids, n, before])
                    out, size, at = [], 0, at + len(out)

    schema = T.StructType([*kept, *T.StructType.fromDDL(f"{lane} int, {ids} binary, {n} long, {before} long")])
    tokens = store_rows(rows.mapInArrow(tokenize, schema), "pack-tokens", row)
    starts = store(part_starts(tokens, F.col(n), [lane], row), "pack-starts").withColumnRenamed(lane, "_queue")
    totals = {r[0]: r[1] for r in starts.groupBy("_queue").agg(F.sum("_in")).collect()}
    lanes = sorted(totals)
    if targets is None:
        shares = [totals[q] for q in lanes]
    else:
        weight = {lane_of[name]: share for name, share in targets.items() if name in lane_of}
        others = [q for q in lanes if q not in weight]
        if others and not rest or any(share <= 0 for share in weight.values()):
            raise ValueError("every source needs a share above zero; `rest` is the share of those not named")
        shares = [weight[q] if q in weight else rest * totals[q] / sum(totals[o] for o in others) for q in lanes]
    shares = [x / sum(shares) for x in shares]
    place = {q: i for i, q in enumerate(lanes)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = Mixture([totals[q] for q in lanes], shares, length)
        for batch in batches:
            queues = np.array([place[q] for q in batch.column(lane).to_pylist()], np.int64)
            froms, counts = np.asarray(batch.column(before), np.int64), np.asarray(batch.column(n), np.int64)
            found, size, done = [], 0, 0
            for low in range(0, len(queues), mixture.block):
                part = slice(low, low + mixture.block)
                first, last = mixture.around(queues[part], froms[part], froms[part] + counts[part])
                for i, (w, z) in enumerate(zip(first.tolist(), last.tolist()), low):
                    start = int(froms[i])
                    a, b, window, offset = mixture.cut(int(queues[i]), start, start + int(counts[i]), w, z)
                    found.append((np.full(len(a), i), a - start, b - a, np.full(len(a), counts[i]), window, offset))
                    size += 4 * int(counts[i])
                    if size > BATCH_BYTES or i + 1 == len(queues):
                        yield _batch(batch, len(keep), batch.column(ids).slice(done, i + 1 - done), found)
                        found, size, done = [], 0, i + 1

    pieces = T.StructType.fromDDL("start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
    placed = tokens.withColumn("_part", part_of(row)).join(starts, (F.col(lane) == F.col("_queue")) & (part_of(row) == starts["_part"]))
    cuts = placed.select(*keep, lane, ids, n, (F.col(before) + F.col("_start")).alias(before))
    return cuts.mapInArrow(cut, T.StructType([*kept, *pieces]))


def _batch(batch: pa.RecordBatch, kept: int, ids: pa.Array, found: list[tuple]) -> pa.RecordBatch:
    """Output rows of some documents: their pieces in order are their ids in order, so the bytes stay where they are."""
    rows, *numbers = (np.concatenate(x) for x in zip(*found))
    columns = [batch.column(k).take(pa.array(rows)) for k in range(kept)] + [pa.array(x, pa.int64()) for x in numbers]
    _, bounds, data = ids.buffers()
    base = np.frombuffer(bounds, np.int32)[ids.offset]
    cuts = base + 4 * np.concatenate([[0], np.cumsum(numbers[1])])
    pieces = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), data])
    names = ["start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.RecordBatch.from_arrays([*columns, pieces], [*batch.schema.names[:kept], *names])


def sequences(pieces: DataFrame) -> DataFrame:
    """The ids of every sequence in order; a group is at most one window of tokens."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda done, piece: F.concat(done, piece["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))
