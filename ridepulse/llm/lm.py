"""Language-model scores by a weighted backoff automaton.

The model is a bigram model over add-0.1 word probabilities p: after a word v that was read c(v) times, w has the probability
(c(v, w) + K p(w)) / (c(v) + K). States are all words and the start of a text. An arc (v, w) of a bigram that was seen
carries that logarithm; every other word takes the state's failure arc, which weighs K / (c(v) + K), and goes on with
p(w). A word that was never read has a failure arc of weight one, so its state is as good as the empty one. Counts are
over all training texts; states and arcs grow with them, and no bigram is left out.

No task and no driver holds the model. Texts lie in chunks of bounded size. A chunk sends the 64-bit keys of its distinct
words and bigrams with their counts, sorted and cut into ranges of keys, one block per range; a task adds up the blocks of
one range and sends each chunk the totals of its own keys, in their order. With those the chunk has the part of the
automaton that its texts can reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

#: A chunk is closed at so many bytes of text; a longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: Tokens whose keys meet in a task; there are as many ranges as the corpus needs.
RANGE_TOKENS = 2 << 20
#: Weight of the word probabilities beside the counts of a state, and the count added to every word (fixed by the base score).
PRIOR, ADDED = 20.0, 0.1
#: Texts are traversed in segments of so many tokens, all segments of a chunk side by side.
SEGMENT = 512
#: States of a chunk: the start of a text, then its words by number. A pair is a state above so many bits and the next.
START, STATE_BITS = 0, 32


def word_id(word: bytes) -> int:
    """A word's 64-bit id; the end of a text is the empty word."""
    return xxhash.xxh64_intdigest(word)


#: The start of a text as a context; no word is a blank.
START_ID = word_id(b" ")


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads them."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _chunks(df: DataFrame, key: str, text: str, held_out: Column) -> DataFrame:
    """One row per chunk: keys, held-out marks and lengths of its texts, token numbers, and its words' ids."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, size = zstd.ZstdCompressor(level=3), 0
        local, keys, held, parts = {b"": 0}, [], [], []
        types = None

        def chunk() -> pa.RecordBatch:
            tokens, lengths = np.concatenate(parts), np.array([len(p) for p in parts])
            ids = np.fromiter(map(word_id, local), "<u8", len(local)).tobytes()
            n_train = int(lengths[~np.array(held)].sum())
            values = [keys, held, lengths.tolist(), packer.compress(tokens.astype("<i4").tobytes()), ids, len(tokens), n_train, len(keys) - sum(held)]
            names = ["keys", "held", "lengths", "tokens", "words", "n_all", "n_train", "d_train"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

        for batch in batches:
            own = batch.schema.field("_key").type
            types = [pa.list_(own), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(), *[pa.int64()] * 3]
            for name, mark, value in zip(batch.column("_key"), batch.column("_held"), batch.column("_text")):
                raw = (value.as_py() or "").encode().lower()
                number = local.setdefault
                found = [number(word, len(local)) for word in raw.split()]
                found.append(0)
                keys.append(name.as_py())
                held.append(mark.as_py())
                parts.append(np.array(found, np.int32))
                size += len(raw) + 16
                if size > CHUNK_BYTES:
                    yield chunk()
                    size, local, keys, held, parts = 0, {b"": 0}, [], [], []
        if keys:
            yield chunk()

    rows = df.select(F.col(key).alias("_key"), held_out.alias("_held"), F.col(text).cast("string").alias("_text"))
    fields = f"keys array<{kind}>, held array<boolean>, lengths array<long>, tokens binary, words binary, n_all long, n_train long, d_train long"
    return store(rows.mapInArrow(run, fields).withColumn("chunk", F.monotonically_increasing_id()), "lm-chunks")


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(zstd.ZstdDecompressor().decompress(row["tokens"]), "<i4"), np.array(row["lengths"], np.int64)


def _before(states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The state in which each token is read: that of the token before, or the start of a text."""
    before = np.empty(len(states), np.int64)
    before[1:] = states[:-1]
    before[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = START
    return before


class Keys:
    """The distinct words and bigrams of a chunk by their keys: words first, then pairs of a state and the next, rising."""

    def __init__(self, row: dict, tokens: np.ndarray, lengths: np.ndarray):
        read = tokens.astype(np.int64) + 1
        self.pairs, self.pair_of = np.unique(_before(read, lengths) << STATE_BITS | read, return_inverse=True)
        words = np.frombuffer(row["words"], "<u8")
        self.n_words = len(words)
        ids = np.concatenate([np.array([START_ID], np.uint64), words])
        state = _mixed(ids[self.pairs >> STATE_BITS])
        pairs = _mixed(state + ids[self.pairs & ((1 << STATE_BITS) - 1)])
        # the last bit tells words from bigrams
        one = np.uint64(1)
        self.keys = np.concatenate([_mixed(words) | one, pairs & ~one])
        self.order = np.argsort(self.keys, kind="stable")

    def cuts(self, bits: int) -> np.ndarray:
        """Where each of 2 ** bits ranges begins in the order of the keys, and the end."""
        bounds = np.array([k << (64 - bits) for k in range(1, 1 << bits)], np.uint64)
        return np.concatenate([[0], np.searchsorted(self.keys[self.order], bounds), [len(self.keys)]])


def _packed(values: np.ndarray) -> bytes:
    """Numbers as a byte for each that is small, 255 and eight bytes for the others behind them."""
    return np.minimum(values, 255).astype(np.uint8).tobytes() + values[values >= 255].astype("<i8").tobytes()


def _loose(raw: bytes, count: int) -> np.ndarray:
    values = np.frombuffer(raw, np.uint8, count).astype(np.int64)
    values[values == 255] = np.frombuffer(raw, "<i8", offset=count)
    return values


def _blocks(chunks: DataFrame, bits: int) -> DataFrame:
    """The sorted keys of every chunk and their training counts, a block per range of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                tokens, lengths = _unpack(row)
                own, train = Keys(row, tokens, lengths), np.repeat(~np.array(row["held"], bool), lengths)
                counts = np.concatenate([
                    np.bincount(tokens[train], minlength=own.n_words), np.bincount(own.pair_of[train], minlength=len(own.pairs)),
                ])[own.order]
                keys, cuts = own.keys[own.order], own.cuts(bits)
                used = [k for k in range(1 << bits) if cuts[k] < cuts[k + 1]]
                columns = [
                    pa.array(used, pa.int32()), pa.array([row["chunk"]] * len(used), pa.int64()),
                    pa.array([keys[cuts[k] : cuts[k + 1]].tobytes() for k in used], pa.binary()),
                    pa.array([_packed(counts[cuts[k] : cuts[k + 1]]) for k in used], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["range", "chunk", "keys", "counts"])

    return chunks.select("chunk", "tokens", "lengths", "held", "words").mapInArrow(run, "range int, chunk long, keys binary, counts binary")


def _totals(table: pa.Table) -> pa.Table:
    """The totals of a range's keys, for each chunk in the order of its block; the number of known words on a row of its own."""
    blocks = [np.frombuffer(raw.as_py(), "<u8") for raw in table.column("keys")]
    sizes = [len(b) for b in blocks]
    counts = np.concatenate([_loose(raw.as_py(), n) for raw, n in zip(table.column("counts"), sizes)])
    keys, which = np.unique(np.concatenate(blocks), return_inverse=True)
    totals = np.bincount(which, weights=counts, minlength=len(keys)).astype(np.int64)
    known = int(((totals > 0) & (keys & np.uint64(1) == 1)).sum())
    parts = np.split(totals[which], np.cumsum(sizes)[:-1])
    first = table.column("range")[0].as_py()
    columns = [
        pa.array([first] * (len(blocks) + 1), pa.int32()), pa.array([*table.column("chunk").to_pylist(), None], pa.int64()),
        pa.array([*[_packed(p) for p in parts], None], pa.binary()), pa.array([*sizes, None], pa.int32()), pa.array([0] * len(blocks) + [known], pa.int64()),
    ]
    return pa.table(columns, names=["range", "chunk", "totals", "size", "known"])


class Automaton:
    """Arcs and failure arcs of one chunk: ``read`` counts its states, ``pairs`` rise and have ``counts``."""

    def __init__(self, word_logs: np.ndarray, pairs: np.ndarray, counts: np.ndarray, read: np.ndarray):
        seen = counts > 0
        self.arcs, self.word_logs = pairs[seen], word_logs
        state = self.arcs >> STATE_BITS
        lower = 10.0 ** word_logs[(self.arcs & ((1 << STATE_BITS) - 1)) - 1]
        self.arc_logs = np.log10((counts[seen] + PRIOR * lower) / (read[state] + PRIOR))
        self.failure_logs = np.log10(PRIOR / (read + PRIOR))

    def traverse(self, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The log10-probability of each text, read left to right.

        Texts are cut into segments that start in the state the token before leads to, and all segments step together.
        """
        ends = np.cumsum(lengths)
        pieces = (lengths + SEGMENT - 1) // SEGMENT
        text = np.repeat(np.arange(len(lengths)), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = (ends - lengths)[text] + nth * SEGMENT
        size = np.minimum(ends[text] - first, SEGMENT)
        state = np.where(nth == 0, START, tokens[first - (nth > 0)].astype(np.int64) + 1)
        order = np.argsort(-size, kind="stable")
        first, size, state, text = first[order], size[order], state[order], text[order]
        active = np.searchsorted(-size, -np.arange(SEGMENT), "left")
        logs = np.zeros(len(text))
        for step in range(SEGMENT):
            n = int(active[step])
            if not n:
                break
            word = tokens[first[:n] + step]
            now, read = state[:n], word.astype(np.int64) + 1
            pair = now << STATE_BITS | read
            at = np.searchsorted(self.arcs, pair)
            hit = np.zeros(n, bool) if not len(self.arcs) else (self.arcs[np.minimum(at, len(self.arcs) - 1)] == pair)
            fallen = self.failure_logs[now] + self.word_logs[word]
            if hit.any():
                fallen[hit] = self.arc_logs[at[hit]]
            logs[:n] += fallen
            state[:n] = read
        return np.bincount(text, weights=logs, minlength=len(lengths))


def score(df: DataFrame, key: str, text: str, held_out: Column) -> DataFrame:
    """Per row: ``key``, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Learns from all rows for which ``held_out`` is not true. Null texts count as empty and are one token, the end.
    Words and bigrams are told apart by 64-bit keys. Repeated rows count as often as they occur. Without training rows
    every word is unknown and each score is its base score. An empty table gives no rows.
    """
    chunks = _chunks(df, key, text, F.coalesce(held_out, F.lit(False)))
    sums = chunks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_train", "d_train", "n_all")]).first()
    total, texts, tokens = sums
    bits = max(0, (tokens // RANGE_TOKENS).bit_length())
    fields = "range int, chunk long, totals binary, size int, known long"
    totals = store(_blocks(chunks, bits).groupBy("range").applyInArrow(_totals, fields), "lm-totals")
    vocabulary = totals.agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]
    floor = total + ADDED * (vocabulary + 1)
    kind = chunks.schema["keys"].dataType.elementType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        tokens, lengths = _unpack(row)
        own = Keys(row, tokens, lengths)
        blocks = sorted(zip(*(right.column(c).to_pylist() for c in ("range", "totals", "size"))))
        counts = np.empty(len(own.keys), np.int64)
        counts[own.order] = np.concatenate([_loose(raw, size) for _, raw, size in blocks])
        words, pairs = counts[: own.n_words], counts[own.n_words :]
        # the end is never a context, but no pair says so either
        automaton = Automaton(np.log10((words + ADDED) / floor), own.pairs, pairs, np.append(texts, words).astype(float))
        text_of = np.repeat(np.arange(len(lengths)), lengths)
        base = np.bincount(text_of, weights=automaton.word_logs[tokens], minlength=len(lengths))
        known = np.bincount(text_of, weights=words[tokens] > 0, minlength=len(lengths)).astype(np.int64)
        columns = [
            pa.array(row["keys"], left.schema.field("keys").type.value_type), pa.array(row["held"], pa.bool_()), pa.array(lengths), pa.array(known),
            pa.array(np.full(len(lengths), total, np.int64)), pa.array(base), pa.array(automaton.traverse(tokens, lengths)),
        ]
        return pa.table(columns, names=[key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    back = totals.filter("chunk is not null").select(F.col("chunk").alias("of_chunk"), "range", "totals", "size")
    fields = f"{key} {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    texts_of = chunks.select("chunk", "keys", "held", "lengths", "tokens", "words")
    return texts_of.groupBy("chunk").cogroup(back.groupBy("of_chunk")).applyInArrow(run, fields)
