"""Alignment of two tokenizers over the bytes of the same texts.

A byte-level tokenizer A and a sentencepiece tokenizer B cut a space and the text into tokens. Per batch of documents
``merge_asof``, keyed by document, finds for each token start the token of the other side that covers it; the union of
both directions is every pair of overlapping tokens, and starts that fall together (the ends of the tokens before) cut
the tokens into groups.

Counts over the corpus come back to the documents by chunks: a chunk hands on each of its distinct id pairs once, so a
frequent pair has a row per chunk and not per occurrence, and gets one row back. Documents keep their pairs as numbers
in their chunk's list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .tokens import SLICE, Encoder, slices
from .words import WordCache, byte_of_character, byte_words, groups, word_lists

#: A chunk ends at so many bytes of text; a longer text is cut into parts of about a slice.
CHUNK = 1 << 21
#: How sentencepiece writes a space (fixed value).
PIECE_SPACE = "▁"


class Side:
    """A tokenizer, and the bytes of its tokens."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.digits = [np.array([f"{i}{end}" for i in range(len(tokens))], object) for end in (",", "|", ";")]

    def altered(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> set[str]:
        """The words that the tokens' bytes do not give back."""
        raws, tokens, ends = [w.encode() for w in words], self.tokens, np.cumsum(counts)
        sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        before = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        pieces = [tokens[i] for i in ids.tolist()]
        if (before[ends] - before[ends - counts] == sizes).all() and b"".join(pieces) == b"".join(raws):
            return set()
        return {w for w, raw, s, e in zip(words, raws, (ends - counts).tolist(), ends.tolist()) if b"".join(pieces[s:e]) != raw}


class ByteSide(Side):
    def __init__(self, path: str):
        self.encoder = Encoder(path)
        # strings of special tokens in a text are text
        self.encoder.tokenizer.encode_special_tokens = True
        if not self.encoder.by_word:
            raise ValueError("the first tokenizer is to be a byte-level one without a prefix space")
        byte, vocabulary = byte_of_character(), self.encoder.tokenizer.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = bytes(byte.get(c, 63) for c in token)
        super().__init__(tokens)


class PieceSide(Side):
    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(PIECE_SPACE in piece.lstrip(PIECE_SPACE) for piece in pieces):
            raise ValueError("the vocabulary does not keep words apart")
        raw = [p.replace(PIECE_SPACE, " ").encode() for p in pieces]
        super().__init__([bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else raw[i] for i, p in enumerate(pieces)])
        self.space = self.model.piece_to_id(PIECE_SPACE)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # the model adds the space that each word starts with, but not to an empty text
        found = self.model.encode([w[1:] for w in words], num_threads=1)
        found = [ids if w != " " else [self.space] for w, ids in zip(words, found)]
        return np.fromiter(chain.from_iterable(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found))


class Sides:
    """Both tokenizers, the words seen lately (each with the space before it), and those that one of them alters."""

    def __init__(self, byte_path: str, piece_path: str):
        self.both = ByteSide(byte_path), PieceSide(piece_path)
        self.cache, self.altered = WordCache(self._learn, 2), set()

    def _learn(self, words: list[str]) -> tuple[list[str], list[tuple[np.ndarray, np.ndarray]]]:
        order, *first = byte_words(self.both[0].encoder, words)
        found = [tuple(first), self.both[1].words(order)]
        for side, (ids, counts) in zip(self.both, found):
            self.altered |= side.altered(order, ids, counts)
        return order, found

    def trim(self) -> None:
        self.cache.trim()
        if not self.cache.where:
            self.altered.clear()


_SIDES: dict[tuple[str, str], Sides] = {}


def sides(byte_path: str, piece_path: str) -> Sides:
    """One pair of tokenizers per Python worker."""
    if (byte_path, piece_path) not in _SIDES:
        _SIDES[byte_path, piece_path] = Sides(byte_path, piece_path)
    return _SIDES[byte_path, piece_path]


class Aligned:
    """What a batch of texts gives: counts per text, the string of its groups, its pairs by number, and the pairs."""

    def __init__(self, texts: pa.Array, pair: Sides, led: bool = False):
        """``led``: the texts already start with the space that comes before them."""
        texts = pa.array([(t.as_py() or " ")[1:] for t in texts], pa.string()) if led else texts
        words, codes, at = word_lists(texts)
        spaced = [" " + w for w in words]
        index, both = pair.cache.look(spaced), pair.both
        changed = np.zeros(len(spaced), bool)
        if pair.altered:
            changed[:] = [w in pair.altered for w in spaced]
        wrong = np.concatenate([[0], np.cumsum(changed[codes])])
        self.whole = wrong[at[1:]] == wrong[at[:-1]]
        # a text without a character is one empty word
        filled = np.array([w != "" for w in words], bool)[codes[at[:-1]]] | (np.diff(at) > 1) | led
        fine, size = self.whole & filled, len(filled)
        index = index[codes[np.repeat(fine, np.diff(at))]]
        at = np.concatenate([[0], np.cumsum(np.where(fine, np.diff(at), 0))])
        frames, ids, starts = [], [], []
        for k, (side, name) in enumerate(zip(both, "ab")):
            own, word_at = pair.cache.gather(index, k)
            ends = np.cumsum(side.lengths[own])
            ids.append(own.astype(np.int64))
            starts.append(ends - side.lengths[own])
            document = np.repeat(np.arange(size), np.diff(word_at[at]))
            frames.append(pd.DataFrame({"document": document, "start": starts[-1], name: np.arange(len(own))}))
        pair.trim()
        a, b = frames
        self.n_a, self.n_b = (np.bincount(f["document"], minlength=size) for f in frames)
        covering_b = pd.merge_asof(a, b, on="start", by="document")["b"].to_numpy(np.int64)
        covering_a = pd.merge_asof(b, a, on="start", by="document")["a"].to_numpy(np.int64)
        first_a, first_b = starts[1][covering_b] == starts[0], starts[0][covering_a] == starts[1]
        # a start of both sides is found from both: the union has it once
        link_a, link_b = np.concatenate([a["a"], covering_a[~first_b]]), np.concatenate([covering_b, b["b"][~first_b]])
        document = np.concatenate([a["document"], b["document"][~first_b]])
        self.n_links, self.n_groups = np.bincount(document, minlength=size), np.bincount(b["document"][first_b], minlength=size)
        number, self.pairs = pd.factorize(ids[0][link_a] << 32 | ids[1][link_b])
        self.counts = np.bincount(number, minlength=len(self.pairs))
        # the frequent pairs get small numbers
        order = np.argsort(-self.counts, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.pairs, self.counts = self.pairs[order], self.counts[order]
        self._keep(document, rank[number], size)
        self.strings = self._strings(ids, np.cumsum(first_a) - 1, np.cumsum(first_b) - 1, both)

    def _keep(self, document: np.ndarray, number: np.ndarray, size: int) -> None:
        """The distinct pairs of each text: gaps between their numbers, and how often each occurs."""
        span = max(len(self.pairs), 1)
        key, times = np.unique(document * span + number, return_counts=True)
        own, number = key // span, key % span
        gap = np.diff(number, prepend=0)
        gap[np.flatnonzero(np.diff(own, prepend=-1))] = number[np.flatnonzero(np.diff(own, prepend=-1))]
        self.gaps, self.times = gap.astype("<u4"), times.astype("<u4")
        self.pair_at = np.searchsorted(own, np.arange(size + 1))

    def _strings(self, ids: list[np.ndarray], group_a: np.ndarray, group_b: np.ndarray, both: tuple[Side, Side]) -> list[str]:
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        base = np.concatenate([[0], np.cumsum(in_a + in_b)])
        out = np.empty(base[-1], object)
        for group, own, before, inside, side, end in ((group_a, ids[0], 0, in_a, both[0], 1), (group_b, ids[1], in_a, in_b, both[1], 2)):
            place = np.arange(len(own)) - (np.cumsum(inside) - inside)[group]
            last = place == inside[group] - 1
            out[base[:-1][group] + (before[group] if end == 2 else 0) + place] = np.where(last, side.digits[end][own], side.digits[0][own])
        ends = np.cumsum(self.n_a + self.n_b)
        parts = out.tolist()
        return ["".join(parts[s:e])[:-1] for s, e in zip((ends - self.n_a - self.n_b).tolist(), ends.tolist())]


def _narrow(values: np.ndarray) -> bytes:
    """Numbers as a byte for each that is small, 255 and four bytes for the others behind them."""
    small = np.minimum(values, 255).astype(np.uint8)
    return small.tobytes() + values[values >= 255].astype("<u4").tobytes()


def _widen(raw: bytes, count: int) -> np.ndarray:
    values = np.frombuffer(raw, np.uint8, count).astype(np.int64)
    values[values == 255] = np.frombuffer(raw, "<u4", offset=count)
    return values


ROWS = "_row long, _key {key}, chunk long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs int, gaps binary, times binary, pairs array<long>, counts array<long>"
NAMES = [f.strip().split()[0] for f in ROWS.split(", ")]
TYPES = [*[pa.int64()] * 5, pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def _empty(row: tuple, chunk: int) -> tuple:
    return (*row, chunk, 0, 0, 0, 0, "", 0, b"", b"", None, None)


def _parts(batch: Aligned, rows: list[tuple], chunk: int) -> Iterator[tuple]:
    for k, row in enumerate(rows):
        own = slice(int(batch.pair_at[k]), int(batch.pair_at[k + 1]))
        sizes = (int(x[k]) for x in (batch.n_a, batch.n_b, batch.n_groups, batch.n_links))
        digest = hashlib.sha256(batch.strings[k].encode()).hexdigest() if batch.n_a[k] else ""
        yield (*row, chunk, *sizes, digest, own.stop - own.start, _narrow(batch.gaps[own]), _narrow(batch.times[own]), None, None)


def _listed(batch: Aligned, chunk: int) -> tuple:
    return (None, None, chunk, None, None, None, None, None, None, None, None, batch.pairs.tolist(), batch.counts.tolist())


def _long(row: tuple, text: str, both: Sides, chunks: Iterator[int]) -> Iterator[list[tuple]]:
    """The rows of a text that is longer than a slice, part by part; all its parts are looked at before any is kept."""

    def batches() -> Iterator[Aligned]:
        for k, piece in enumerate(slices(text)):
            yield Aligned(pa.array([piece if k else " " + piece]), both, led=True)

    digest = hashlib.sha256()
    if not all(batch.whole[0] for batch in batches()):
        yield [_empty(row, next(chunks))]
        return
    waiting = None
    for batch in batches():
        digest.update((";" if waiting else "").encode() + batch.strings[0].encode())
        if waiting:
            yield waiting
        chunk = next(chunks)
        part = list(next(_parts(batch, [row], chunk)))
        part[7] = ""
        waiting = [part, _listed(batch, chunk)]
    waiting[0][7] = digest.hexdigest()
    yield waiting


def _aligned(df: DataFrame, key: str, text: str, byte_path: str, piece_path: str) -> DataFrame:
    """A row per document, or part of a long one, and a row per chunk with its distinct pairs and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, part = sides(byte_path, piece_path), TaskContext.get().partitionId() << 32
        chunks, row = iter(range(part, part + (1 << 32))), part

        for batch in batches:
            kind = batch.schema.field("_key").type

            def out(found: list) -> pa.RecordBatch:
                types = [pa.int64(), kind, *TYPES]  # noqa: B023 - used before the next batch
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], NAMES)

            texts, names = batch.column("_text").cast(pa.string()), batch.column("_key").to_pylist()
            for first, end in groups(texts, CHUNK):
                rows = [(row + i, names[i]) for i in range(first, end)]
                if end - first == 1 and len(text := texts[first].as_py() or "") > SLICE:
                    for found in _long(rows[0], text, both, chunks):
                        yield out(found)
                    continue
                aligned, chunk = Aligned(texts.slice(first, end - first), both), next(chunks)
                yield out([*_parts(aligned, rows, chunk), _listed(aligned, chunk)])
            row += batch.num_rows

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")).mapInArrow(run, ROWS.format(key=kind))


def _weighed(left: pa.Table, right: pa.Table) -> pa.Table:
    """The sums of one chunk's documents, given the corpus counts of its pairs by their number."""
    order = np.argsort(right.column("number").to_numpy())
    count, best = (right.column(c).to_numpy()[order].astype(np.int64) for c in ("count", "best"))
    sums, bests = [], []
    for n, gaps, times in zip(*(left.column(c).to_pylist() for c in ("n_pairs", "gaps", "times"))):
        number, often = np.cumsum(_widen(gaps, n)), _widen(times, n)
        sums.append(int((count[number] * often).sum()))
        bests.append(int((best[number] * often).sum()))
    kept = left.select(["_row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    return kept.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))


def align(df: DataFrame, key: str, text: str, byte_path: str, piece_path: str) -> DataFrame:
    """Per row: ``key``, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``n_best`` counts the links whose id pair is the most frequent one of its B id over all documents, ties included;
    ``count_sum`` adds up the corpus counts of the pairs of all links. Texts that are null or empty, or that either
    tokenizer does not give back byte by byte, have zeros and an empty string, and count nowhere. Null and repeated
    keys keep their rows, equal texts count once for each row; other columns are not looked at. An empty table gives
    no rows. A text of any length is worked on a slice at a time.
    """
    found = store(_aligned(df, key, text, byte_path, piece_path), "aligned")
    lists = found.filter("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("number", "p"))
    lists = lists.select("chunk", "number", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    counts = lists.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = store(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))), "pair-counts")
    most = store(counts.groupBy("b").agg(F.max("count").alias("most")), "best-counts")
    counts = counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    back = lists.select("chunk", "number", "pair").join(counts, "pair").select("chunk", "number", "count", "best")
    documents = found.filter("_row is not null").drop("_key", "pairs", "counts").withColumnRenamed("chunk", "own_chunk")
    out = "_row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    with_pairs = documents.filter("n_pairs > 0").groupBy("own_chunk").cogroup(back.groupBy("chunk")).applyInArrow(_weighed, out)
    without = documents.filter("n_pairs = 0").select(
        "_row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum")
    )
    parts = with_pairs.unionByName(without)
    numbers = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    whole = parts.groupBy("_row").agg(*numbers, F.max("groups_sha256").alias("groups_sha256"))
    # a part after the first of a long text has the same row and key
    keys = found.filter("_row is not null").groupBy("_row").agg(F.first("_key").alias("_key"))
    return keys.join(whole, "_row").drop("_row").withColumnRenamed("_key", key)
