"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained here in numpy.

A word's input is its own embedding, if it is frequent in the training texts, beside the mean embedding of its
character pairs, which every word has. Texts are read in overlapping windows; the states of both directions are pooled
by attention and give the window's probability. A text scores as its worst window. A training text's label belongs
to some window of it, so the network learns from the windows that it finds worst, text by text.

The network is fitted on a bounded sample of rows. Their whole texts stay in the tasks, which count words, rank windows
and hand on the few that a round learns from; scoring runs over all windows of all texts inside the tasks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import drawn, fresh, store_rows

#: At most so many labelled rows of each class, those with the smallest key hash; their texts are read whole.
SAMPLE_ROWS = 1000
#: Words of a window, and between the starts of neighbours.
WINDOW, STRIDE = 64, 48
WORDS = re.compile(r"[^\W\d_]+")
#: Frequent words and hashed character pairs that have an embedding.
VOCABULARY, PAIRS = 20_000, 4096
WORD_SIZE, PAIR_SIZE, HIDDEN = 8, 8, 8
INPUT = WORD_SIZE + PAIR_SIZE
#: Steps of a round, windows of a step, and how many of those are toxic.
ROUNDS, STEPS, BATCH, TOXIC_SHARE, RATE, DECAY = 3, 100, 128, 16, 0.01, 0.1
#: A word needs so many training texts for an embedding, which starts at so many times its log odds.
SEEN, ODDS = 4, 1.5
#: Windows of a clean text used in a round: the worst and some others.
CLEAN_WINDOWS = 3
THRESHOLD = 0.7
#: Texts are scored together up to so many characters and windows.
SLICE, WINDOWS = 2 << 20, 8192


def split_words(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def windows_of(n: int) -> list[tuple[int, int]]:
    """Start and length of the overlapping windows over n words; no words are one empty window."""
    starts = range(0, max(n - (WINDOW - STRIDE), 1), STRIDE)
    return [(s, min(WINDOW, n - s)) for s in starts]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _sum_by(numbers: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The sum of the rows of each number below n."""
    out = np.zeros((n, rows.shape[1]), np.float32)
    order = np.argsort(numbers, kind="stable")
    first = np.flatnonzero(np.diff(numbers[order], prepend=-1))
    if len(first):
        out[numbers[order][first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def pair_numbers(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character pairs of all words, word ends included, and where each word's begin."""
    raw = np.frombuffer((" " + " ".join(words) + " ").encode(), np.uint8).astype(np.int64)
    pairs = (raw[:-1] * 151 + raw[1:]) % PAIRS
    # a word's pairs start at the space before it; words hold no spaces
    return pairs, np.flatnonzero(raw[:-1] == 32)


@dataclass
class Network:
    vocabulary: dict[str, int]
    weights: dict[str, np.ndarray]

    def inputs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Input vector of each distinct word, with what training needs to send gradients back."""
        known = np.array([self.vocabulary.get(w, len(self.vocabulary)) for w in words], np.int64)
        if not words:
            return np.zeros((0, INPUT), np.float32), known, np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, starts = pair_numbers(words)
        sums = np.add.reduceat(self.weights["pairs"][pairs], starts, axis=0)
        sizes = np.diff(np.append(starts, len(pairs)))
        return np.hstack([self.weights["words"][known], np.tanh(sums / sizes[:, None])]), known, pairs, starts

    def run(self, table: np.ndarray, ids: np.ndarray, sizes: np.ndarray, keep: bool = False) -> dict:
        """Windows (rows of ids, longest first) through the network; ``keep`` holds what training needs."""
        w, n, steps = self.weights, len(ids), int(sizes[0]) if len(sizes) else 0
        active = np.searchsorted(-sizes, -np.arange(steps), "left")
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        saved = {}
        for d, (name, order) in enumerate((("f", range(steps)), ("b", range(steps - 1, -1, -1)))):
            projected = table @ w["W" + name] + w["c" + name]
            gates, new = w["U" + name][:, : 2 * HIDDEN], w["U" + name][:, 2 * HIDDEN :]
            h = np.zeros((n, HIDDEN), np.float32)
            for t in order:
                k = int(active[t])
                now, x = h[:k], projected[ids[:k, t]]
                zr = _sigmoid(x[:, : 2 * HIDDEN] + now @ gates)
                inner = now @ new
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                candidate = np.tanh(x[:, 2 * HIDDEN :] + r * inner)
                if keep:
                    saved[name, t] = (now.copy(), zr, inner, candidate)
                h[:k] = candidate + z * (now - candidate)
                states[t, :k, d * HIDDEN : (d + 1) * HIDDEN] = h[:k]
        attention = states @ w["v"]
        attention[np.arange(steps)[:, None] >= sizes[None, :]] = -np.inf
        if steps:
            attention = np.exp(attention - np.maximum(attention.max(0), -1e30))
            attention /= np.maximum(attention.sum(0), 1e-30)
        pooled = np.einsum("tn,tnh->nh", attention, states) if steps else np.zeros((n, 2 * HIDDEN), np.float32)
        logits = pooled @ w["o"] + w["b"][0]
        return {"logits": logits, "states": states, "attention": attention, "pooled": pooled, "saved": saved, "active": active}

    def probabilities(self, texts: list[list[str]]) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """The probability of every window, and its text, start and length."""
        local: dict[str, int] = {}
        numbers = [np.array([local.setdefault(w, len(local)) for w in words], np.int64) for words in texts]
        table = self.inputs(list(local))[0]
        spans = [(i, s, n) for i, words in enumerate(texts) for s, n in windows_of(len(words))]
        out = np.zeros(len(spans), np.float32)
        order = sorted(range(len(spans)), key=lambda k: -spans[k][2])
        for at in range(0, len(order), WINDOWS):
            part = order[at : at + WINDOWS]
            sizes = np.array([spans[k][2] for k in part])
            ids = np.zeros((len(part), max(int(sizes[0]), 1)), np.int64)
            for row, k in enumerate(part):
                i, s, n = spans[k]
                ids[row, :n] = numbers[i][s : s + n]
            out[part] = _sigmoid(self.run(table, ids, sizes)["logits"])
        return out, spans

    def score(self, texts: list[list[str]]) -> np.ndarray:
        """The worst window of each text."""
        found, spans = self.probabilities(texts)
        worst = np.zeros(len(texts), np.float32)
        np.maximum.at(worst, [s[0] for s in spans], found)
        return worst

    def gradients(self, windows: list[list[str]], labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss over some windows, longest first."""
        w = self.weights
        local: dict[str, int] = {}
        sizes = np.array([len(x) for x in windows])
        ids = np.zeros((len(windows), max(int(sizes[0]), 1)), np.int64)
        for row, words in enumerate(windows):
            ids[row, : len(words)] = [local.setdefault(x, len(local)) for x in words]
        names = list(local)
        table, known, pairs, starts = self.inputs(names)
        out = self.run(table, ids, sizes, keep=True)
        states, attention, active = out["states"], out["attention"], out["active"]
        grad = {name: np.zeros_like(value) for name, value in w.items()}
        d_logit = ((_sigmoid(out["logits"]) - labels) / len(windows)).astype(np.float32)
        grad["o"], grad["b"][0] = out["pooled"].T @ d_logit, d_logit.sum()
        d_pooled = d_logit[:, None] * w["o"][None, :]
        d_states = attention[:, :, None] * d_pooled[None]
        d_attention = np.einsum("nh,tnh->tn", d_pooled, states)
        d_score = attention * (d_attention - (attention * d_attention).sum(0))
        grad["v"] = np.einsum("tn,tnh->h", d_score, states)
        d_states += d_score[:, :, None] * w["v"]
        d_table = np.zeros_like(table)
        for d, (name, order) in enumerate((("f", range(len(states) - 1, -1, -1)), ("b", range(len(states))))):
            u, dh = w["U" + name], np.zeros((len(windows), HIDDEN), np.float32)
            d_input = np.zeros((len(states), len(windows), 3 * HIDDEN), np.float32)
            for t in order:
                k = int(active[t])
                before, zr, inner, candidate = out["saved"][name, t]
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                now = dh[:k] + d_states[t, :k, d * HIDDEN : (d + 1) * HIDDEN]
                d_candidate = now * (1 - z) * (1 - candidate**2)
                d_z = now * (before - candidate) * z * (1 - z)
                d_r = d_candidate * inner * r * (1 - r)
                d_input[t, :k] = np.hstack([d_z, d_r, d_candidate])
                d_out = np.hstack([d_z, d_r, d_candidate * r])
                grad["U" + name] += before.T @ d_out
                dh[:k] = now * z + d_out @ u.T
            d_projected = _sum_by(ids.T.ravel(), d_input.reshape(-1, 3 * HIDDEN), len(table))
            grad["W" + name] = table.T @ d_projected
            grad["c" + name] = d_projected.sum(0)
            d_table += d_projected @ w["W" + name].T
        np.add.at(grad["words"], known, d_table[:, :WORD_SIZE])
        grad["words"][-1] = 0
        if len(names):
            part = table[:, WORD_SIZE:]
            sizes_of = np.diff(np.append(starts, len(pairs)))
            d_sum = d_table[:, WORD_SIZE:] * (1 - part**2) / sizes_of[:, None]
            grad["pairs"] = _sum_by(pairs, np.repeat(d_sum, sizes_of, axis=0), PAIRS)
        return grad


def _new_network(texts: list[list[str]], labels: np.ndarray, seed: int) -> Network:
    """A network for the words of these texts."""
    seen, toxic = Counter(), Counter()
    for words, label in zip(texts, labels):
        seen.update(set(words))
        if label:
            toxic.update(set(words))
    return _network_of(seen, toxic, labels, seed)


def _network_of(seen: Mapping[str, int], toxic: Mapping[str, int], labels: np.ndarray, seed: int) -> Network:
    """Small random weights; the first number of a word's embedding starts as its log odds in the training texts."""
    draw = np.random.default_rng(seed)
    frequent = sorted((w for w in seen if seen[w] >= SEEN), key=lambda w: (-seen[w], w))[:VOCABULARY]
    vocabulary = {w: i for i, w in enumerate(frequent)}

    def random(*shape: int) -> np.ndarray:
        return (draw.standard_normal(shape) * 0.2).astype(np.float32)

    weights = {"words": random(len(vocabulary) + 1, WORD_SIZE) * 0.1, "pairs": random(PAIRS, PAIR_SIZE) * 0.1}
    positive, share = max(labels.sum(), 1), labels.mean() if len(labels) else 0.5
    for word, i in vocabulary.items():
        weights["words"][i, 0] = np.log((toxic[word] + 5 * share) / (seen[word] - toxic[word] + 5 * (1 - share)) * (len(labels) - positive + 1) / positive) * ODDS
    weights["words"][-1] = 0
    for name in "fb":
        weights |= {"W" + name: random(INPUT, 3 * HIDDEN), "U" + name: random(HIDDEN, 3 * HIDDEN), "c" + name: np.zeros(3 * HIDDEN, np.float32)}
    weights |= {"v": random(2 * HIDDEN), "o": random(2 * HIDDEN), "b": np.zeros(1, np.float32)}
    return Network(vocabulary, weights)


def _ranked(network: Network, docs: list[list[str]], odds: bool, ranks: list[list[int]]) -> list[list[list[str]]]:
    """The words of the windows of each text that have the wanted ranks, from the worst on."""
    if odds:
        # before any training the word odds name the worst window
        first = network.weights["words"][:, 0]
        spans = [(i, s, n) for i, words in enumerate(docs) for s, n in windows_of(len(words))]
        found = np.array([max((first[network.vocabulary.get(w, -1)] for w in docs[i][s : s + n]), default=0) for i, s, n in spans])
    else:
        found, spans = network.probabilities(docs)
    by_text: list[list[int]] = [[] for _ in docs]
    for k, (i, _, _) in enumerate(spans):
        by_text[i].append(k)
    out = []
    for i, own in enumerate(by_text):
        ranked = sorted(own, key=lambda k: -found[k])
        out.append([docs[i][spans[ranked[r]][1] : spans[ranked[r]][1] + spans[ranked[r]][2]] for r in ranks[i]])
    return out


Choice = Callable[[Network, bool, list[list[int]]], list[list[list[str]]]]


def _learn(network: Network, y: np.ndarray, sizes: list[int], choose: Choice, seed: int) -> Network:
    """Fit from the windows that ``choose`` gives for wanted ranks; ``sizes`` are the numbers of windows of the texts."""
    draw = np.random.default_rng(seed)
    if not 0 < y.sum() < len(y):
        return network
    moment = {k: np.zeros_like(v) for k, v in network.weights.items()}
    square = {k: np.zeros_like(v) for k, v in network.weights.items()}
    step = 0
    for turn in range(ROUNDS):
        ranks = [[0] if label else [0, *(1 + draw.permutation(n - 1)[: CLEAN_WINDOWS - 1]).tolist()] for label, n in zip(y, sizes)]
        worst, clean = [], []
        for label, windows in zip(y, choose(network, not turn, ranks)):
            (worst if label else clean).extend(windows)
        for _ in range(STEPS):
            part = [(worst[k], 1.0) for k in draw.choice(len(worst), TOXIC_SHARE)] + [(clean[k], 0.0) for k in draw.choice(len(clean), BATCH - TOXIC_SHARE)]
            part.sort(key=lambda c: -len(c[0]))
            grad = network.gradients([words for words, _ in part], np.array([label for _, label in part], np.float32))
            step += 1
            for name, g in grad.items():
                moment[name] = 0.9 * moment[name] + 0.1 * g
                square[name] = 0.999 * square[name] + 0.001 * g * g
                move = moment[name] / (1 - 0.9**step) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
                network.weights[name] -= (RATE * (move + DECAY * network.weights[name])).astype(np.float32)
    return network


def train(texts: list[str], labels: list[int], seed: int = 0) -> Network:
    """Fit on whole labelled texts. Without both classes the network stays as it starts."""
    docs, y = [split_words(t) for t in texts], np.array(labels, np.float32)
    sizes = [len(windows_of(len(words))) for words in docs]
    return _learn(_new_network(docs, y, seed), y, sizes, lambda network, odds, ranks: _ranked(network, docs, odds, ranks), seed)


def fit(df: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, label: str, allowed: Column, seed: int = 0) -> Network:
    """Train on a bounded sample of the labelled rows that ``allowed`` (of the label's key) is true for.

    Rows of either class are taken in the order of a hash of their key, so the sample is the same on any cluster. Their
    texts are stored and read whole inside the tasks; the driver gets the vocabulary and the windows it learns from.
    """
    known = labels.filter(allowed & F.col(label).isNotNull()).select(F.col(label_key).alias("_key"), F.col(label).cast("int").alias("_label"))
    texts = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    draw = F.xxhash64(F.col("_key")).alias("_draw")
    parts = []
    for value in (0, 1):
        # the keys are drawn first, so that only their texts travel
        chosen = drawn(known.filter(F.col("_label") == value).select("_key").distinct(), "_key", SAMPLE_ROWS).select("_key", draw)
        parts.append(texts.join(chosen.orderBy("_draw", "_key").limit(SAMPLE_ROWS), "_key").withColumn("_label", F.lit(value)))
    sample = store_rows(parts[0].unionByName(parts[1]), "toxicity-sample")
    order = ["_draw", "_key", F.md5(F.coalesce("_text", F.lit(""))), "_row"]
    y, number = [], {}
    for value in (0, 1):
        # at most SAMPLE_ROWS row ids
        for row in sample.filter(F.col("_label") == value).orderBy(*order).select("_row").limit(SAMPLE_ROWS).collect():
            number[row["_row"]] = len(y)
            y.append(value)

    def over(work: Callable[[list[int], list[list[str]]], Iterator[tuple]], fields: str) -> DataFrame:
        """The rows that ``work`` gives for the numbers and words of some texts at a time."""
        schema = T.StructType.fromDDL(fields)
        kinds = to_arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                numbers: list[int] = []
                docs: list[list[str]] = []
                chars = 0
                for at, (row, value) in enumerate(zip(batch.column("_row").to_pylist(), batch.column("_text"))):
                    if row in number:
                        read = value.as_py() or ""
                        numbers.append(number[row])
                        docs.append(split_words(read))
                        chars += len(read)
                    if docs and (chars > SLICE or at + 1 == batch.num_rows):
                        columns = list(zip(*work(numbers, docs))) or [()] * len(kinds)
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)
                        numbers, docs, chars = [], [], 0

        return sample.select("_row", "_text").mapInArrow(run, schema)

    found = over(lambda numbers, docs: ((w, y[i]) for i, words in zip(numbers, docs) for w in sorted(set(words))), "word string, toxic int")
    words = found.groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).filter(F.col("n") >= SEEN)
    # at most VOCABULARY words
    frequent = words.orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()
    sizes_of = over(lambda numbers, docs: ((i, len(windows_of(len(words)))) for i, words in zip(numbers, docs)), "i int, n int").collect()
    sizes = [n for _, n in sorted((row["i"], row["n"]) for row in sizes_of)]

    def choose(network: Network, odds: bool, ranks: list[list[int]]) -> list[list[list[str]]]:
        def windows(numbers: list[int], docs: list[list[str]]) -> Iterator[tuple]:
            for i, own in zip(numbers, _ranked(network, docs, odds, [ranks[i] for i in numbers])):
                yield i, [" ".join(window) for window in own]

        # at most CLEAN_WINDOWS windows of each text
        rows = sorted((row["i"], row["windows"]) for row in over(windows, "i int, windows array<string>").collect())
        return [[window.split(" ") if window else [] for window in own] for _, own in rows]

    labels_of = np.array(y, np.float32)
    network = _network_of({row["word"]: row["n"] for row in frequent}, Counter({row["word"]: row["t"] for row in frequent}), labels_of, seed)
    return _learn(network, labels_of, sizes, choose, seed)


def score(df: DataFrame, keep: list[str], text: str, network: Network, name: str = "score") -> DataFrame:
    """The ``keep`` columns of every row and ``name``, the probability of its worst window.

    Every word of a text is in some window. Null and empty texts, and those without letters, are one empty window.
    Equal texts get equal scores. An empty table gives no rows. No kept column may be called ``name``.
    """
    schema, body = df.select(*keep).schema, fresh(keep, "_body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waiting: list[list[str]] = []
            scores: list[float] = []
            chars = 0
            for value in batch.column(body):
                read = value.as_py() or ""
                waiting.append(split_words(read))
                chars += len(read)
                if chars > SLICE:
                    scores += network.score(waiting).tolist()
                    waiting, chars = [], 0
            scores += network.score(waiting).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(scores, pa.float64())], [*keep, name])

    return df.select(*keep, F.col(text).cast("string").alias(body)).mapInArrow(run, schema.add(name, "double"))
