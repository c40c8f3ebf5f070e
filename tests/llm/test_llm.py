"""The training-data operators: SQL or brute force beside them, and defined results for awkward tables."""

from __future__ import annotations

import heapq
import math
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from oracle_check import compare, duck
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ridepulse.llm import licenses, lm, packing, quality, secrets, simhash, tokens, tokenstore, toxicity
from ridepulse.llm.decontamination import contamination
from ridepulse.llm.graph import components
from ridepulse.llm.licenses import scan as license_scan
from ridepulse.llm.queries import ORACLES, QUERIES, TOKENIZER
from ridepulse.llm.secrets import redact, scan, with_findings
from ridepulse.llm.sharding import assign_shards, number_in_shards
from ridepulse.llm.tokens import encoded
from ridepulse.session import scratch

PATH = public_tokenizers.path(TOKENIZER)
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
# names that the operators use themselves, as columns of the table
CLASH = "doc_id long, text string, lang string, source string, n_chars long, items string, spans string, score double, _doc string, _row long, _digest string, _body string"


def awkward(spark):
    long = " ".join(f"word{i % 977} the" for i in range(40_000))
    texts = [
        (1, "plain words of a text"), (2, None), (3, ""), (4, long), (5, "plain words of a text"), (5, "plain words of a text"),
        (None, "no id here"), (None, None), (6, " \t\n "), (7, f"x {PASSAGE.upper()}, y"), (8, 'token = "abcdef123456" end'),
        (9, "  two  spaces \n\n and\x0blines  "), (10, "Émile ²½ 日本語 ça <|endoftext|> it's"),
    ]
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else "s", 1, "i", "s", 0.5, "d", 7, "g", "b") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, CLASH)


def nothing(spark):
    return spark.createDataFrame([], CLASH)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, name):
    result = compare(spark, duck(sf), sf, name, QUERIES[name], ORACLES[name])
    assert result.startswith("ok "), result


def test_shards_grow_only_into_the_new_one_and_follow_weights(spark):
    rows = assign_shards(spark.range(20_000).withColumnRenamed("id", "k"), "k", [1.0, 3.0], grown="g").collect()
    assert all(r.g in (r.shard, 2) for r in rows)
    assert abs(sum(r.shard for r in rows) / 20_000 - 0.75) < 0.02
    for df in (awkward(spark), nothing(spark)):
        out = number_in_shards(assign_shards(df.select("doc_id", "_row"), "doc_id", [1.0] * 3), ["doc_id"]).toPandas()
        assert len(out) == df.count()
        for _, part in out.groupby("shard"):
            assert sorted(part.slot) == list(range(len(part)))


def test_contamination_matches_a_search_of_every_window(spark):
    vocabulary = "a b c d".split()
    draw = np.random.default_rng(3)
    texts = [" ".join(draw.choice(vocabulary, draw.integers(0, 60))) for _ in range(150)] + [None, "", PASSAGE + " tail", "b"]
    items = [" ".join(draw.choice(vocabulary, n)) for n in (30, 14, 13, 12, 7, 4, 3)] + [PASSAGE, "", None, "zz"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for window in (13,):
        got = {r.doc_id: r for r in contamination(docs, "text", bench, "item_id", "text", window).collect()}
        for i, text in enumerate(texts):
            words, hit, found = (text or "").split(), set(), set()
            for j, item in enumerate(items):
                own = (item or "").split()
                n = min(window, len(own))
                grams = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
                for k in range(len(words) - n + 1) if n else ():
                    if tuple(words[k : k + n]) in grams:
                        hit |= set(range(k, k + n))
                        found.add(str(j))
            assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == (len(words), len(hit), sorted(found)), (i, text)


def test_contamination_of_awkward_tables(spark):
    bench = spark.createDataFrame([(1, PASSAGE), (None, "no id here"), (1, PASSAGE)], "item_id long, text string")
    rows = contamination(awkward(spark), "text", bench, "item_id", "text").collect()
    assert len(rows) == 13 and [r.doc_id for r in rows if r.contaminated] in ([7, None], [None, 7])
    assert contamination(nothing(spark), "text", bench, "item_id", "text").count() == 0
    assert not any(r.contaminated for r in contamination(awkward(spark), "text", bench.limit(0), "item_id", "text").collect())


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_tokens_are_those_of_the_library(spark):
    import pyarrow as pa

    draw = np.random.default_rng(1)
    texts = [r.text for r in awkward(spark).collect()] + ["".join(draw.choice(list(" \n\taé'.1²　_日x"), 60)) for _ in range(300)]
    for text, raw in zip(texts, encoded(PATH, pa.array(texts))):
        assert np.frombuffer(raw, "<u4").tolist() == ids_of(text)


def test_parts_of_words_give_the_ids_of_the_library(monkeypatch):
    import pyarrow as pa

    # generations and slices end often; letters, marks and lines beside all that may not be cut there
    monkeypatch.setattr(tokens, "CACHED_CHARS", 2000)
    monkeypatch.setattr(tokens, "TOGETHER", 3000)
    monkeypatch.setattr(tokens, "SLICE", 400)
    monkeypatch.setitem(tokens._ENCODERS, PATH, tokens.Encoder(PATH))
    draw = np.random.default_rng(7)
    bits = [
        "a", "The", "word", "ing", "Größe", "año", "слово", "λόγος", "ω", "日本", "שלום", "e\u0301", "ª", "²", "Ⅷ", "x" * 90, "1", "2024", "_", ".", ",", "!?", "###", "(", "'", "'s", "'re",
        "don't", "''", "<", "|>", "<|endoftext|>", "endoftext", "\n", "\n\n", "\r\n", "\t", "\u00a0", "\u2028", "\x85", "\x1c", "\x00", "\u200b", "🙂", " ", " ", " ", " ", "  ", " \n", "\n ", ".\n", ",\nAnd",
    ]
    texts = ["".join(draw.choice(bits, int(n))) for n in draw.integers(0, 40, 1500)]
    texts += [" ".join(draw.choice(bits[:36], 300)) for _ in range(5)] + [None, "", " ", "\n", "ab" * 3000, "word " * 400, "word. " * 400]
    library = Tokenizer.from_file(PATH)
    for text, raw in zip(texts, encoded(PATH, pa.array(texts, pa.string())), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def test_cached_parts_take_few_bytes_a_character(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    monkeypatch.setattr(tokens, "CACHED_CHARS", 200_000)
    draw, tool = np.random.default_rng(5), tokens.Encoder(PATH)
    texts = [" ".join("".join(word) for word in draw.choice(list("abcdefgh"), (20_000, 9))) for _ in range(3)]
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()
        for text in texts:
            tool.encode(pa.array([text]))
        held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert 200_000 < held < 10 * 200_000


def test_cached_parts_are_those_looked_up_last(monkeypatch):
    import pyarrow as pa

    handed, tool = [], tokens.Encoder(PATH)
    model = tool.model

    class Watched:
        def tokenize(self, part):
            handed.append(part)
            return model.tokenize(part)

    tool.model = Watched()
    monkeypatch.setattr(tokens, "CACHED_CHARS", 300)
    draw = np.random.default_rng(6)
    words = ["".join(word) for word in draw.choice(list("abcdefgh"), (40, 9))]
    first, second, third, fourth = (words[at : at + 10] for at in range(0, 40, 10))
    # the cache holds less than three of these texts
    for some in (first, second, first, third, first, fourth, second):
        text = " ".join(some)
        assert np.frombuffer(tool.encode(pa.array([text]))[0], "<u4").tolist() == tool.tokenizer.encode(text, add_special_tokens=False).ids
    assert [handed.count("Ġ" + word) for word in words] == [1] * 10 + [2] * 10 + [1] * 20


def test_words_that_differ_in_their_marks_are_not_encoded_again(monkeypatch):
    import pyarrow as pa

    handed, tool = [], tokens.Encoder(PATH)
    library = tool.tokenizer

    class Watched:
        def encode_batch_fast(self, texts, **options):
            handed.extend(texts)
            return library.encode_batch_fast(texts, **options)

    tool.tokenizer = Watched()
    monkeypatch.setitem(tokens._ENCODERS, PATH, tool)
    draw = np.random.default_rng(2)
    words = ["".join(draw.choice(list("abcdeéßñ"), 9)) for _ in range(500)]
    texts = [" ".join(f"{w}{mark}" for w in words) for mark in ("", ",", ".", ";", "!", "###", ".\nThe")]
    for text, raw in zip(texts, encoded(PATH, pa.array(texts)), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert sum(map(len, handed)) < len(texts[0])


@pytest.mark.parametrize("targets", [None, {"s": 3.0, "t": 1.0}])
def test_packing_fills_windows_and_keeps_every_id(spark, targets):
    docs = awkward(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    more = spark.range(100, 160).selectExpr("id doc_id", "repeat('some words here ', cast(id as int)) text", "'t' source")
    docs = docs.select("doc_id", "text", "source").unionByName(more)
    pieces = packing.pack(docs, "text", "source", ["doc_id"], PATH, length=256, targets=targets, rest=0.5).collect()
    of_doc, of_window = {}, {}
    for p in pieces:
        of_doc.setdefault(p.doc_id, []).append(p)
        of_window.setdefault(p.sequence_id, []).append(p)
    for row in docs.collect():
        own = sorted(of_doc[row.doc_id], key=lambda p: p.start)
        assert b"".join(p.ids for p in own) == np.array([*ids_of(row.text), 1], "<u4").tobytes()
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own[:-1]]]).tolist()
    assert sorted(of_window) == list(range(len(of_window)))
    for window, own in of_window.items():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *[p.length for p in own[:-1]]]).tolist()
        assert sum(p.length for p in own) == 256 or window == max(of_window)
    assert packing.pack(nothing(spark), "text", "source", ["doc_id"], PATH).count() == 0


def test_mixture_keeps_shares_in_every_window():
    totals = [50_000, 30_000, 20_000, 7]
    mix = packing.Mixture(totals, [t / sum(totals) for t in totals], 100)
    served = mix.served(np.arange(sum(totals) // 100 + 2))
    ideal = np.minimum(np.arange(len(served))[:, None] * 100, sum(totals)) * np.array(totals) / sum(totals)
    assert np.abs(served - ideal).max() < 2 and (np.diff(served, axis=0) >= 0).all()
    assert (served[-1] == totals).all() and (np.diff(served.sum(1))[:-1] <= 100).all()


def test_mixture_equals_queues_served_in_turns():
    """Each queue's credit grows by its share; the queue whose credit first makes up half a token is served and pays one."""
    for totals, shares, length in (([700, 300, 45, 7], [0.5, 0.3, 0.15, 0.05], 64), ([5, 400, 90], [1 / 3] * 3, 17), ([60, 60], [0.25, 0.75], 8)):
        turns = [(0.5 / share, q, 1) for q, share in enumerate(shares)]
        heapq.heapify(turns)
        counts, done = [[0] * len(totals)], 0
        while turns:
            _, q, nth = heapq.heappop(turns)
            if done % length == 0 and done:
                counts.append(list(counts[-1]))
            if done == 0:
                counts.append(list(counts[-1]))
            counts[-1][q] += 1
            done += 1
            if nth < totals[q]:
                heapq.heappush(turns, ((nth + 0.5) / shares[q], q, nth + 1))
        served = packing.Mixture(totals, shares, length).served(np.arange(len(counts)))
        assert np.abs(served - np.array(counts)).max() <= 1 and (served.sum(1) == np.array(counts).sum(1)).all()
        assert (served != np.array(counts)).mean() < 0.02, "equal but for steps at the very same time"


def test_a_source_without_a_share_is_an_error(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "c d", "t")], "doc_id long, text string, source string")
    with pytest.raises(ValueError, match="every source"):
        packing.pack(docs, "text", "source", ["doc_id"], PATH, targets={"s": 1.0})


def test_every_source_has_its_share_in_every_window(spark):
    many = spark.range(1100).selectExpr("id doc_id", "repeat(' one', cast(if(id < 1000, 60, 30) as int)) text", "concat('s', id) source")
    targets = {f"s{i}": 1.0 + i % 2 for i in range(1100)}
    for wanted in (None, targets):
        pieces = packing.pack(many, "text", "source", ["doc_id"], PATH, length=2200, targets=wanted).collect()
        total, served = Counter(), Counter()
        for p in pieces:
            total[p.doc_id] += p.length
            served[p.doc_id] += p.length if p.sequence_id < 8 else 0
        weight = total if wanted is None else {i: 1.0 + i % 2 for i in total}
        for i, n in total.items():
            ideal = 8 * 2200 * weight[i] / sum(weight.values())
            assert ideal < n and abs(served[i] - ideal) < 2


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_forests_match_brute_force(spark):
    for row in awkward(spark).collect():
        assert simhash.fingerprint(row.text) == brute_fingerprint(row.text)
    draw = np.random.default_rng(5)
    for radius in (1, 2, 3):
        centre = draw.integers(0, 2**63, 6, dtype=np.uint64)
        prints = np.unique([c ^ np.uint64(sum(1 << int(b) for b in draw.integers(0, 16, 3))) for c in centre for _ in range(60)])
        groups = list(range(len(prints)))
        for a, b in simhash.forest(prints, radius):
            assert (int(prints[a]) ^ int(prints[b])).bit_count() <= radius
            low, high = sorted((groups[a], groups[b]))
            groups = [low if g == high else g for g in groups]
        for a in range(len(prints)):
            for b in range(a):
                if (int(prints[a]) ^ int(prints[b])).bit_count() <= radius:
                    assert groups[a] == groups[b]


def test_near_duplicates_of_awkward_tables(spark):
    found = {(r.doc_id, r._print): r._component for r in simhash.near_duplicates(awkward(spark), "doc_id", "text").collect()}
    by_id = {k[0]: v for k, v in found.items() if k[0] is not None}
    assert by_id[1] == by_id[5] == 1 and by_id[2] == by_id[3] == by_id[6] == 2
    kept = simhash.representatives(awkward(spark), "doc_id", "text")
    assert kept.columns == awkward(spark).columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 4, 7, 8, 9, 10]
    repeated = awkward(spark).filter("doc_id = 5")
    assert simhash.representatives(repeated, "doc_id", "text").count() == 1
    assert simhash.representatives(nothing(spark), "doc_id", "text").count() == 0


def test_groups_that_share_an_id_or_have_none_keep_a_row_each(spark):
    one, two = "red green blue cyan", "dog cat bird fish"
    rows = spark.createDataFrame([(1, one), (1, two), (2, one + " "), (3, two + " ")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in simhash.representatives(rows, "doc_id", "text").collect()) == [(1, two), (1, one)]
    assert simhash.representatives(rows.withColumn("doc_id", F.lit(None).cast("long")), "doc_id", "text").count() == 2
    pairs = ([" ".join([*(f"w{i}" for i in range(n)), f"x{k}"]) for k in range(2)] for n in range(100, 400))
    a, b = next(p for p in pairs if 0 < (simhash.fingerprint(p[0]) ^ simhash.fingerprint(p[1])).bit_count() <= 2)
    near = spark.createDataFrame([(None, a), (None, b)], "doc_id long, text string")
    assert simhash.representatives(near, "doc_id", "text").count() == 1


def test_components_of_a_long_path(spark):
    edges = spark.range(200).selectExpr("(id * 37) % 211 a", "((id + 1) * 37) % 211 b").unionByName(spark.createDataFrame([(900, 901), (901, 900), (7, 7)], "a long, b long"))
    roots = {r.node: r.root for r in components(edges).collect()}
    assert {roots[(i * 37) % 211] for i in range(201)} == {0} and roots[901] == 900


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op5_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    hit = sum(r.predicted for r in rows if r.toxic == 1) / max(1, sum(r.toxic == 1 for r in rows))
    false = sum(r.predicted for r in rows if r.toxic == 0) / sum(r.toxic == 0 for r in rows)
    assert hit > 0.5 and false < 0.03


def test_training_reads_whole_texts(spark):
    fill = "plain words about the weather and the harbour " * 600
    rows = [(i, f"{fill} zorkish blaggard" if i % 2 else fill) for i in range(24)]
    assert len(fill) > 20_000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, toxic int")
    network = toxicity.fit(docs, "doc_id", "text", labels, "doc_id", "toxic", F.lit(True))
    assert {"zorkish", "blaggard"} <= set(network.vocabulary)
    worst = network.score([toxicity.split_words(t) for _, t in rows[:2]])
    assert worst[1] > 0.9 and worst[0] < 0.1


def test_toxicity_of_awkward_tables(spark):
    network = toxicity.train(["you idiot moron", "a fine day", "idiot again", "words and more"] * 4, [1, 0, 1, 0] * 4)
    rows = toxicity.score(awkward(spark), ["doc_id", "text"], "text", network).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert toxicity.score(nothing(spark), ["doc_id"], "text", network).count() == 0
    assert toxicity.train([], []).score([["a"]]).shape == (1,)


def test_gradients_match_differences():
    docs = [toxicity.split_words(t) for t in ("you are a moron now", "the cat sat on the mat here", "idiot of the year")]
    network = toxicity._new_network(docs * 4, np.array([1, 0, 1] * 4, np.float32), 0)
    network.weights = {k: v.astype(float) for k, v in network.weights.items()}
    docs.sort(key=len, reverse=True)
    labels = np.array([0.0, 1.0, 1.0])

    def loss():
        local, sizes = {}, np.array([len(x) for x in docs])
        ids = np.zeros((3, sizes[0]), int)
        for row, words in enumerate(docs):
            ids[row, : len(words)] = [local.setdefault(x, len(local)) for x in words]
        p = toxicity._sigmoid(network.run(network.inputs(list(local))[0], ids, sizes)["logits"])
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for name, grad in network.gradients(docs, labels).items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        value = network.weights[name][at]
        ends = []
        for move in (1e-3, -1e-3):
            network.weights[name][at] = value + move
            ends.append(loss())
        network.weights[name][at] = value
        assert abs((ends[0] - ends[1]) / 2e-3 - grad[at]) < 1e-3 * max(1, abs(grad[at])), name


def test_scores_match_a_dictionary_model(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(lm, "SEGMENT", 7)
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()] + [(i, f"the cat {i % 3} sat on the mat the cat sat") for i in range(20, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").filter("doc_id is not null").dropDuplicates(["doc_id"])
    found = {r.doc_id: r for r in lm.score(df, "doc_id", "text", F.col("doc_id") % 10 == 0).collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b""] for r in df.collect()}
    train = [t for i, t in texts.items() if i % 10]
    counts = Counter(w for t in train for w in t)
    total = sum(counts.values())
    logs = {w: math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for t in texts.values() for w in t}
    pairs = Counter((u, w) for t in train for u, w in zip([None, *t], t))
    read = {**counts, None: len(train)}
    for i, text in texts.items():
        want = 0.0
        for u, w in zip([None, *text], text):
            times = read.get(u, 0)
            if (u, w) in pairs:
                want += math.log10((pairs[u, w] + lm.PRIOR * 10 ** logs[w]) / (times + lm.PRIOR))
            else:
                want += math.log10(lm.PRIOR / (times + lm.PRIOR)) + logs[w]
        got = found[i]
        assert math.isclose(got.score, want, rel_tol=1e-9) and math.isclose(got.base_score, sum(logs[w] for w in text), rel_tol=1e-9)
        assert (got.n_tokens, got.n_known, got.train_tokens) == (len(text), sum(counts[w] > 0 for w in text), total)


def test_scores_of_awkward_tables(spark):
    assert lm.score(awkward(spark), "doc_id", "text", F.lit(False)).count() == 13
    assert lm.score(nothing(spark), "doc_id", "text", F.lit(False)).count() == 0
    held = lm.score(awkward(spark), "doc_id", "text", F.lit(True)).collect()
    assert all(r.n_known == 0 and math.isclose(r.score, r.base_score) for r in held)


def test_a_rare_bigram_has_an_arc_in_a_corpus_of_any_size(spark):
    rows = [(0, "a " * 200_000), (1, "rare pair"), (2, "rare pair"), (10, "rare pair")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lm.score(df, "doc_id", "text", F.col("doc_id") == 10).collect()}[10]
    total, seen = 200_007, {"rare": 2, "pair": 2, "end": 3}
    p = {w: (n + 0.1) / (total + 0.1 * 5) for w, n in seen.items()}
    # start to rare, rare to pair and pair to the end were seen twice each; the start was read three times
    arcs = [(2, 3, p["rare"]), (2, 2, p["pair"]), (2, 2, p["end"])]
    assert math.isclose(got.score, sum(math.log10((n + lm.PRIOR * q) / (c + lm.PRIOR)) for n, c, q in arcs), rel_tol=1e-9)


def test_probabilities_after_a_word_add_up_to_one(spark):
    train = [(1, "a b a c"), (2, "b c"), (3, "c a b")]
    words = ["a", "b", "c", "", "never"]
    tried = [(100 + i, f"a {w}".strip()) for i, w in enumerate(words)] + [(200, "a")]
    df = spark.createDataFrame(train + tried, "doc_id long, text string")
    rows = {r.doc_id: r for r in lm.score(df, "doc_id", "text", F.col("doc_id") >= 100).collect()}
    # the score of "a w" up to w: without its end, which follows w
    counts = Counter(w for _, t in train for w in [*t.split(), ""])
    total, pairs = sum(counts.values()), Counter(p for _, t in train for p in zip(t.split(), [*t.split()[1:], ""]))
    q = {w: (counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1)) for w in words}
    end = {w: (pairs[w, ""] + lm.PRIOR * q[""]) / (counts[w] + lm.PRIOR) for w in words}
    mass = sum(10 ** rows[100 + i].score / end[w] for i, w in enumerate(words) if w)
    mass += 10 ** rows[200].score
    first = (sum(t.startswith("a") for _, t in train) + lm.PRIOR * q["a"]) / (3 + lm.PRIOR)
    assert math.isclose(mass / first, 1.0, rel_tol=1e-9)


def test_key_blocks_come_back(spark, monkeypatch):
    values = np.array([0, 3, 254, 255, 1 << 40])
    assert lm._loose(lm._packed(values), 5).tolist() == values.tolist()
    df = spark.createDataFrame([(i, f"w{i % 50} w{i % 7} w{i % 3}") for i in range(300)], "doc_id long, text string")
    want = sorted(map(tuple, lm.score(df, "doc_id", "text", F.col("doc_id") % 10 == 0).collect()))
    monkeypatch.setattr(lm, "RANGE_TOKENS", 100)
    monkeypatch.setattr(lm, "CHUNK_BYTES", 500)
    got = sorted(map(tuple, lm.score(df, "doc_id", "text", F.col("doc_id") % 10 == 0).collect()))
    assert [g[:5] for g in got] == [w[:5] for w in want] and np.allclose([g[5:] for g in got], [w[5:] for w in want])


def test_ledger_scans_only_unseen_blobs(spark):
    first = awkward(spark)
    one = scan(first, "text")
    assert one.ledger.count() == first.select(F.coalesce("text", F.lit(""))).distinct().count()
    later = first.select("doc_id", "text").unionByName(spark.createDataFrame([(20, "AKIA" + "A1" * 8), (21, 'token = "abcdef123456" end')], "doc_id long, text string"))
    two = scan(later, "text", one.ledger, one.findings)
    assert two.ledger.count() == one.ledger.count() + 1 and two.findings.count() == one.findings.count() + 1
    again = scan(later, "text", two.ledger, two.findings)
    assert again.ledger.count() == two.ledger.count() and again.findings.count() == two.findings.count()
    rows = with_findings(later, "text", two.findings).withColumn("clean", redact("text", "spans")).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 15 and by_id[21].spans and by_id[20].spans[0].kind == "access"
    assert by_id[8].clean == by_id[21].clean == '[SECRET]" end' and by_id[2].clean is None and by_id[1].clean == "plain words of a text"
    assert with_findings(nothing(spark), "text", scan(nothing(spark), "text").findings).count() == 0


def test_a_stored_ledger_takes_each_blob_once(spark, monkeypatch):
    ledger, scanned = secrets.Ledger(spark, scratch(spark, "ledger")), []
    plain = secrets.scan
    monkeypatch.setattr(secrets, "scan", lambda *a, **k: scanned.append(plain(*a, **k)) or scanned[-1])
    rows = awkward(spark).select("doc_id", "text")
    for part in (rows.filter("doc_id < 6"), rows, rows, nothing(spark).select("text")):
        ledger.add(part, "text")
    blobs = rows.select(F.coalesce("text", F.lit("")).alias("t")).distinct().count()
    assert ledger.entries.count() == blobs and ledger.entries.distinct().count() == blobs
    assert [s.new_entries.count() for s in scanned[2:]] == [0, 0] and sum(s.new_entries.count() for s in scanned) == blobs
    once = with_findings(rows, "text", plain(rows, "text").findings).select("doc_id", "spans").collect()
    kept = with_findings(rows, "text", ledger.findings).select("doc_id", "spans").collect()
    assert sorted(map(str, once)) == sorted(map(str, kept))


def base_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_matches_numpy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = quality.quality(docs, "text", "lang", "source", ["doc_id"]).collect()
    found = {r.doc_id: r for r in rows}
    passed, groups = {}, {}
    for row in docs.collect():
        own = base_statistics(row.text)
        got = found[row.doc_id]
        assert tuple(got[c] for c in quality.STATISTICS) == own
        assert got.base_failed == (own[0] < 50 or 100 * own[4] > 50 * own[0])
        if not got.base_failed:
            n, chars, symbols, lines, repeated = own
            passed[row.doc_id] = np.array([math.log(n), math.log(chars / n), math.sqrt(symbols / chars), 10 * lines / n, repeated / n])
            groups[row.doc_id] = (row.lang, row.source)
    sizes = Counter(groups.values())
    pools = Counter(g[0] for g in groups.values() if sizes[g] < quality.SMALLEST)
    for i, g in groups.items():
        groups[i] = g if sizes[g] >= quality.SMALLEST else g[0] if pools[g[0]] >= quality.SMALLEST else "*"
    floors, draw, differ = np.array(quality.FLOORS), np.random.default_rng(8), 0

    def distances(x, mean, cov):
        return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)

    def step(x, mean, cov):
        near = np.floor(8 * np.log2(np.maximum(distances(x, mean, cov), 1e-9)))
        part = x[near <= np.sort(near)[math.ceil(quality.SUBSET * len(x)) - 1]]
        return part.mean(0), quality.CONSISTENCY * np.cov(part.T, bias=True) + np.diag(floors**2)

    def settled(x, mean, cov):
        best = step(x, *step(x, mean, cov))
        while np.linalg.slogdet((new := step(x, *best))[1])[1] < np.linalg.slogdet(best[1])[1] - quality.FALL:
            best = new
        return best

    for group in set(groups.values()):
        ids = [i for i in groups if groups[i] == group]
        x = np.array([passed[i] for i in ids])
        classes = np.sort(np.floor(x / (floors / 4)), axis=0)
        q1, q2, q3 = (classes[math.ceil(q * len(x)) - 1] for q in (0.25, 0.5, 0.75))
        robust = (q2 + 0.5) * floors / 4, np.diag(((q3 - q1) / 1.349 * floors / 4) ** 2 + floors**2)
        plain = x.mean(0), np.cov(x.T, bias=True) + np.diag(floors**2)
        ends = [settled(x, *s) for s in (robust, plain)]
        dets = [np.linalg.slogdet(e[1])[1] for e in ends]
        d = distances(x, *ends[int(dets[1] < dets[0] - quality.FALL)])
        assert np.allclose([found[i].distance for i in ids], d, rtol=1e-6)
        assert [found[i].kept for i in ids] == (d <= quality.CUTOFF).tolist()
        # many starts from six random rows each: the smallest determinant that any of them reaches
        starts = []
        for _ in range(60):
            few = x[draw.choice(len(x), min(6, len(x)), replace=False)]
            starts.append(settled(x, few.mean(0), np.cov(few.T, bias=True) + np.diag(floors**2)))
        least = distances(x, *min(starts, key=lambda e: np.linalg.slogdet(e[1])[1]))
        differ += sum((least <= quality.CUTOFF) != (d <= quality.CUTOFF))
    assert differ <= 0.02 * len(passed)


def test_kept_columns_with_new_names_are_replaced(spark):
    rows = awkward(spark).withColumns({"start": F.lit("x"), "kept": F.lit("y"), "n_words": F.lit("z")})
    pieces = packing.pack(rows, "text", "source", ["doc_id", "start"], PATH)
    assert dict(pieces.dtypes)["start"] == "bigint" and pieces.columns.count("start") == 1 and pieces.count() >= 13
    judged = quality.quality(rows, "text", "lang", "source", ["doc_id", "kept", "n_words"])
    assert dict(judged.dtypes)["kept"] == "boolean" and judged.columns.count("n_words") == 1 and judged.count() == 13


def test_quality_of_awkward_tables(spark):
    assert not any(r.kept for r in quality.quality(awkward(spark).filter("doc_id <> 4"), "text", "lang", "source", ["doc_id"]).collect())
    assert quality.quality(awkward(spark), "text", "lang", "source", ["doc_id"]).count() == 13
    assert quality.quality(nothing(spark), "text", "lang", "source", ["doc_id"]).count() == 0
    assert abs(quality.chi_square_quantile(0.95, 5) - 11.0705) < 1e-3


def test_repeated_lines_or_words_alone_reject_a_document(spark):
    draw = np.random.default_rng(2)
    words = ["w" + "".join(draw.choice(list("abcdefgh"), 5)) for _ in range(5000)]
    texts = [" ".join(draw.permutation(words)[: int(n)]) for n in draw.integers(150, 250, 300)]
    head = texts[0].split()
    # 8 duplicate lines of one word in some 200 words, and a quarter of the words in repeated runs
    texts += ["\n".join([" ".join(head), *["line"] * 9]), " ".join([*head, *head[: len(head) // 7]])]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    rows = {r.doc_id: r for r in quality.quality(df, "text", "lang", "source", ["doc_id"]).collect()}
    assert not rows[300].base_failed and not rows[300].kept and not rows[301].base_failed and not rows[301].kept
    assert sum(rows[i].kept for i in range(300)) > 280


def test_token_files_round_trip(spark):
    folder = scratch(spark, "tokens")
    tokenstore.write_tokens(awkward(spark), "doc_id", "text", folder, PATH)
    rows = tokenstore.read_tokens(spark, folder).join(tokenstore.block_starts(spark, folder), "block").collect()
    rows.sort(key=lambda r: r.first + r.place)
    want = sorted(awkward(spark).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    at = 0
    for row, doc in zip(rows, want, strict=True):
        ids = [*ids_of(doc.text), 0]
        assert (row.doc_id, row.first + row.place, row.n_tokens) == (doc.doc_id, at, len(ids))
        assert zlib.crc32(row.ids) == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert {r.doc_id for r in tokenstore.read_tokens(spark, folder, only=[4, 7]).collect()} == {4, 7}
    empty = scratch(spark, "tokens")
    tokenstore.write_tokens(nothing(spark), "doc_id", "text", empty, PATH)
    assert tokenstore.read_tokens(spark, empty).count() == tokenstore.block_starts(spark, empty).count() == 0


def test_licenses_come_from_the_nearest_directory(spark):
    files = [
        ("a/LICENSE", "Released under the MIT License."), ("a/b/LICENSE", "text\nLicensed under the Apache License, Version 2.0."),
        ("a/x.c", "int x;"), ("a/b/c/y.c", "int y;"), ("a/b/z.c", "Licensed under CC BY-NC 4.0.\nint z;"), ("q/w.c", "we license this to nobody in particular under any terms"),
        (None, "Released under the MIT License."), ("a/n.c", None), ("a/n.c", ""), ("a/b/LICENSE", "text\nLicensed under the Apache License, Version 2.0."),
    ]
    df = spark.createDataFrame([(p, t, 1) for p, t in files], "path string, text string, license int")
    out = [(r.path, r.own_license, r.license, r.source_directory) for r in license_scan(df, "path", "text", F.col("path").endswith("LICENSE")).collect()]
    want = [
        ("a/LICENSE", "MIT", "MIT", None), ("a/b/LICENSE", "Apache-2.0", "Apache-2.0", None), ("a/x.c", None, "MIT", "/a/"), ("a/b/c/y.c", None, "Apache-2.0", "/a/b/"),
        ("a/b/z.c", "CC-BY-NC-4.0", "CC-BY-NC-4.0", None), ("q/w.c", None, None, None), (None, "MIT", "MIT", None), ("a/n.c", None, "MIT", "/a/"),
        ("a/n.c", None, "MIT", "/a/"), ("a/b/LICENSE", "Apache-2.0", "Apache-2.0", None),
    ]
    assert sorted(map(str, out)) == sorted(map(str, want))
    assert license_scan(df.limit(0), "path", "text", F.lit(True)).count() == 0


def wrapped(text, mark=""):
    paragraphs = [textwrap.wrap(" ".join(p.split()), 70) for p in re.split(r"\n\s*\n", text)]
    return "\n".join(f"{mark}{line}".rstrip() for p in paragraphs for line in [*p, ""])


def test_wrapped_notices_headers_and_licence_files_are_found(spark):
    names = [(name, text) for name, texts in licenses.FULL.items() for text in texts]
    code = "\nint y = other(thing, value);" * 200
    files = [(f"{name}|{i}|{kind}", body) for i, (name, text) in enumerate(names) for kind, body in (
        ("file", wrapped(text)), ("hash", wrapped(text, "# ") + code), ("block", "/*\r\n" + wrapped(text, " * ").replace("\n", "\r\n") + " */" + code),
    )]
    files.append(("BSD-3-Clause||clauses", wrapped(licenses.TEMPLATES["BSD-3-Clause"][1], "// ") + code))
    files.append(("None||none", "This program is distributed to any person.\n" + code))
    df = spark.createDataFrame(files, "path string, text string")
    out = {r.path: r.own_license for r in license_scan(df, "path", "text", F.lit(False)).collect()}
    assert {path: str(found) for path, found in out.items()} == {path: path.split("|")[0] for path, _ in files}


def test_a_licence_text_of_any_length_holds_for_its_directory(spark, tmp_path):
    mit, gpl = licenses.FULL["MIT"][0], licenses.FULL["GPL-3.0"][0]
    rows = [(1, "s", mit), (12, "s", "int x;"), (2, "s", gpl), (234, "s", "int y;"), (3, "s", "word " * 100 + "\nReleased under the MIT License."), (31, "s", "int z;")]
    # document 10 is s/1/0, so its text holds for s/1/ and document 12; document 20 holds for s/2/ and document 234 below it
    rows += [(10, "s", mit), (20, "s", gpl)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: (r.license, r.source_directory) for r in QUERIES["op10_license_scan"](spark, str(tmp_path)).collect()}
    assert out[12] == ("MIT", "/s/1/") and out[234] == ("GPL-3.0", "/s/2/") and out[10] == ("MIT", None) and out[31][0] != out[3][0] == "MIT"


def test_every_stage_takes_awkward_tables(spark, sf):
    for docs in (awkward(spark), nothing(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name != "packing":
                assert out.columns == docs.columns
            assert out.count() >= (docs.count() > 0)


def test_pipeline_matches_its_stages_one_by_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scores = {r.doc_id: r.predicted for r in QUERIES["op5_toxicity"](spark, sf).collect()}
    left = [r for r in docs.orderBy("doc_id").collect() if not scores[r.doc_id]]
    prints = [simhash.fingerprint(r.text) for r in left]
    group = list(range(len(left)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(left)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    first = {left[i].doc_id for i in range(len(left)) if root(i) == i}
    dirty = {r.doc_id for r in QUERIES["op2_winnowing"](spark, sf).collect() if r.contaminated}
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == first - dirty
