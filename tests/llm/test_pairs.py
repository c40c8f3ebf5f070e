"""Alignment, whitening, the Jaccard join and licenses: brute force beside them, and defined results for awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_llm import awkward, nothing
from tokenizers import Tokenizer

from ridepulse.llm import alignment, jaccard, licenses, tokens, whitening
from ridepulse.llm.queries import PIECES, QUERIES, TOKENIZER

BYTES, PIECE = public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES)
ODD = [
    "", None, "  a  b ", "foo\n bar \n", " ", "a ", "x  y <|endoftext|> z\n</s> <s>", "the 日本語  é\t \n\n q  ", "\n", "a\x1c b",
    "   ", "it▁s x", "<0x0A> naïve ﬁn", "don't stop", "   x 　", "ab  ", "plain text of words",
]


def test_word_ids_equal_those_of_whole_texts():
    whole = Tokenizer.from_file(BYTES)
    for text, raw in zip(ODD, tokens.encoded(BYTES, pa.array(ODD))):
        assert np.frombuffer(raw, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


class Plain:
    """Both tokenizers on whole texts, and overlaps by walking through both token lists."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECE)
        self.a.encode_special_tokens = True
        self.byte = alignment.byte_of_character()

    def pieces(self, text: str) -> tuple[list, list]:
        found = self.a.encode(" " + text, add_special_tokens=False)
        left = [(i, bytes(self.byte[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
        right = [
            (i, bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode())
            for i in self.b.encode(text)
        ]
        return left, right

    def align(self, text: str | None):
        left, right = self.pieces(text) if text else ([], [])
        if b"".join(p for _, p in left) != b"".join(p for _, p in right) or (text and b"".join(p for _, p in left) != (" " + text).encode()):
            left, right = [], []
        ends = [np.cumsum([len(p) for _, p in side]).tolist() for side in (left, right)]
        links, groups, i, j, first = [], [], 0, 0, (0, 0)
        while i < len(left):
            links.append((left[i][0], right[j][0]))
            if ends[0][i] == ends[1][j]:
                sides = left[first[0] : i + 1], right[first[1] : j + 1]
                groups.append("|".join(",".join(str(n) for n, _ in side) for side in sides))
                i, j = i + 1, j + 1
                first = i, j
            elif ends[0][i] < ends[1][j]:
                i += 1
            else:
                j += 1
        return len(left), len(right), links, groups


def aligned_by_hand(rows: list[tuple]) -> list[tuple]:
    plain = Plain()
    found = [(key, *plain.align(text)) for key, text in rows]
    counts = Counter(link for *_, links, _ in found for link in links)
    most: dict[int, int] = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for key, n_a, n_b, links, groups in found:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(counts[x] == most[x[1]] for x in links)
        out.append((key, n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_equals_a_walk_through_both_token_lists(spark, sf, monkeypatch):
    docs = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    got = sorted(map(tuple, QUERIES["op11_token_alignment"](spark, sf).select(*COLUMNS).collect()), key=str)
    assert got == aligned_by_hand(docs)


def test_alignment_of_odd_long_and_missing_texts(spark, monkeypatch):
    rows = awkward(spark).select("doc_id", "text").collect()
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [tuple(r) for r in rows], "doc_id long, text string")
    got = sorted(map(tuple, alignment.align(odd, "doc_id", "text", BYTES, PIECE).select(*COLUMNS).collect()), key=str)
    assert got == aligned_by_hand([tuple(r) for r in odd.collect()])
    named = alignment.align(awkward(spark), "doc_id", "text", BYTES, PIECE)
    assert named.count() == len(rows) and named.columns[0] == "doc_id"
    assert alignment.align(nothing(spark), "doc_id", "text", BYTES, PIECE).collect() == []


def test_random_texts_align_as_whole_texts_do():
    draw = random.Random(5)
    pool = [*"aeé tT  \t\n\r\x0b\x0c.,'’!?-12٣ßﬁ\xa0\u2003\u200b\u0301日本한😀👩\u200d👧\x00\x1c\x7f\x85▁<|>/s0xA", " the", " don't", "  ", "\n\n", "<s>", "<|endoftext|>", "<0x41>"]
    texts, plain, both = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 40))) for _ in range(800)], Plain(), alignment.sides(BYTES, PIECE)
    found = alignment.Aligned(pa.array(texts), both)
    for k, text in enumerate(texts):
        n_a, n_b, links, groups = plain.align(text)
        assert (found.n_a[k], found.n_b[k], found.n_links[k], found.strings[k]) == (n_a, n_b, len(links), ";".join(groups)), text


def test_a_long_text_aligns_part_by_part(monkeypatch):
    monkeypatch.setattr(tokens, "SLICE", 300)
    text = "So it goes on, word  by word, naïve 日本語\n\n and more. " * 40
    both, plain = alignment.sides(BYTES, PIECE), Plain().align(text)
    rows = [row for part in alignment._long((7, 1), text, both, iter(range(100))) for row in part]
    parts = [r for r in rows if r[0] == 7]
    assert len(parts) > 3 and [sum(r[k] for r in parts) for k in (3, 4, 5, 6)] == [plain[0], plain[1], len(plain[3]), len(plain[2])]
    assert [r[7] for r in parts if r[7]] == [hashlib.sha256(";".join(plain[3]).encode()).hexdigest()]
    counts = Counter()
    for r in rows:
        if r[0] is None:
            counts.update({(p >> 32, p & 0xFFFFFFFF): n for p, n in zip(r[-2], r[-1])})
    assert counts == Counter(plain[2])
    altered = list(alignment._long((7, 1), text + " a▁b", both, iter(range(100))))
    assert [r[3:8] for part in altered for r in part] == [(0, 0, 0, 0, "")]


def test_narrow_numbers_come_back():
    values = np.array([0, 1, 254, 255, 256, 70_000, 3], np.int64)
    assert alignment._widen(alignment._narrow(values), len(values)).tolist() == values.tolist()


def test_inertia_and_leading_vectors():
    draw = np.random.default_rng(1)
    for _ in range(100):
        half = draw.integers(-2, 3, (draw.integers(1, 12),) * 2).astype(float)
        matrix, shift = half + half.T, draw.choice([0.5, 0.25, -1.3, 0.0001])
        assert whitening.inertia(matrix, shift) == (np.linalg.eigvalsh(matrix) > shift).sum()
    for size in (1, 2, 5, 40):
        rows = draw.standard_normal((3 * size, size))
        matrix = rows.T @ rows / size
        values, vectors = whitening.leading(matrix, 32)
        want, own = np.linalg.eigh(matrix)
        want, own = want[::-1][:32], own[:, ::-1][:, :32]
        assert np.allclose(values, want, rtol=1e-13) and np.allclose(np.abs((vectors * own).sum(0)), 1, atol=1e-12)
    turn, _ = np.linalg.qr(draw.standard_normal((8, 8)))
    matrix = turn @ np.diag([3.0, 3, 3, 2, 2, 1, 0, 0]) @ turn.T
    values, vectors = whitening.leading((matrix + matrix.T) / 2, 32)
    assert np.allclose(values, [3, 3, 3, 2, 2, 1]) and np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-12


def test_whitening_equals_dense_linear_algebra(spark, sf):
    got = QUERIES["op12_spectrum_whitening"](spark, sf).toPandas().sort_values(["vec_id", "component"])
    rows = duckdb.sql(f"select embedding from '{sf}/embeddings.parquet' order by vec_id").fetchall()
    x = np.floor(64 * np.array([r[0] for r in rows], float)) + 1_000_000
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    want, white = centred @ vectors / np.sqrt(values), got.whitened.to_numpy().reshape(n, 32)
    assert np.abs(white * np.sign((white * want).sum(0)) - want).max() < 1e-9
    assert np.allclose(got.explained.to_numpy()[:32], values / np.trace(centred.T @ centred / n), rtol=1e-10)
    assert (got.deviation.to_numpy()[::32] == ((n * x - sums) ** 2).sum(1).astype(np.int64)).all()
    assert (got.n == n).all() and got.identity_error.max() < 1e-10 and got.identity_error.nunique() == 1


def test_whitening_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 2.0], [3.0, 2.5], [0.5, -1.0], None, [None, 1.0], [nan, 1.0], [inf, 1.0], [], [0.5, -1.0]]
    rows = [(i if i != 1 else None, v, "x", 1.5) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "id int, v array<float>, component string, whitened double")
    model = whitening.fit(df, "v", 5)
    assert model.n == 4 and len(model.values) == 2
    got = whitening.whiten(df, "id", "v", model).toPandas()
    assert sorted(got.id.dropna().unique()) == [0, 2, 8] and len(got) == 8 and got.id.isna().sum() == 2
    assert whitening.identity_error(df, "v", model) < 1e-12
    for few in (df.filter("false"), df.filter("id = 0"), df.filter("id in (2, 8)"), df.filter("v is null")):
        none = whitening.fit(few, "v", 5)
        assert len(none.values) == 0 and whitening.whiten(few, "id", "v", none).count() == 0 and whitening.identity_error(few, "v", none) is None
    with pytest.raises(Exception, match="different lengths"):
        whitening.fit(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "v array<double>"), "v")
    big = spark.createDataFrame([(1, [4e9, 0.0]), (2, [-4e9, 1.0]), (3, [1.0, 2.0])], "id int, v array<double>")
    model = whitening.fit(big, "v")
    assert whitening.whiten(big, "id", "v", model).filter("deviation is null").count() == 2 * len(model.values)


def grams(text: str | None, n: int = 3) -> set:
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + n]) for k in range(max(len(words) - n + 1, 1))} if words else set()


def components_by_hand(rows: list[tuple], threshold: int = 90) -> list[tuple]:
    sets, root = [grams(t) for _, t in rows], list(range(len(rows)))

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    least: dict[int, int] = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[top(i)] = min(least.get(top(i), key), key)
    return sorted(((key, len(sets[i]), least.get(top(i))) for i, (key, _) in enumerate(rows)), key=str)


def near_copies(draw) -> list[str]:
    words = [f"w{i}" for i in range(300)]
    texts = []
    for size in (11, 12, 21, 30, 60, 150, 400):
        base = draw.choice(words, size).tolist()
        for _ in range(12):
            text = list(base)
            for _ in range(draw.integers(0, 2 + size // 60)):
                text[draw.integers(0, len(text))] = str(draw.choice(words))
            texts.append(" ".join(text[: len(text) - draw.integers(0, 2)]))
    return texts


@pytest.mark.parametrize("block", [1 << 20, 700])
def test_jaccard_components_equal_all_pairs(spark, monkeypatch, block):
    # a small block cuts clusters into slots that are joined with each other
    monkeypatch.setattr(jaccard, "BLOCK", block)
    texts = near_copies(np.random.default_rng(2)) + [None, "", " \n", "one two", "One TWO", "one", "a b c", "a b c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, jaccard.jaccard_components(df, "doc_id", "text").collect()), key=str)
    assert got == components_by_hand(list(enumerate(texts)))


def test_jaccard_query_equals_all_pairs(spark, sf):
    docs = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    got = QUERIES["op13_prefix_tree_join"](spark, sf).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == components_by_hand(docs)


def test_jaccard_of_awkward_tables(spark):
    df = awkward(spark)
    got = sorted(map(tuple, jaccard.jaccard_components(df, "doc_id", "text").collect()), key=str)
    assert got == components_by_hand([tuple(r) for r in df.select("doc_id", "text").collect()])
    assert jaccard.jaccard_components(nothing(spark), "doc_id", "text").collect() == []


def test_a_long_text_has_the_same_shingles(monkeypatch):
    text = " \t" + "One  two\nthree\x0bfour five\r\n" * 300 + "é ß\x1cx\u00a0y "
    want = jaccard.shingles(text)
    assert len(want) == len(grams(text))
    monkeypatch.setattr(jaccard, "LONG", 100)
    monkeypatch.setattr(jaccard, "CHUNK", 7)
    assert (jaccard.shingles(text) == want).all() and not len(jaccard.shingles(" \n" * 80))


def test_signatures_of_linked_sets_meet():
    draw, classes, tested = np.random.default_rng(5), jaccard.Classes(90), 0
    for size in [*range(8, 60), 80, 200, 700, 1500]:
        for _ in range(15):
            base = np.unique(draw.integers(0, 2**64, size, dtype=np.uint64))
            gone = draw.choice(size, draw.integers(0, max(1, size // 9)), replace=False)
            more = draw.integers(0, 2**64, draw.integers(0, max(1, size // 9) + 1), dtype=np.uint64)
            other = np.unique(np.concatenate([np.delete(base, gone), more]))
            both = len(np.intersect1d(base, other))
            if both < max(len(base), len(other)) and 100 * both >= 90 * (len(base) + len(other) - both):
                tested += 1
                assert np.intersect1d(classes.signatures(base), classes.signatures(other)).size
    assert tested > 100


def cosine_by_hand(texts: dict[str, str]) -> dict[str, tuple]:
    """Per file with a notice: license, similarity, and the share of its words in its longest such piece."""
    vectors = licenses.template_terms(licenses.TEMPLATES, licenses.FULL)
    vocabulary = {t for counts in vectors.values() for t in counts}
    words = {f: re.findall("[a-z0-9]+", t.lower()) for f, t in texts.items()}
    having = Counter(t for own in words.values() for t in set(own) & vocabulary)
    weight = {t: 1 + math.log((1 + len(texts)) / (1 + having[t])) for t in vocabulary}

    def vector(counts: Counter) -> dict[str, float]:
        return {t: n * weight.get(t, licenses.OTHER) for t, n in counts.items()}

    def norm(v: dict[str, float]) -> float:
        return math.sqrt(sum(x * x for x in v.values()))

    out = {}
    for file, text in texts.items():
        found = []
        # the texts here have no comments and no stops, so their pieces are lines and the whole
        for piece in {*text.split("\n"), text}:
            terms = re.findall("[a-z0-9]+", piece.lower())
            own = vector(Counter(terms))
            for (name, _, shared), counts in vectors.items():
                other = vector(counts)
                dot = sum(x * other.get(t, 0.0) for t, x in own.items())
                if own and (alike := round(dot / norm(own) / norm(other), 9)) >= licenses.SIMILARITY:
                    found.append((shared, -alike, -len(terms), name))
        if found:
            best = min(found)
            out[file] = best[3], -best[1], max(-f[2] for f in found) / len(words[file])
    return out


def test_licenses_equal_dense_cosines_and_a_walk_up_the_tree(spark):
    draw = random.Random(3)
    stops = [s.rstrip(".") for texts in licenses.TEMPLATES.values() for t in texts for s in re.split(r"(?<=[.!?])\s+", t)]
    stops = [s for s in stops if not re.search(r"[.!?]\s", s) and len(s.split()) > 3]
    rows = {}
    for i in range(160):
        lines = [" ".join(draw.choice(["alpha", "beta", "the", "license", "of", "software", f"w{draw.randrange(99)}"]) for _ in range(draw.randint(1, 14)))]
        for _ in range(draw.choice([0, 0, 1, 2])):
            own = draw.choice(stops).split()
            lines.append(" ".join(w for w in own if draw.random() > 0.1))
        draw.shuffle(lines)
        folder = "/".join(draw.choice("ab") for _ in range(draw.randint(0, 4)))
        rows[f"{folder}/f{i}".lstrip("/")] = "\n".join(lines)
    own = cosine_by_hand(rows)
    holders: dict[str, tuple] = {}
    for file, (name, alike, covered) in own.items():
        if covered >= 0.5:
            at = "/" + file.rpartition("/")[0] + "/" if "/" in file else "/"
            holders[at] = min(holders.get(at, (1, "")), (-alike, name))
    want = {}
    for file in rows:
        at, near = "/" + file.rpartition("/")[0] + "/" if "/" in file else "/", None
        while near is None:
            near = (at, holders[at][1]) if at in holders else None
            if at == "/":
                break
            at = at[:-1].rpartition("/")[0] + "/"
        mine = own.get(file)
        want[file] = (mine[0], mine[1], mine[0], None) if mine else (None, None, near and near[1], near and near[0])
    df = spark.createDataFrame(list(rows.items()), "path string, text string")
    got = licenses.scan(df, "path", "text", F.lit(False), covering=0.5).collect()
    assert len(got) == 160 and sum(r.own_license is not None for r in got) > 20 and sum(r.source_directory is not None for r in got) > 20
    for r in got:
        license_, alike, known, source = want[r.path]
        assert (r.own_license, r.license, r.source_directory) == (license_, known, source), r.path
        assert (r.similarity is None) == (alike is None) and (alike is None or abs(r.similarity - alike) < 1e-6)
