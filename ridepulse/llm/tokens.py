"""Token ids of whole texts with the tokenizers library, as little-endian unsigned 32-bit integers.

The pattern of byte-level BPE lets no piece reach across a space that follows a visible character, so the words
between such spaces encode separately. Arrow numbers the distinct words of some texts. A word of letters and ASCII
characters is cut on where letters begin or end, which the pattern does too; words with an apostrophe or the start of
an added token are not. The library encodes each distinct part once per worker, as long as the cache lasts, and parts that
are letters go to its model alone, as there is nothing left to cut. The ids of a text are those the library gives for the
whole text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from .words import GROUP, WORD_END, byte_of_character, byte_words, groups, word_lists

#: Texts are taken apart in slices of about so many characters.
SLICE = 1 << 21
#: Texts are encoded together up to so many bytes; the more, the fewer words are looked up again.
TOGETHER = 1 << 23
#: The parts looked up last are cached, so many characters of them; longer parts are encoded each time.
CACHED_CHARS, LONGEST_CACHED = 4_000_000, 64
#: Parts are not looked up in a cache of more than so many times their number.
FEW = 100
#: How byte-level vocabularies write a space (fixed value).
SPACE_BYTE = "Ġ"
#: Latin, Greek and Cyrillic letters, in ranges without another character.
LETTERS = "".join(chr(c) for a, z in ("AZ", "az", "ÀÖ", "Øö", "øɏ", "αω", "Ѐҁ") for c in range(ord(a), ord(z) + 1))
#: The other visible characters of ASCII at which a word may be cut; an apostrophe may begin a contraction.
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalpha() and c != "'")


def slices(text: str) -> Iterator[str]:
    """A long text in parts of about a million characters that encode separately."""
    at = 0
    while len(text) - at > SLICE and (cut := WORD_END.search(text, at + SLICE)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def _cut(data: pa.Buffer, bounds: np.ndarray) -> pa.Array:
    """The bytes between neighbouring bounds."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), data])


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            rule = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        cut, added = rule["pre_tokenizer"] or {}, rule["added_tokens"]
        self.by_word = (
            rule["normalizer"] is None
            and cut.get("type") == "ByteLevel"
            and not cut.get("add_prefix_space")
            and cut.get("use_regex", True)
            and not any(" " in token["content"] or token.get("lstrip") or token.get("rstrip") for token in added)
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if SPACE_BYTE in token]] = True
        self.bytes = {byte: character for character, byte in byte_of_character().items()}
        starts = {token["content"][:1] for token in added}
        letters, marks = (re.escape("".join(c for c in known if c not in starts)) for known in (LETTERS, MARKS))
        self.run = re.compile(f" ?[{letters}]+").fullmatch
        self.plain = re.compile(f"[{letters}{marks}]+").fullmatch
        self.lines = re.compile(f"(?:[{letters}{marks}]+\n)+[{letters}{marks}]+").fullmatch
        self.cut = re.compile(f" ?(?:[{letters}]+|[^{letters} ]+)").findall
        # parts seen lately, the latest first, and their ids
        self.parts, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _runs(self, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of parts that are letters, after a space or not, from the model; the pattern keeps them whole."""
        model = self.model.tokenize
        for at in range(0, len(parts), GROUP):
            written = "\n".join(parts[at : at + GROUP]).encode().decode("latin-1").translate(self.bytes).split(self.bytes[ord("\n")])
            found = [[token.id for token in model(part)] for part in written]
            yield np.array([i for ids in found for i in ids], "<u4"), np.array([len(ids) for ids in found], np.int64)

    def _learn(self, parts: list[str]) -> tuple[pa.Array, pa.Array]:
        """The parts in some order, and the ids of each."""
        run = [self.run(part) is not None for part in parts]
        order = list(compress(parts, run))
        found = [(np.zeros(0, "<u4"), np.zeros(0, np.int64)), *self._runs(order)]
        if len(order) < len(parts):
            others, *rest = byte_words(self, [part for part, letters in zip(parts, run) if not letters])
            order += others
            found.append(rest)
        ids, counts = map(np.concatenate, zip(*found))
        return pa.array(order, pa.string()), _cut(pa.py_buffer(ids.astype("<u4").tobytes()), 4 * np.concatenate([[0], np.cumsum(counts)]))

    def _look(self, parts: pa.Array) -> pa.Array:
        """The ids of parts, each as if it were a text of its own; those in the cache are not encoded again."""
        numbered = parts.dictionary_encode()
        if FEW * len(numbered.dictionary) < len(self.parts):
            # so few are encoded faster than the cache is read
            order, learned = self._learn(numbered.dictionary.to_pylist())
            return learned.take(pc.index_in(numbered.dictionary, value_set=order)).take(numbered.indices)
        known = pc.index_in(numbered.dictionary, value_set=self.parts)
        new = numbered.dictionary.filter(known.is_null())
        order, learned = self._learn(new.to_pylist())
        names, ids = pa.concat_arrays([self.parts, order]), pa.concat_arrays([self.ids, learned])
        at = known.fill_null(-1).to_numpy().copy()
        at[at < 0] = len(self.parts) + pc.index_in(new, value_set=order).to_numpy()
        # the cache begins with these parts, those of the lookup before follow
        older = np.ones(len(names), bool)
        older[at] = False
        latest = np.concatenate([at, np.flatnonzero(older)])
        chars = pc.utf8_length(names).to_numpy()[latest]
        latest, chars = latest[chars <= LONGEST_CACHED], chars[chars <= LONGEST_CACHED]
        kept = pa.array(latest[: np.searchsorted(np.cumsum(chars), CACHED_CHARS, "right")])
        self.parts, self.ids = names.take(kept), ids.take(kept)
        return ids.take(pa.array(at)).take(numbered.indices)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; null counts as empty."""
        if not self.by_word:
            return [self.whole(text or "") for text in texts.to_pylist()]
        words, codes, starts = word_lists(texts)
        # the first word of a text follows no space
        heads = [words[i] for i in codes[starts[:-1]].tolist()]
        firsts = {word: i for i, word in enumerate(dict.fromkeys(heads))}
        plain, lines = self.plain, self.lines
        apart = [i for i, word in enumerate(words) if not plain(word) and not lines(word)]
        kept = np.ones(len(words), bool)
        kept[apart] = False
        known = list(compress(words, kept.tolist()))
        parts = self.cut(" " + " ".join(known)) if known else []
        begins = [i for i, part in enumerate(parts) if part[0] == " "]
        if len(begins) != len(known):
            raise ValueError("words are not kept apart")
        begins += range(len(parts), len(parts) + len(apart) + len(firsts) + 1)
        parts += [" " + words[i] for i in apart] + list(firsts)
        place = np.empty(len(words), np.int32)
        place[kept], place[apart] = np.arange(len(known)), len(known) + np.arange(len(apart))
        order = place[codes]
        order[starts[:-1]] = [len(words) + firsts[word] for word in heads]
        # the strings are let go before their ids are worked out
        parts = pa.array(parts, pa.string())
        del words, known, heads, firsts
        # the parts of a word are next to each other, so its ids are
        _, offsets, data = self._look(parts).buffers()
        ids = _cut(data or pa.py_buffer(b""), np.frombuffer(offsets, np.int32)[begins])
        _, offsets, data = ids.take(pa.array(order)).buffers()
        ends, raw = np.frombuffer(offsets, np.int32)[starts].tolist(), memoryview(data or b"")
        return [bytes(raw[a:b]) for a, b in zip(ends, ends[1:])]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(path: str, texts: pa.Array) -> Iterator[bytes]:
    """The ids of every text in order; null counts as empty. Holds some texts or about a slice of a long one at a time."""
    tool = encoder(path)
    for first, end in groups(texts, TOGETHER):
        some = texts.slice(first, end - first)
        if end - first == 1 and len(text := some[0].as_py() or "") > SLICE:
            yield b"".join(tool.encode(pa.array([piece], pa.string()))[0] for piece in slices(text))
        else:
            found = tool.encode(some)
            # an executor's workers share its memory, so what Arrow would keep for its next arrays goes back
            pa.default_memory_pool().release_unused()
            yield from found
