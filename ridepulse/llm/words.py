"""Distinct words of many texts and their ids, for tokenizers that keep words apart.

Arrow cuts the texts and numbers their distinct words; a tokenizer encodes each distinct word once, as long as the word cache
lasts, and the ids of a text are gathered from those of its words.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

if TYPE_CHECKING:
    from .tokens import Encoder

#: A space that ends a word: the character before it is visible.
WORD_END = re.compile(r"(?<=\S) ")
#: Words handed to the library at once.
GROUP = 1000
#: The cache of words starts anew when it has so many characters.
CACHED_CHARS = 6_000_000


def word_lists(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of the texts, the word numbers of all texts one after another, and where each text starts.

    Words are what the spaces that follow a visible character separate; a text of no characters is one empty word, and
    null counts as empty. Only texts in which some space does not follow a visible character are cut one by one.
    """
    lists = pc.split_pattern(pc.fill_null(texts.cast(pa.string()), ""), " ")
    if len(lists) != len(texts) or lists.offset:
        lists = pa.concat_arrays([lists])
    starts = lists.offsets.to_numpy()
    numbered = lists.values.slice(starts[0] if len(starts) else 0).dictionary_encode()
    words, codes, starts = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy(), starts - (starts[0] if len(starts) else 0)
    ends = pc.utf8_slice_codeunits(numbered.dictionary, -1).dictionary_encode()
    blank = np.array([not c or c.isspace() for c in ends.dictionary.to_pylist()], bool)[ends.indices.to_numpy()]
    odd = blank[codes]
    odd[starts[1:] - 1] = False  # no space follows the last word
    if odd.any():
        at = np.unique(np.searchsorted(starts, np.flatnonzero(odd), "right") - 1)
        order = np.arange(len(texts))
        order[at] = len(texts) + np.arange(len(at))
        cut = pa.array([WORD_END.split(texts[int(i)].as_py()) for i in at], lists.type)
        lists = pa.concat_arrays([lists, cut]).take(pa.array(order))
        starts = lists.offsets.to_numpy()
        numbered = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
        words, codes, starts = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy(), starts - starts[0]
    return words, codes, starts


def byte_of_character() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: visible Latin-1 as itself, the rest from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordCache:
    """The ids of words under one or more tokenizers, each one after another in an array.

    ``learn`` gives new words in some order and, for each tokenizer, their ids and how many each word has.
    """

    def __init__(self, learn: Callable[[list[str]], tuple[list[str], list[tuple[np.ndarray, np.ndarray]]]], tokenizers: int = 1):
        self.learn, self.tokenizers = learn, tokenizers
        self._clear()

    def _clear(self) -> None:
        self.where: dict[str, int] = {}
        self.chars = 0
        self.ids = [np.zeros(0, "<u4") for _ in range(self.tokenizers)]
        self.starts = [np.zeros(1, np.int64) for _ in range(self.tokenizers)]

    def look(self, words: list[str]) -> np.ndarray:
        """The numbers of words in the cache; valid until the cache is trimmed."""
        where = self.where
        found = list(map(where.get, words))
        new = {w for w, i in zip(words, found) if i is None}
        if new:
            added, sides = self.learn(list(new))
            where.update(zip(added, range(len(where), len(where) + len(added))))
            for k, (ids, counts) in enumerate(sides):
                self.ids[k] = np.concatenate([self.ids[k], ids])
                self.starts[k] = np.concatenate([self.starts[k], self.starts[k][-1] + np.cumsum(counts)])
            self.chars += len("".join(added))
            found = list(map(where.__getitem__, words))
        return np.array(found, np.int64)

    def gather(self, index: np.ndarray, tokenizer: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a row of words, and where each word's ids start among them."""
        begins = self.starts[tokenizer]
        counts = begins[index + 1] - begins[index]
        starts = np.concatenate([[0], np.cumsum(counts)])
        return self.ids[tokenizer][np.repeat(begins[index] - starts[:-1], counts) + np.arange(starts[-1])], starts

    def trim(self) -> None:
        if self.chars > CACHED_CHARS:
            self._clear()


def byte_words(encoder: Encoder, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words in some order, their ids and how many each has. Those that start with their only space are joined; a token that holds a space starts one."""
    joined = [w for w in words if w[:1] == " " and len(w) > 1 and not w[-1].isspace() and w.rfind(" ") == 0]
    alone = list(set(words).difference(joined)) if len(joined) < len(words) else []
    ids, counts = [], []
    for at in range(0, len(joined), GROUP):
        group = joined[at : at + GROUP]
        ids.append(np.array(encoder.tokenizer.encode_batch_fast(["".join(group)], add_special_tokens=False)[0].ids, "<u4"))
        starts = np.flatnonzero(encoder.spaced[ids[-1]])
        if len(starts) != len(group):
            raise ValueError("the vocabulary does not keep words apart")
        counts.append(np.diff(starts, append=len(ids[-1])))
    for at in range(0, len(alone), GROUP):
        found = [e.ids for e in encoder.tokenizer.encode_batch_fast(alone[at : at + GROUP], add_special_tokens=False)]
        ids.append(np.array([i for part in found for i in part], "<u4"))
        counts.append(np.array([len(part) for part in found], np.int64))
    return joined + alone, np.concatenate(ids), np.concatenate(counts)


def groups(texts: pa.Array, size: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together hold about a slice, where a longer text stands alone."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    first, held = 0, 0
    for at, n in enumerate(lengths.tolist()):
        if held and held + n > size:
            yield first, at
            first, held = at, 0
        held += n
    if first < len(lengths):
        yield first, len(lengths)
