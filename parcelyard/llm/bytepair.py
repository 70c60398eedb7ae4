"""Byte-level BPE ids of many texts at once.

Texts are split into the tokenizer's words with array operations; each distinct word
is encoded once by the ``tokenizers`` library and its ids are copied to every place.
Texts the split does not cover (a contraction, the end-of-text string, a letter beyond
U+052F) are encoded whole by the library, so ids always equal the library's.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from types import ModuleType

import numpy as np

from parcelyard.llm.textarrays import _ODD, mixed

#: What the tokenizer's own splitting pattern treats in a special way.
CONTRACTION = re.compile("'(?:s|t|re|ve|m|ll|d)")
LAST_SPLIT = 0x52F
END_OF_TEXT = "<|endoftext|>"
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0)

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
BEYOND = re.compile(f"[^\x00-{chr(LAST_SPLIT)}]")


def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(LAST_SPLIT + 1)]
    found = np.array(table, np.uint8)
    found[list(WHITE_SPACE)] = SPACE
    return found


def word_starts(points: np.ndarray, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the tokenizer's words start in the code points of texts that begin at ``first``.

    A run of letters, of numbers or of other signs is a word and takes one blank before
    it along. White space before that is a word without its last character, which
    stands alone unless it is the blank.
    """
    kind = classes[points]
    space = kind == SPACE
    before = np.empty_like(space)
    before[0], before[1:] = False, space[:-1]
    changed = np.ones(len(points), bool)
    changed[1:] = kind[1:] != kind[:-1]
    blank = np.zeros(len(points), bool)
    blank[1:] = points[:-1] == 0x20
    follows = np.zeros(len(points), bool)
    follows[:-1] = ~space[1:]
    ends = first[1:] - 1
    follows[ends[ends >= 0]] = False
    starts = np.where(space, ~before | follows, np.where(before, ~blank, changed))
    starts[first[:-1]] = True
    return np.flatnonzero(starts)


def kept_encoder(model_json: str) -> Encoder:
    """The encoder of this Python worker, so that later tasks find the words of earlier ones.

    Task functions come by value, and with them fresh globals for each task; a module
    of its own in the worker outlives them.
    """
    home = sys.modules.setdefault("_parcelyard_worker", ModuleType("_parcelyard_worker"))
    encoders = home.__dict__.setdefault("encoders", {})
    name = hash(model_json)
    if name not in encoders:
        encoders.clear()
        encoders[name] = Encoder(model_json)
    return encoders[name]


class Encoder:
    """Ids of texts; remembers the ids of words up to a bound."""

    def __init__(self, model_json: str, most_words: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model_json)
        self.classes = _classes()
        self.most_words = most_words
        # sorted word hashes, and where each word's ids lie in ``flat``
        self.keys = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        whole = [
            i for i, t in enumerate(texts)
            if BEYOND.search(t) or "'" in t and CONTRACTION.search(t) or END_OF_TEXT in t
        ]
        apart = set(whole)
        split = [i for i, t in enumerate(texts) if i not in apart and t]
        counts = np.zeros(len(texts), np.int64)
        parts: dict[int, np.ndarray] = {}
        if split:
            ids, n = self._split([texts[i] for i in split])
            counts[split] = n
            if not whole:
                return ids, counts
            parts = dict(zip(split, np.split(ids, np.cumsum(n)[:-1])))
        for i in whole:
            parts[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
            counts[i] = len(parts[i])
        ordered = [parts[i] for i in sorted(parts)]
        return (np.concatenate(ordered) if ordered else np.zeros(0, np.uint32)), counts

    def _split(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        starts = word_starts(points, self.classes, first)
        length = np.diff(starts, append=len(points))
        place = np.arange(len(points), dtype=np.int32) - np.repeat(starts.astype(np.int32), length)
        value = mixed(points.astype(np.uint64) + np.uint64(1))
        value *= _ODD[place & 4095]
        if length.max() > 4096:
            value = mixed(value + (place >> 12).astype(np.uint64))
        key = np.add.reduceat(value, starts) + length.astype(np.uint64)
        del place, value, points
        distinct, sample, which = np.unique(key, return_index=True, return_inverse=True)
        new = np.flatnonzero(~self._known(distinct))
        at, to = starts[sample[new]], (starts + length)[sample[new]]
        words = [joined[a:b] for a, b in zip(at, to)]
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        self._learn(distinct, new, [encoding.ids for encoding in found])
        spot = np.searchsorted(self.keys, distinct)
        begins, n = self.begins[spot][which], self.sizes[spot][which]
        ends = np.cumsum(n)
        ids = self.flat[np.arange(ends[-1]) - np.repeat(ends - n - begins, n)]
        per_text = np.add.reduceat(n, np.searchsorted(starts, first[:-1]))
        return ids, per_text

    def _known(self, distinct: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(distinct), bool)
        spot = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
        return self.keys[spot] == distinct

    def _learn(self, distinct: np.ndarray, new: np.ndarray, ids: list[list[int]]) -> None:
        """Adds the ids of the words ``distinct[new]``; beyond the bound, only ``distinct`` stays."""
        if len(self.keys) + len(new) > self.most_words:
            spot = np.searchsorted(self.keys, np.delete(distinct, new))
            size = self.sizes[spot]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            places = np.arange(total) - np.repeat(ends - size - self.begins[spot], size)
            self.flat = self.flat[places]
            self.keys, self.begins, self.sizes = self.keys[spot], ends - size, size
        if not len(new):
            return
        size = np.array([len(x) for x in ids], np.int32)
        begin = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, np.array([i for x in ids for i in x], np.uint32)])
        keys = np.concatenate([self.keys, distinct[new]])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.begins = np.concatenate([self.begins, begin])[order]
        self.sizes = np.concatenate([self.sizes, size])[order]
