"""Texts of an Arrow batch as numpy arrays: words, word hashes and word windows.

A word is a run of bytes other than white space (0x20, 0x09-0x0D), so words of any
script are found in UTF-8 directly. Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is a piece by itself.
PIECE_BYTES = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_ODD = mixed(np.arange(1001, 1001 + 4096, dtype=np.uint64)) | _U(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, nulls as empty, and where each text starts and ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes, as first and last (exclusive) index."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


@dataclass(frozen=True)
class Words:
    """Words of some texts in order; ``first[i]:first[i + 1]`` are those of text ``i``."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(data: np.ndarray, offsets: np.ndarray, in_lower: bool = False) -> Words:
    """Words of the texts at ``offsets`` of ``data``, in lower case (A-Z) if asked."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    inside = ~_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    opens[cuts] |= inside[cuts]
    closes[cuts - 1] |= inside[cuts - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(start, offsets)
    if not len(start):
        return Words(start, end, np.zeros(0, np.uint64), first)
    chars = data[inside]
    if in_lower:
        chars = lower(chars)
    length = end - start
    begins = np.cumsum(length) - length
    place = np.arange(len(chars)) - np.repeat(begins, length)
    value = _BYTE[chars] * _ODD[place & 4095]
    if length.max() > 4096:  # the table of factors repeats; a scrambled block number parts them
        value = mixed(value + (place >> 12).astype(np.uint64))
    total = np.add.reduceat(value, begins)
    return Words(start, end, mixed(total + length.astype(np.uint64)), first)


def windows(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and where those of each text start.

    A text of fewer words, but at least one, is one run of all its words.
    """
    n, counts = len(found.hash), np.diff(found.first)
    total = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size):
        total += found.hash[k : k + len(total)] * _ODD[k]
    text = found.text
    whole = text[size - 1 :] == text[: len(total)] if len(total) else np.zeros(0, bool)
    runs = mixed(total[whole])
    per_text = np.maximum(counts - size + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        made = np.array(
            [
                np.sum(found.hash[found.first[i] : found.first[i + 1]] * _ODD[: counts[i]])
                + _U(counts[i])
                for i in short
            ],
            np.uint64,
        )
        at = np.cumsum(per_text)[short] - per_text[short]
        runs = np.insert(runs, at, mixed(mixed(made)))
        per_text[short] = 1
    return runs, np.concatenate([[0], np.cumsum(per_text)])


def segment_min(values: np.ndarray, first: np.ndarray, empty: int) -> np.ndarray:
    """The least value of each segment; ``empty`` where a segment has none."""
    out = np.full(len(first) - 1, empty, values.dtype)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.minimum.reduceat(values, first[full])
    return out


def sequence_hash(found: Words, seed: int) -> np.ndarray:
    """A 64-bit hash of each text's word sequence; texts without words are alike."""
    factor = _ODD[seed & 4095]
    place = np.arange(len(found.hash)) - np.repeat(found.first[:-1], np.diff(found.first))
    value = mixed(found.hash * factor + place.astype(np.uint64))
    out = np.zeros(len(found.first) - 1, np.uint64)
    full = np.flatnonzero(np.diff(found.first))
    if len(full):
        out[full] = np.add.reduceat(value, found.first[full])
    return mixed(out + _U(seed))
