"""N-grams of a batch of texts, interned in an open-addressed table of numpy arrays.

Words are runs of bytes that are 0-9, a-z (A-Z in lower case) or beyond ASCII. An n-gram
is a run of words with one space between them. Its key is the 64-bit xxHash of its bytes;
keys that meet in a slot are told apart by comparing the bytes themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

from parcelyard.llm import textarrays as ta

_U = np.uint64
_LETTER = np.zeros(256, bool)
_LETTER[0x30:0x3A] = _LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True

#: The five primes of the 64-bit xxHash (fixed values).
P1, P2, P3, P4, P5 = (
    _U(0x9E3779B185EBCA87),
    _U(0xC2B2AE3D27D4EB4F),
    _U(0x165667B19E3779F9),
    _U(0x85EBCA77C2B2AE63),
    _U(0x27D4EB2F165667C5),
)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


def _lanes(data: np.ndarray, spare: int = 8) -> np.ndarray:
    """The little-endian 64-bit number that starts at every byte of ``data``."""
    padded = np.concatenate([data, np.zeros(spare, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))


def hashes(data: np.ndarray, lanes: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """xxHash (seed 0) of the byte strings of ``data`` at ``begin``, one length at a time.

    Strings of 32 bytes and more take the library's stripes, one call each.
    """
    out = np.empty(len(begin), np.uint64)
    order = np.argsort(np.minimum(length, 32).astype(np.int8), kind="stable")
    cuts = np.searchsorted(length[order], np.arange(33))
    for size in range(32):
        at = order[cuts[size] : cuts[size + 1]]
        if not len(at):
            continue
        place = begin[at]
        h = np.full(len(at), P5 + _U(size))
        left = size
        while left >= 8:
            h ^= _turned(lanes[place] * P2, 31) * P1
            h = _turned(h, 27) * P1 + P4
            place, left = place + 8, left - 8
        if left >= 4:
            h ^= (lanes[place] & _U(0xFFFFFFFF)) * P1
            h = _turned(h, 23) * P2 + P3
            place, left = place + 4, left - 4
        while left:
            h ^= data[place].astype(np.uint64) * P5
            h = _turned(h, 11) * P1
            place, left = place + 1, left - 1
        h = (h ^ (h >> _U(33))) * P2
        h = (h ^ (h >> _U(29))) * P3
        out[at] = h ^ (h >> _U(32))
    raw = memoryview(np.ascontiguousarray(data))
    for i in order[cuts[32] :]:
        out[i] = xxhash.xxh64_intdigest(raw[begin[i] : begin[i] + length[i]])
    return out


def _same_bytes(lanes: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the strings of ``length`` at ``a`` and ``b`` agree in every byte."""
    same = np.ones(len(a), bool)
    left, at = length.copy(), np.arange(len(a))
    step = 0
    while len(at):
        differ = lanes[a[at] + step] ^ lanes[b[at] + step]
        part = np.minimum(left[at], 8)
        mask = np.where(part == 8, ~_U(0), (_U(1) << (part.astype(np.uint64) * _U(8) & _U(63))) - _U(1))
        same[at] &= (differ & mask) == 0
        left[at] -= 8
        at = at[(left[at] > 0) & same[at]]
        step += 8
    return same


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()


def _zeros_tables(bits: int = 32) -> np.ndarray:
    """What 2^k zero bytes do to a checksum, for each of its four bytes."""
    place = np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8)
    state = np.arange(256, dtype=np.uint32)[None, :] << place
    tables = [_CRC[state & 255] ^ (state >> np.uint32(8))]
    for _ in range(bits - 1):
        tables.append(_moved(tables[-1], tables[-1]))
    return np.array(tables)


def _moved(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (
        table[0][crc & 255]
        ^ table[1][(crc >> np.uint32(8)) & 255]
        ^ table[2][(crc >> np.uint32(16)) & 255]
        ^ table[3][crc >> np.uint32(24)]
    )


_ZEROS = _zeros_tables()


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums of strings put together, from those of both parts and the second's length."""
    crc, k = first.copy(), 0
    left = length.copy()
    while left.any():
        odd = np.flatnonzero(left & 1)
        crc[odd] = _moved(_ZEROS[k], crc[odd])
        left >>= 1
        k += 1
    return crc ^ second


def crcs(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The 32-bit checksum (as in zlib) of the byte strings at ``begin``."""
    crc = np.full(len(begin), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-length, kind="stable")
    place, ends = begin[order], -length[order]
    state = crc[order]
    n, step = int(np.searchsorted(ends, 0)), 0
    while n:
        state[:n] = _CRC[(state[:n] ^ data[place[:n] + step]) & 255] ^ (state[:n] >> np.uint32(8))
        step += 1
        n = int(np.searchsorted(ends, -step))
    crc[order] = state
    return ~crc


_SPACE_CRC = crcs(np.array([0x20], np.uint8), np.zeros(1, np.int64), np.ones(1, np.int64))[0]


@dataclass(frozen=True)
class Words:
    """Words in lower case with a space after each; those of unit i are first[i]:first[i+1]."""

    data: np.ndarray
    begin: np.ndarray
    length: np.ndarray
    first: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray = _LETTER) -> Words:
    """The words of the texts at ``offsets`` of ``data``; none goes across two texts."""
    inside = letters[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    opens[cuts] |= inside[cuts]
    closes[cuts - 1] |= inside[cuts - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    length = end - start
    begin = np.cumsum(length + 1) - (length + 1)
    out = np.full(int(length.sum()) + len(length), 0x20, np.uint8)
    chars = ta.lower(data[inside])
    out[np.arange(len(chars)) + np.repeat(np.arange(len(length)), length)] = chars
    return Words(out, begin, length, np.searchsorted(start, offsets))


@dataclass(frozen=True)
class NGrams:
    """Occurrences of n-grams and the table that interns them.

    ``text`` and ``slot`` have one value per occurrence; ``count`` and ``bucket`` one per
    slot of the table, 0 where a slot is empty.
    """

    text: np.ndarray
    slot: np.ndarray
    count: np.ndarray
    bucket: np.ndarray


def intern(found: Words, most: int, buckets: int, lead: np.ndarray) -> NGrams:
    """All runs of 1 to ``most`` words, but those that end in the first ``lead[i]`` of text i."""
    n = len(found.begin)
    text = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    own = np.arange(n) - found.first[text] >= lead[text]
    head, tail = [], []
    for size in range(1, most + 1):
        last = np.arange(size - 1, n)
        last = last[(text[last] == text[last - size + 1]) & own[last]]
        head.append(last - size + 1)
        tail.append(last)
    head, tail = np.concatenate(head), np.concatenate(tail)
    begin = found.begin[head]
    length = found.begin[tail] + found.length[tail] - begin
    lanes = _lanes(found.data)
    key = hashes(found.data, lanes, begin, length)

    size = 1 << max(int(2 * len(key)).bit_length(), 4)
    mask = size - 1
    owner = np.full(size, -1, np.int64)
    slot = np.empty(len(key), np.int64)
    at = (key & _U(mask)).astype(np.int64)
    open_ = np.arange(len(key))
    while len(open_):
        probe = at[open_]
        free = owner[probe] < 0
        owner[probe[free][::-1]] = open_[free][::-1]
        held = owner[probe]
        same = (key[held] == key[open_]) & (length[held] == length[open_])
        checked = np.flatnonzero(same & (held != open_))
        same[checked] = _same_bytes(
            lanes, begin[held[checked]], begin[open_[checked]], length[open_[checked]]
        )
        slot[open_[same]] = probe[same]
        open_ = open_[~same]
        at[open_] = (at[open_] + 1) & mask

    used = np.flatnonzero(owner >= 0)
    one = owner[used]
    word_crc = crcs(found.data, found.begin, found.length)
    space_crc = joined_crc(word_crc, np.full(n, _SPACE_CRC), np.ones(n, np.int64))
    crc, upto = word_crc[head[one]], head[one].copy()
    crc_space = space_crc[head[one]]
    for _ in range(most - 1):
        more = np.flatnonzero(upto < tail[one])
        upto[more] += 1
        crc[more] = joined_crc(crc_space[more], word_crc[upto[more]], found.length[upto[more]])
        crc_space[more] = joined_crc(
            crc_space[more], space_crc[upto[more]], found.length[upto[more]] + 1
        )
    bucket = np.zeros(size, np.int64)
    bucket[used] = crc % buckets
    return NGrams(text[tail], slot, np.bincount(slot, minlength=size), bucket)
