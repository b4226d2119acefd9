"""Words of a block of texts as numpy arrays: positions, 64-bit hashes and hashes of word windows.

A word is a maximal run of characters other than blank, tab, line feed, vertical tab, form feed and carriage return.
All of these are single bytes in UTF-8, so a block is handled as bytes. A null text has no words.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_IS_WORD = ~_SPACE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
# Little-endian masks that keep the first 0 to 8 bytes of an 8-byte load.
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)

_ODD1, _ODD2, _ODD3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))
# Slices of more bytes are hashed one by one.
LONG_SLICE = 4096
_S32, _S29 = np.uint64(32), np.uint64(29)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output."""
    x = x ^ (x >> _S32)
    x *= _ODD2
    x ^= x >> _S29
    x *= _ODD1
    x ^= x >> _S32
    return x


@dataclass
class Texts:
    """UTF-8 bytes of a block of texts; text ``i`` is ``data[at[i]:at[i + 1]]``."""

    data: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, column: pa.Array | pa.ChunkedArray) -> Texts:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column, "").cast(pa.large_string())
        at = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[at[0]: at[-1]] if raw is not None and len(at) else np.zeros(0, np.uint8)
        return cls(data, at - at[0] if len(at) else np.zeros(1, np.int64))

    def lower_ascii(self) -> Texts:
        return Texts(_LOWER[self.data], self.at)

    def __len__(self) -> int:
        return len(self.at) - 1


@dataclass
class Words:
    """Words of a block: byte bounds, and the first word of each text (``first`` has one entry more than texts)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def place(self) -> np.ndarray:
        """Place of each word within its text."""
        return np.arange(len(self.start)) - np.repeat(self.first[:-1], self.counts)


def words_of(texts: Texts) -> Words:
    word = _IS_WORD[texts.data]
    n = len(word)
    border = np.zeros(n + 1, bool)
    border[texts.at] = True
    begins, ends = word.copy(), word.copy()
    if n:
        begins[1:] &= ~word[:-1] | border[1:n]
        ends[:-1] &= ~word[1:] | border[1:n]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, texts.at))


def slice_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte slice, eight bytes a step; slices that are done leave the loop."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    length = end - start
    out = mix(length.astype(np.uint64) + _ODD3)
    for k in np.flatnonzero(length > LONG_SLICE).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[start[k]: end[k]], digest_size=8).digest(), "little")
    todo = np.flatnonzero(length <= LONG_SLICE)
    at, left = start[todo], length[todo]
    while len(todo):
        value = eight[at] & _MASKS[np.minimum(left, 8)]
        out[todo] = mix(out[todo] * _ODD3 ^ value)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return out


def word_hashes(texts: Texts, words: Words) -> np.ndarray:
    return slice_hashes(texts.data, words.start, words.end)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` consecutive words from each word on; the caller drops windows that cross texts."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out *= _ODD3
        out += hashes[k: k + n]
    return mix(out)


def starts_of_windows(words: Words, size: int) -> np.ndarray:
    """Words at which a window of ``size`` words of one text starts."""
    if not len(words.start):
        return np.zeros(0, np.int64)
    room = np.repeat(words.first[1:], words.counts) - np.arange(len(words.start))
    return np.flatnonzero(room >= size)


def covered(size: int, n: int, starts: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``size`` words from one of ``starts``."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + size, n), -1)
    return np.cumsum(steps[:-1]) > 0
