"""Hashes of words and word sequences for a whole Arrow batch, in flat numpy arrays.

Words are read from the bytes of the string column itself; a word's hash adds table values
chosen by byte and place, so it depends on nothing but the word and is the same everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .common import WHITE

HASH_BYTES = 200_000  # bytes of words hashed at a time
_PLACES = 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLE = _scramble(np.arange(1, 256 * _PLACES + 1, dtype=np.uint64) * _MIX)
_SEPARATES = np.zeros(256, bool)
_SEPARATES[list(WHITE.encode())] = True
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32


@dataclass
class Words:
    """Words of consecutive texts. ``first[d]`` to ``first[d + 1]`` are those of text d."""

    data: np.ndarray  # bytes of all texts
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after it
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """One unsigned 64-bit hash per word."""
        sizes = self.end - self.start
        ends = np.cumsum(sizes)
        out = np.empty(len(sizes), np.uint64)
        at = 0
        while at < len(out):  # arrays of numbers per byte are of a bounded size, but for a longer word
            base = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, base + HASH_BYTES, "right")))
            out[at:end] = self._hashes(self.start[at:end], sizes[at:end])
            at = end
        return out

    def _hashes(self, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        byte = self.data[place + np.repeat(start, sizes)].astype(np.int64)
        value = _TABLE[(place % _PLACES) * 256 + byte]
        if sizes.max() > _PLACES:
            value = value * (2 * (place // _PLACES).astype(np.uint64) + np.uint64(1))
        total = np.add.reduceat(value, ends - sizes)
        return _scramble(total + sizes.astype(np.uint64) * _MIX)

    def joined(self) -> tuple[memoryview, np.ndarray]:
        """All words joined by single blanks, and where each begins in that (one more entry
        for the end): words a to b are ``buffer[at[a] : at[b] - 1]``."""
        sizes = self.end - self.start
        ends = np.cumsum(sizes)
        at = np.r_[0, ends + np.arange(1, len(sizes) + 1)]
        inside = ~_SEPARATES[self.data]
        return memoryview(np.insert(self.data[inside], ends, 32).tobytes()), at


#: White space, control characters and ASCII marks: what is left are letters and digits.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def split_words(texts: pa.Array, lower: bool = False, separates: np.ndarray = _SEPARATES) -> Words:
    """Words of a string array without nulls; ``lower`` makes A-Z small first."""
    n = len(texts)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    data = whole[offsets[0] : offsets[-1]] if n else whole[:0]
    offsets = offsets - offsets[0] if n else np.zeros(1, np.int64)
    if lower:
        data = _SMALL[data]
    inside = ~separates[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]  # a text ends a word
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on; the last ``size - 1`` run past the end."""
    padded = np.concatenate([words, np.zeros(size - 1, np.uint64)])
    total = np.zeros(len(words), np.uint64)
    for i in range(size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + padded[i : i + len(words)]
    return _scramble(total)
