"""Word and shingle hashes of whole text columns, by array operations on their UTF-8 bytes.

A word is a longest run of bytes other than space and \\x09-\\x0D, with A-Z in lower case. Its hash is a
polynomial over random byte values modulo 2^64, read off running sums, and then scrambled.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

_STEP = 1 << 20
_GOLDEN = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1


def scramble(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit values that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=None)
def _byte_values() -> np.ndarray:
    lower = np.arange(256)
    lower[65:91] += 32
    return scramble((lower.astype(np.uint64) + np.uint64(1)) * np.uint64(_GOLDEN))


@lru_cache(maxsize=None)
def _separators(letters_only: bool) -> np.ndarray:
    """True for bytes between words: white space or, with ``letters_only``, all ASCII but letters and digits."""
    sep = np.zeros(256, bool)
    if letters_only:
        sep[:128] = True
        for a, b in ((48, 58), (65, 91), (97, 123)):
            sep[a:b] = False
    else:
        sep[9:14] = True
        sep[32] = True
    return sep


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``n`` at least."""
    size = max(_STEP * 2, 1 << max(n, 1).bit_length())
    if not _powers or next(iter(_powers)) < n:
        _powers.clear()
        tables = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, np.uint64(base))
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers[size] = tables[0], tables[1]
    return next(iter(_powers.values()))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; a null is an empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of some texts: hashes, places of the first byte and after the last, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, letters_only: bool = False):
        sep = _separators(letters_only)
        parts = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
        a = 0
        while a < data.size:
            b = min(data.size, a + _STEP)
            while b < data.size and not sep[data[b]]:  # a part ends at a gap between words
                gap = np.flatnonzero(sep[data[b : b + _STEP]])
                b = b + int(gap[0]) if gap.size else min(data.size, b + _STEP)
            parts.append(self._part(data, offsets, a, b, sep))
            a = b
        self.hashes, self.starts, self.ends = (np.concatenate(x) for x in zip(*parts))
        self.first = np.searchsorted(self.starts, offsets)

    @staticmethod
    def _part(data, offsets, a, b, sep):
        x = data[a:b]
        word = ~sep[x]
        edge = np.zeros(x.size + 1, bool)
        edge[offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b, "right")] - a] = True
        edge[0] = edge[-1] = True
        before = np.empty(x.size, bool)
        before[0], before[1:] = False, word[:-1]
        after = np.empty(x.size, bool)
        after[-1], after[:-1] = False, word[1:]
        s = np.flatnonzero(word & (~before | edge[:-1]))
        e = np.flatnonzero(word & (~after | edge[1:])) + 1
        power, inverse = _powers_to(x.size)
        sums = np.zeros(x.size + 1, np.uint64)
        np.cumsum(_byte_values()[x] * power[: x.size], out=sums[1:])
        h = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(_GOLDEN)
        return scramble(h), s + a, e + a


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` words in a row in each text and the first shingle of each text.

    A text of fewer words has its whole sequence as one shingle, and one without words has none.
    """
    count = np.diff(first)
    shingles = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    out = np.concatenate(([0], np.cumsum(shingles)))
    start = np.repeat(first[:-1] - out[:-1], shingles) + np.arange(out[-1])
    end = np.minimum(start + k, np.repeat(first[1:], shingles))
    h = (end - start).astype(np.uint64)
    for j in range(k):
        at = start + j
        there = at < end
        h = h * np.uint64(_BASE) + np.where(there, hashes[np.where(there, at, 0)] if hashes.size else 0, 0).astype(np.uint64)
    return scramble(h), out
