"""UTF-8 bytes of Arrow text columns as numpy arrays, and hashes of their words.

All word definitions used here split at ASCII bytes only, so they can be
applied to the UTF-8 bytes as they are: a byte of a multi-byte character is
never an ASCII byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once; a longer document makes a block of its own.
BLOCK = 1 << 19

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, every other byte to itself.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its values; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(off: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of values with about ``size`` bytes together."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (shift, multiply, shift, multiply, shift)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 2 * len(_POWERS), 64), _BASE, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


def word_starts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of the words (runs without ASCII white space) and, for each value, the number of its first word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = ~SPACES[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = off[:-1][np.diff(off) > 0]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    return starts, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the A-Z-folded words of the values, and word offsets of the values."""
    starts, of = word_starts(data, off)
    if not len(starts):
        return np.zeros(0, np.uint64), of
    at = np.arange(starts[0], len(data))
    gaps = np.diff(starts, append=len(data))
    at -= np.repeat(starts, gaps)
    tail = data[starts[0] :]
    value = _BYTE[FOLD[tail]]
    value[SPACES[tail]] = 0
    value *= _powers(int(gaps.max()))[at]
    return mixed(np.add.reduceat(value, starts - starts[0])), of
