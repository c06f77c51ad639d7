"""Words of many texts at once, as 64-bit hashes, from the bytes of a text column.

Letters A-Z are lowered. A word's hash is the sum of random numbers of its bytes times powers of an
odd number, modulo 2**64, mixed at the end, so that it comes from differences of one running sum.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CHUNK = 1 << 20
_random = np.random.default_rng(20_240_607)
_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: list[np.ndarray] = []


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    found = np.zeros(256, bool)
    for a, b in ranges:
        found[a : b + 1] = True
    return found


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK)
        _powers[:] = [np.cumprod(np.full(size, x, np.uint64)) for x in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """hash: of every word; ends: where each text's words end in it, from 0; start and stop: bytes of each word."""

    hash: np.ndarray
    ends: np.ndarray
    start: np.ndarray
    stop: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ends)


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> Words:
    """Words are runs of bytes that aren't ``separators``; texts are ``data`` between ``offsets``."""
    n = len(data)
    inside = ~separators[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    found = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(stop, start[i] + CHUNK, "right")))
        a, b = start[i], stop[j - 1]
        power, inverse = _tables(b - a)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_VALUE[data[a:b]] * power[: b - a], out=total[1:])
        found[i:j] = (total[stop[i:j] - a] - total[start[i:j] - a]) * inverse[start[i:j] - a]
        i = j
    return Words(mix(found + (stop - start).astype(np.uint64) * _STEP), np.searchsorted(start, offsets), start, stop)


def grams(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and at which word each begins. A shorter text, if it has words, is one run."""
    total = len(found.hash)
    text = np.repeat(np.arange(len(found.ends) - 1), found.counts)
    fits = np.arange(total) + size <= found.ends[1:][text]
    begin = np.flatnonzero(fits)
    hashes = _run(found.hash, begin, size)
    short = np.flatnonzero((found.counts > 0) & (found.counts < size))
    if len(short):
        parts, firsts = [hashes], [begin]
        for length in np.unique(found.counts[short]).tolist():
            at = found.ends[:-1][short[found.counts[short] == length]]
            parts.append(_run(found.hash, at, length))
            firsts.append(at)
        hashes, begin = np.concatenate(parts), np.concatenate(firsts)
        order = np.argsort(begin, kind="stable")
        hashes, begin = hashes[order], begin[order]
    return hashes, begin


def _run(hashes: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    total = np.full(len(begin), np.uint64(size))
    for i in range(size):
        total = mix(total * _STEP + hashes[begin + i])
    return total
