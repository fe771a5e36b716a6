"""Fingerprints of words and word windows, computed on whole blocks of texts at once."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def chain(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """The fingerprint of the pair (a, b); the order matters."""
    return mix(a * _BASE + mix(b + _U(salt)))


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (in bytes) of the words of each row, and the index of each row's first
    word (one entry more than rows)."""
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], word[:-1])) if len(word) else word
    after = np.concatenate((word[1:], [False])) if len(word) else word
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """One fingerprint for each word; ``lower`` takes A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    letters = data[np.repeat(starts, lengths) + within]
    powers = np.full(int(lengths.max()), _BASE)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    value = np.add.reduceat(_BYTE[_LOWER[letters] if lower else letters] * powers[within], first)
    return mix(value + lengths.astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts[i]`` places of row i: the row and the place within it."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
