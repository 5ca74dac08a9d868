"""Hashes of words and of runs of words, computed for whole texts at once with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from quarry.llm.common import word_bounds

_U = np.uint64
_ODD, _INVERSE_BITS = 0x9E3779B97F4A7C15, 1 << 64
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse mod 2**64, grown as needed."""
    while len(_powers[0]) < n:
        size = len(_powers[0])
        for i, base in enumerate((_ODD, pow(_ODD, -1, _INVERSE_BITS))):
            _powers[i] = np.concatenate((_powers[i], _powers[i] * _U(pow(base, size, _INVERSE_BITS))))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def byte_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What :func:`range_hashes` needs of a text's bytes, computed once for all of its ranges."""
    power, inverse = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum((raw.astype(_U) + _U(1)) * power[:len(raw)], out=sums[1:])
    return sums, inverse


def range_hashes(sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of bytes, which depends on its bytes alone."""
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, which depends on its bytes alone."""
    return range_hashes(*byte_sums(raw), starts, ends) if len(starts) else np.zeros(0, _U)


def run_hashes(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``length`` consecutive words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.full(n, (seed * 0x9E3779B97F4A7C15 + length) % _INVERSE_BITS, _U)
    for i in range(length):
        out = out * _U(0xD6E8FEB86659FD93) + words[i:i + n]
    return mix(out)


def text_pieces(text: bytes, word_byte: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, bytes) of a whole text in pieces of about ``size`` bytes that end between words."""
    raw = np.frombuffer(text, np.uint8)
    lo = 0
    while lo < len(raw):
        hi = min(len(raw), lo + size)
        while hi < len(raw) and word_byte[raw[hi]]:
            hi += 1
        yield lo, raw[lo:hi]
        lo = hi


def hashed_words(text: bytes, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends) of all words of a whole text."""
    parts = []
    for lo, raw in text_pieces(text, word_byte):
        starts, ends = word_bounds(raw, word_byte)
        parts.append((word_hashes(raw, starts, ends), starts + lo, ends + lo))
    if not parts:
        none = np.zeros(0, np.int64)
        return np.zeros(0, _U), none, none
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))
