"""Hashes of words and n-grams over slices of UTF-8 text, as whole-array arithmetic modulo 2**64."""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the input spread over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BYTE_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _powers[k] = np.multiply.accumulate(row)
    return _powers[0][:n], _powers[1][:n]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): bytes of every word of the documents at ``offsets``, and the words before each document."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def grams(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n values in a row."""
    count = len(values) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    # doubling: hashes of 1, 2, 4, ... values, put together for the bits of n
    h, length, out, taken = values.astype(np.uint64), 1, None, 0
    while True:
        if n & length:
            part = h[taken : taken + count]
            out = part.copy() if out is None else out * _STEP ** np.uint64(length) + part
            taken += length
        length *= 2
        if length > n:
            return mixed(out)
        half = length // 2
        h = h[:-half] * _STEP ** np.uint64(half) + h[half:]


def sums(values: np.ndarray, first: np.ndarray, short: int = 0) -> np.ndarray:
    """Sum of the values of every group; groups start at ``first`` (one more than groups), each without its last ``short``."""
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    end = np.clip(first[1:] - short, first[:-1], len(values))
    start = np.minimum(first[:-1], len(values))
    return total[np.maximum(end, start)] - total[start]
