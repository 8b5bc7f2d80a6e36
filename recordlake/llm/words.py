"""Words of a text, and hashes of words and of runs of words for whole batches."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split`` without an argument splits at exactly these.
SPACES = b" \t\n\v\f\r"

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse, modulo 2**64; the base is odd."""
    up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
    up[1:], down[1:] = base, pow(base, -1, 1 << 64)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of values[start:end], equal for equal runs wherever they stand."""
    size = 1 << max(16, int(len(values)).bit_length())
    up, down = _powers(base, size)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_bounds(data: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are no separators (a table of 256)."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~separator[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; a megabyte of text at a time, or one longer word."""
    made, first = [np.zeros(0, np.uint64)], 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + (1 << 20), "right")))
        low = starts[first]
        some = data[low : ends[last - 1]].astype(np.uint64) + np.uint64(1)
        made.append(_run_hashes(some, starts[first:last] - low, ends[first:last] - low, 0x9E3779B97F4A7C15))
        first = last
    return np.concatenate(made)


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive words, by the position of the first."""
    count = max(0, len(words) - length + 1)
    starts = np.arange(count)
    return _run_hashes(words, starts, starts + length, 0xD1342543DE82EF95)


def separators(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table
