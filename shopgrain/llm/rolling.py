"""Hashes of all stretches of some bytes at once: polynomial sums modulo 2^64 that numpy takes in one pass."""

from __future__ import annotations

import numpy as np

ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def stretch_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each pair the hash of data[start:end], whatever stands around it.

    Every byte counts times a power of an odd number; the inverse power of the start frees a sum of its place.
    """
    sums = np.cumsum((data + np.uint64(1)) * _powers(ODD, len(data)), dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), sums))
    return mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts])
