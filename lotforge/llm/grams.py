"""Vectorised rolling hashes over the bytes of a batch of texts."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MULTIPLIER = U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> U(32))
    x = x * _MULTIPLIER
    x ^= x >> U(32)
    x *= _MULTIPLIER
    x ^= x >> U(32)
    return x


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(0xA24BAED4963EE407))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(size, _BASE, dtype=U), np.full(size, inverse, dtype=U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Rolling:
    """Hash of any stretch of a buffer in constant time; equal stretches have equal hashes."""

    def __init__(self, buffer: np.ndarray):
        size = 1 << max(16, int(len(buffer) + 1).bit_length())
        self.up, down = _powers(size)
        self.sums = np.zeros(len(buffer) + 1, dtype=U)
        np.cumsum(_symbols()[buffer] * down[: len(buffer)], out=self.sums[1:])

    def every(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, dtype=U)
        return mix((self.sums[length:] - self.sums[:n]) * self.up[:n])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.up[start])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbouring values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[:n], values[width - reach : width - reach + n])
