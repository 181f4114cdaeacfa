"""Hashes of all spans of a sequence, and its windows' least positions, in numpy."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_BASES = {"up": _BASE, "down": pow(_BASE, -1, 1 << 64)}


def _powers(kind: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the base, or of its inverse, modulo 2**64; kept."""
    if len(_POWERS[kind]) < n:
        steps = np.full(max(n, 1 << 14), _BASES[kind], np.uint64)
        steps[0] = 1
        _POWERS[kind] = np.cumprod(steps)
    return _POWERS[kind][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all 64."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


class Rolling:
    """Polynomial hashes modulo 2**64 of the spans of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers("up", len(values)), out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the values from ``start`` up to ``end``; equal for equal values."""
        down = _powers("down", len(self.sums))
        return mixed((self.sums[end] - self.sums[start]) * down[start] + (end - start).astype(np.uint64))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])
