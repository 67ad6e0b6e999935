"""64-bit hashes of spans of a sequence, by prefix sums."""

from __future__ import annotations

import numpy as np

# Any odd multiplier has an inverse modulo 2**64.
MULTIPLIER = 0x9E3779B97F4A7C15


class SpanHash:
    """``hash(points, at)``: a hash of each span ``points[at[i]:at[i + 1]]`` and its length.
    Hashes of different (odd) multipliers are independent."""

    def __init__(self, multiplier: int = MULTIPLIER):
        self.multiplier = multiplier
        self.power = self.inverse = np.ones(1, np.uint64)

    def __call__(self, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.spans(points, at[:-1], at[1:])

    def spans(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each ``points[start:end]``; spans may overlap."""
        n = len(points) + 1
        if len(self.power) < n:
            step = np.full(n, self.multiplier, np.uint64)
            back = np.full(n, pow(self.multiplier, -1, 1 << 64), np.uint64)
            step[0] = back[0] = 1
            self.power, self.inverse = np.cumprod(step, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
        x = points.astype(np.uint64) + np.uint64(1)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= self.power[: n - 1]
        sums = np.zeros(n, np.uint64)
        np.cumsum(x, dtype=np.uint64, out=sums[1:])
        h = (sums[ends] - sums[starts]) * self.inverse[starts]
        h ^= h >> np.uint64(32)
        return h * np.uint64(0x94D049BB133111EB) + (ends - starts).astype(np.uint64)
