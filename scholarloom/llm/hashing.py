"""64-bit fingerprints of substrings from prefix sums."""

from __future__ import annotations

import numpy as np

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n at least."""
    while len(_powers) <= which:
        _powers.append((np.ones(1, np.uint64), np.ones(1, np.uint64)))
    up, down = _powers[which]
    if len(up) < n:
        n = 1 << max(16, n.bit_length())
        back = np.uint64(pow(int(BASE[which]), -1, 2**64))
        up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, BASE[which])])
        down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, back)])
        _powers[which] = (up, down)
    return up, down


class Prints:
    """Fingerprints of substrings of one byte array, from prefix sums."""

    def __init__(self, data: np.ndarray, which: int = 0):
        up, self.down = powers(len(data) + 1, which)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[which][data] * up[: len(data)], out=self.sums[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sums[hi] - self.sums[lo]) * self.down[lo] + (hi - lo).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n] + np.uint64(k))
