"""Prefix polynomial hashes over byte buffers (vectorised, modulo 2**64).

``H[i] = sum_{j<i} (b[j] + 1) * B**j``; the hash of ``b[l:r]`` is
``(H[r] - H[l]) * B**-l``, so any substring costs O(1).  A modulus of 2**64
can collide on adversarial (Thue-Morse like) inputs, which is why every user
of these hashes compares the bytes themselves before acting on an equality.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
_INV = pow(BASE, -1, 2**64)
_POW: dict[str, np.ndarray] = {}


def _powers(name: str, base: int, n: int) -> np.ndarray:
    have = _POW.get(name)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        out = np.full(size, np.uint64(base), np.uint64)
        out[0] = 1
        np.cumprod(out, out=out)
        _POW[name] = have = out
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads the entropy of a polynomial hash over all 64 bits."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


class PrefixHash:
    """Prefix hashes of one byte buffer (callers keep buffers to a few MB)."""

    def __init__(self, b: np.ndarray):
        self.b = b
        n = len(b)
        self.h = np.zeros(n + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _powers("pow", BASE, n), out=self.h[1:])
        self.inv = _powers("inv", _INV, n + 1)

    def windows(self, k: int) -> np.ndarray:
        """Hash of every ``b[i:i+k]``."""
        n = len(self.b) - k + 1
        return mix((self.h[k:] - self.h[:-k]) * self.inv[:n])

    def spans(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of ``b[lo:hi]`` for each pair."""
        return mix((self.h[hi] - self.h[lo]) * self.inv[lo])

    def raw(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (self.h[hi] - self.h[lo]) * self.inv[lo]
