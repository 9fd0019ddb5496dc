"""Fingerprints of byte strings by prefix sums, so that any substring costs one lookup."""

from __future__ import annotations

import numpy as np


def _kind(base: int, seed: int) -> tuple[np.uint64, np.uint64, np.ndarray]:
    """An odd base, its inverse, and an odd value for each byte."""
    values = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return np.uint64(base), np.uint64(pow(base, -1, 1 << 64)), values


#: Two independent fingerprints.
_KINDS = _kind(0x9E3779B97F4A7C15, 20260101), _kind(0xD1342543DE82EF95, 20260102)
_tables: dict[int, np.ndarray] = {}
#: Power tables are kept up to this many bytes; those of a longer text are made for it and dropped.
_KEEP = 4 << 20


def _powers(base: np.uint64, n: int) -> np.ndarray:
    kept = _tables.get(int(base))
    if kept is not None and len(kept) >= n:
        return kept[:n]
    out = np.full(max(n, 1 << 16), base, np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    if len(out) <= _KEEP:
        _tables[int(base)] = out
    return out[:n]


def forget() -> None:
    """Drops the kept tables."""
    _tables.clear()


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Prefix sums of one byte string; ``hash(start, end)`` takes arrays of ends. ``kind`` 0 or 1: independent of each other."""

    def __init__(self, data: np.ndarray, kind: int = 0):
        n = len(data)
        base, inverse, values = _KINDS[kind]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data] * _powers(base, n), out=self.sums[1:])
        self.inverse = _powers(inverse, n + 1)

    def hash(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])
