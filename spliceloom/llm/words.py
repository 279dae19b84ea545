"""Vectorised word splitting and 64-bit word hashes over batches of UTF-8 texts."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 & ~7 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LETTER = np.zeros(256, np.uint8)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = 1
#: 0 white space, 1 letters, digits and bytes of longer code points, 2 the rest
KIND = np.where(SPACE, 0, np.where(_LETTER == 1, 1, 2)).astype(np.uint8)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the hash base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 16)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers = (np.cumprod(up), np.cumprod(down))
    return _powers


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end); equal bytes give equal hashes wherever they stand."""
    up, down = powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def split(raw: np.ndarray, bounds: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of one non-zero kind inside each text: starts, ends, and the bounds of each text's runs."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    kind = kinds[raw]
    edge = np.empty(n + 1, bool)
    edge[0] = edge[n] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:n])
    edge[bounds] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    real = kind[starts] != 0
    starts, ends = starts[real], ends[real]
    return starts, ends, np.searchsorted(starts, bounds)
