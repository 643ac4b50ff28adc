"""SetSketch registers (Ertl, 2021): exponentially spaced truncated minima of a set of 64-bit hashes.

Register i is floor(1 - log_b h) for the least of the exponentially distributed values h that hash function
i gives to the elements, cut to 0 .. Q + 1. The register of a union is the larger one, so sketches merge.
With a base near 1 two registers are equal about as often as the Jaccard similarity says.
"""

from __future__ import annotations

import math

import numpy as np

from siltstone.llm.words import mixed

#: Registers, their base, the rate of the exponentials and the largest value before the cut.
REGISTERS, BASE, RATE, Q = 192, 1.02, 20.0, 2045
#: Registers of a band: at a similarity of 0.85 two documents share none of 32 bands in 3 of ten million cases.
ROWS = 6

_ODD = mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def registers(elements: np.ndarray) -> np.ndarray:
    """REGISTERS values of type uint16 for a set's hashes; zeros for an empty set."""
    if not len(elements):
        return np.zeros(REGISTERS, np.uint16)
    least = np.full(REGISTERS, np.uint64(2**64 - 1))
    for at in range(0, len(elements), 4096):
        part = elements[at : at + 4096]
        np.minimum(least, (part[None, :] * _ODD[:, None]).min(axis=1), out=least)
    h = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(np.maximum(h, 1e-300)) / math.log(BASE)), 0, Q + 1).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(a, b)


def bands(k: np.ndarray) -> np.ndarray:
    """One 64-bit key for each ROWS registers, with the band's number mixed in."""
    rows = k.reshape(-1, ROWS).astype(np.uint64)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = mixed(key * np.uint64(65_537) + rows[:, i])
    return key.astype(np.int64)


def wide_bands(k: np.ndarray, rows: int, count: int) -> np.ndarray:
    """One 64-bit key for each of count choices of so many registers, the same choices for every set."""
    if (rows, count) not in _CHOICES:
        rng = np.random.default_rng(rows * 1000 + count)
        _CHOICES[rows, count] = np.array([rng.choice(REGISTERS, rows, replace=False) for _ in range(count)])
    values = k[_CHOICES[rows, count]].astype(np.uint64)
    key = np.arange(1, count + 1, dtype=np.uint64)
    for i in range(rows):
        key = mixed(key * np.uint64(65_537) + values[:, i])
    return key.astype(np.int64)


_CHOICES: dict[tuple[int, int], np.ndarray] = {}


def _log_likelihood(j: np.ndarray, plus: np.ndarray, minus: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    def p(x: np.ndarray) -> np.ndarray:
        return -np.log(np.maximum(1 - x * (BASE - 1) / BASE, 1e-300)) / math.log(BASE)

    up, down = p(np.maximum(u - v * j, 0)), p(np.maximum(v - u * j, 0))
    terms = ((plus, up), (minus, down), (REGISTERS - plus - minus, 1 - up - down))
    return sum(n * np.log(np.maximum(q, 1e-12)) for n, q in terms)


def jaccard_many(a: np.ndarray, others: np.ndarray, na: int, sizes: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood estimates for a against each row of others, from how often its registers are
    above, below and equal, for known set sizes."""
    plus, minus = (a > others).sum(axis=1), (a < others).sum(axis=1)
    u, v = na / (na + sizes), sizes / (na + sizes)
    lo, hi = np.zeros(len(others)), np.minimum(u / v, v / u)
    for _ in range(24):
        x, y = lo + (hi - lo) * 0.382, lo + (hi - lo) * 0.618
        right = _log_likelihood(x, plus, minus, u, v) < _log_likelihood(y, plus, minus, u, v)
        lo, hi = np.where(right, x, lo), np.where(right, hi, y)
    return (lo + hi) / 2


def lower_bound(j: float, errors: float) -> float:
    """j less so many standard errors of an estimate at j."""
    return j - errors * math.sqrt(j * (1 - j) / REGISTERS)
