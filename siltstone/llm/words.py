"""Word and shingle hashes for operators that run on Arrow batches, found for all words of a text at once."""

from __future__ import annotations

import re

import numpy as np
import xxhash

#: Bytes that are hashed at once, and the longest word that a polynomial of its bytes stands for; longer ones are hashed one by one.
CHUNK_BYTES, PLAIN_BYTES = 1 << 20, 64

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACES = re.compile(rb"[\x20\x09-\x0D]")
_IS_SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads all bits of x."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


#: Two odd bases, and two values for each byte.
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_BYTES = tuple(mixed((np.arange(1, 257, dtype=np.uint64) + np.uint64(seed)) * _MUL) for seed in (0x1000, 0x2000))
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base to the 0, 1, ... n, modulo 2^64; kept by the worker."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, 1024), np.uint64(base % 2**64))
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        _POWERS[base] = have
    return have


def polynomials(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """For each range the sum of values times powers of base from the range's start, modulo 2^64, by one sum over all values."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n)[:n], out=sums[1:])
    return (sums[end] - sums[start]) * powers(pow(base, -1, 1 << 64), n)[start]


def split_words(text: str | None, lower: bool = False) -> list[bytes]:
    r"""Words [^\x20\x09-\x0D]+ as UTF-8, with A-Z in lower case if asked for."""
    raw = (text or "").encode()
    return (raw.translate(_LOWER) if lower else raw).split()


def _chunk(raw: bytes, offset: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    b = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(b) + 2, bool)
    inside[1:-1] = ~_IS_SPACE[b]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    size = (end - start).astype(np.uint64)
    hashes = [mixed(polynomials(values[b], start, end, base) + size * _MUL) for values, base in zip(_BYTES, _BASES)]
    for i in np.flatnonzero(end - start > PLAIN_BYTES).tolist():
        digest = np.frombuffer(xxhash.xxh3_128_digest(raw[start[i] : end[i]]), np.uint64)
        hashes[0][i], hashes[1][i] = digest
    return start + offset, *hashes


def hashed_words(raw: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, hash, second hash) of each word of a text in UTF-8. The two hashes are independent. Texts of any length are
    read in chunks that end at white space."""
    raw = raw.translate(_LOWER) if lower else raw
    if len(raw) <= CHUNK_BYTES:
        return _chunk(raw, 0)
    parts, at = [], 0
    while at < len(raw):
        cut = _SPACES.search(raw, at + CHUNK_BYTES)
        to = cut.start() if cut else len(raw)
        parts.append(_chunk(raw[at:to], at))
        at = to
    return tuple(np.concatenate(p) for p in zip(*parts))


def runs_of(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive entries of h."""
    n = len(h) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mixed(out + h[i : i + n] + np.uint64((i + 1) * int(_MUL) % 2**64))
    return out
