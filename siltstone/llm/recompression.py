"""Recompression of word sequences (Jez, 2016) with names that are the same in every task.

A round names pairs whose left symbol is marked L and whose right symbol is marked R, and, beyond the first rounds,
maximal runs of one symbol before that. A name is a 64-bit hash of what it stands for and its mark is a bit of the
name, so all tasks of all executors agree on names and cuts without a dictionary, and equal substrings are cut alike
but for the symbols at their edges.

For a symbol of the first rounds the words are known that its being there depends on: its own, and those of the
neighbour whose mark kept it single. Wherever these words stand, the symbol stands too. Symbols of later rounds are
longer than most such places; they are compared by what they stand for.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from siltstone.llm.words import mixed, polynomials

#: Rounds of pairs whose symbols are looked up everywhere; rounds until the first and between later levels of long symbols.
LOW_ROUNDS, FIRST_LEVEL, LEVEL_STEP, MOST_ROUNDS = 3, 10, 4, 200

_RUN, _PAIR = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)
_ODD = np.uint64(0xFF51AFD7ED558CCD)
_FAR = np.int64(1) << np.int64(60)


@dataclass(frozen=True)
class Symbols:
    """Symbols of a batch of documents, in order: name, document, first and last-but-one word, and the words that it depends on."""

    name: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray


def _pairs(x: np.ndarray, g: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(names, heads, whether a head has a mate, marks) after pairs L R are named."""
    mark = (x >> np.uint64((turn * 7 + 3) % 64)) & np.uint64(1) == 1
    second = np.zeros(len(x), bool)
    second[1:] = mark[1:] & ~mark[:-1] & (g[1:] == g[:-1])
    head = np.flatnonzero(~second)
    paired = np.zeros(len(head), bool)
    inside = head + 1 < len(x)
    paired[inside] = second[head[inside] + 1]
    name = x[head]
    with_mate = head[paired]
    name[paired] = mixed(x[with_mate] * _ODD + mixed(x[with_mate + 1] + _PAIR))
    return name, head, paired, mark


def low_symbols(words: np.ndarray, doc: np.ndarray, rounds: int = LOW_ROUNDS) -> Symbols:
    """Symbols after the first rounds of pairs, from word hashes and the document of each word."""
    at = np.arange(len(words), dtype=np.int64)
    x, g, a, b, lo, hi = mixed(words + _RUN), doc, at, at + 1, at, at + 1
    for turn in range(rounds):
        name, head, paired, mark = _pairs(x, g, turn)
        n = len(x)
        # A single L stays single because of the symbol after it, a single R because of the one before; at an edge of the document nothing says so.
        later, earlier = np.minimum(head + 1, n - 1), np.maximum(head - 1, 0)
        kept_l, kept_r = ~mark[head] & ~paired, mark[head]
        same_l, same_r = (head + 1 < n) & (g[later] == g[head]), (head > 0) & (g[earlier] == g[head])
        left, right = lo[head].copy(), hi[head].copy()
        for who, there, mate in ((paired, paired, later), (kept_l, same_l, later), (kept_r, same_r, earlier)):
            use = who & there
            left[use] = np.minimum(left[use], lo[mate[use]])
            right[use] = np.maximum(right[use], hi[mate[use]])
        right[kept_l & ~same_l] = _FAR
        left[kept_r & ~same_r] = -_FAR
        end = b[head]
        end[paired] = b[later[paired]]
        x, g, a, b, lo, hi = name, g[head], a[head], end, left, right
    return Symbols(x, g, a, b, lo, hi)


def long_symbols(low: Symbols, least: int, first: int = FIRST_LEVEL, step: int = LEVEL_STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, doc, start, end) of symbols of at least so many words on the levels that later rounds of runs and pairs give,
    up to one symbol for each document. A symbol that has not grown since the level before is left out."""
    x, g, a, b = low.name, low.doc, low.start, low.end
    grown = np.ones(len(x), bool)
    out = []
    docs = int((g[1:] != g[:-1]).sum()) + 1 if len(g) else 0

    def level() -> None:
        take = grown & (b - a >= least)
        out.append((x[take], g[take], a[take], b[take]))
        grown[:] = False

    for turn in range(LOW_ROUNDS, MOST_ROUNDS):
        if len(x) <= docs:
            break
        fresh = np.ones(len(x), bool)
        fresh[1:] = (x[1:] != x[:-1]) | (g[1:] != g[:-1])
        begin = np.flatnonzero(fresh)
        if len(begin) < len(x):
            size = np.diff(np.append(begin, len(x))).astype(np.uint64)
            name = x[begin]
            name[size > 1] = mixed(name[size > 1] * _ODD + size[size > 1] * _RUN)
            grown = np.bitwise_or.reduceat(grown, begin) | (size > 1)
            x, g, a, b = name, g[begin], a[begin], b[np.append(begin[1:], len(b)) - 1]
        name, head, paired, _ = _pairs(x, g, turn)
        end = b[head]
        end[paired] = b[head[paired] + 1]
        grown = grown[head] | paired
        x, g, a, b = name, g[head], a[head], end
        if turn + 1 >= first and (turn + 1 - first) % step == 0:
            level()
    level()
    return tuple(np.concatenate(p) for p in zip(*out))


_CONTENT_BASE = 0x8EBC6AF09C88C6E3


def contents(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of what stands in ranges of words, from second hashes of the words."""
    return mixed(polynomials(words, start, end, _CONTENT_BASE) + (end - start).astype(np.uint64))
