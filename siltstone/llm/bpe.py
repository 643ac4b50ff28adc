"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Merges of a pre-token are taken from buckets, one per merge rank, that hold places in a linked list of
parts. Two levels of bitmaps say which buckets hold anything; find-first-set on each gives the lowest rank.
A place whose pair has changed since is stale and skipped when it comes up. The work for a pre-token of n
bytes is O(n log n), however long it is.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import bounded

#: Pre-tokens in each of the two generations of a worker's memo, and rows of a batch sent back at once.
MEMO_ENTRIES, BATCH_ROWS, LONG_TEXT = 400_000, 256, 1 << 20

_LEAF_BITS = 8


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines of a .tiktoken file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, content.splitlines()))}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank merges first, the leftmost among equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pair = [-1] * n
    buckets: dict[int, list[int]] = {}
    leaves: dict[int, int] = {}
    root = 0
    for i in range(n - 1):
        r = ranks.get(piece[i : i + 2])
        if r is not None:
            pair[i] = r
            if (held := buckets.get(r)) is None:
                buckets[r] = [i]
                leaf = r >> _LEAF_BITS
                leaves[leaf] = leaves.get(leaf, 0) | 1 << (r & 255)
                root |= 1 << leaf
            else:
                held.append(i)
    while root:
        leaf = (root & -root).bit_length() - 1
        bits = leaves[leaf]
        r = leaf << _LEAF_BITS | (bits & -bits).bit_length() - 1
        held = buckets[r]
        i = heappop(held)
        if not held:
            del buckets[r]
            bits &= bits - 1
            leaves[leaf] = bits
            if not bits:
                root &= root - 1
        if pair[i] != r:
            continue
        j = after[i]
        pair[j] = -1
        k = after[j]
        after[i] = k
        if k < n:
            before[k] = i
        left = before[i]
        for a, end in ((left, k), (i, after[k] if k < n else -1)):
            if a < 0 or end < 0:
                if a == i:
                    pair[i] = -1
                continue
            r = ranks.get(piece[a:end])
            if r is None:
                pair[a] = -1
            elif pair[a] != r or a == i:
                pair[a] = r
                if (held := buckets.get(r)) is None:
                    buckets[r] = [a]
                    leaf = r >> _LEAF_BITS
                    leaves[leaf] = leaves.get(leaf, 0) | 1 << (r & 255)
                    root |= 1 << leaf
                else:
                    heappush(held, a)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Encoder:
    """Encodes and decodes texts; remembers recent pre-tokens in two generations of bounded size."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo_entries: int = MEMO_ENTRIES):
        import regex

        self.ranks, self.split, self.limit = ranks, regex.compile(pattern), memo_entries
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def _piece(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(merge(piece.encode(), self.ranks), dtype="<u4").tobytes()
        if len(piece) <= 64:
            if len(self.young) >= self.limit:
                self.old, self.young = self.young, {}
            self.young[piece] = ids
        return ids

    def _pieces(self, pieces: Iterable[str]) -> bytes:
        known = self.young.get
        return b"".join([known(p) or self._piece(p) for p in pieces])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. A long text is split and encoded piece by piece."""
        if len(text) < LONG_TEXT:
            return self._pieces(self.split.findall(text))
        found = (m.group() for m in self.split.finditer(text))
        return b"".join(iter(lambda: self._pieces(islice(found, 100_000)), b""))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_ENCODERS: dict[tuple[str, str, int], Encoder] = {}


def _encoder(content: bytes, pattern: str, memo_entries: int) -> Encoder:
    """One encoder for each vocabulary in a worker process."""
    key = (hashlib.sha256(content).hexdigest(), pattern, memo_entries)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(read_ranks(content), pattern, memo_entries)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, *, memo_entries: int = MEMO_ENTRIES) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and decoded (binary, the bytes that the ids stand for).

    vocabulary: path of a rank file, read once by the driver. A null or empty text has no ids. Each row is
    encoded by itself, so repeated rows and doc_ids, null doc_ids and empty tables need no rule; only doc_id
    and text are read. No row is shuffled. memo_entries: pre-tokens in each generation of a worker's memory; it changes cost alone.
    """
    with open(vocabulary, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = next(f.dataType.simpleString() for f in docs.schema if f.name == "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(content.value, pattern, memo_entries)
        for batch in bounded(batches, 1, BATCH_ROWS):
            ids = [own.encode(t) if t else b"" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array([own.decode(x) for x in ids], pa.binary())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded documents, and more of their columns."""
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), *more)
