"""Repeated passages by recompression: words that a window of an earlier document holds too are removed.

1. Tasks recompress documents; names of runs and pairs are the same everywhere. A first round over all documents brings
   equal names together, in buckets of names: low symbols (two or three words) that only one document has, and long
   symbols (13 words to whole documents) of which a smaller doc_id has an equal one. Equal means the name, which stands
   for its whole derivation, and a hash of the words from second hashes.
2. The answers meet the documents. A long symbol that an earlier document has too is a repeat by itself, edges
   excepted. No window repeats that holds a low symbol of one document only, together with the words that this symbol
   depends on. The windows left are at the edges of long repeats, in short ones, and in the first documents that hold
   something repeated; a second round brings these windows together and answers with places.
3. Documents drop the words of all places.

Copies and long passages thus travel as a few long symbols, and text that repeats nothing as low symbols alone. Within
a batch a name is sent once, so what many documents share costs its bucket one entry for each batch.

Windows are compared by a 64-bit hash and 32 bits of an independent one, long symbols by 64-bit names and 32 bits
of a hash of their words; at 100 TB, some 10^13 windows, no two different ones are likely to agree in both (a chance of about
one in a thousand in all). Low symbols only say what needn't be compared, so there a shorter name does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import bounded
from siltstone.llm.recompression import contents, long_symbols, low_symbols
from siltstone.llm.words import hashed_words, mixed, split_words

WINDOW = 13
#: Bytes of text of a batch and documents of one, unless one document has more; bytes of text for a bucket and for a slice that is dealt to buckets; bytes of a low symbol's name.
BATCH_BYTES, BATCH_DOCUMENTS, BUCKET_BYTES, SLICE_BYTES, LOW_BYTES = 2_000_000, 8192, 6_000_000, 12_000_000, 6

#: Buckets of small tables.
LEAST_BUCKETS = 8

_LOW, _LONG, _LOW_KNOWN, _LONG_KNOWN = 0, 1, 2, 3
_ENTRY = np.dtype([("name", "<u8"), ("check", "<u4")])
_SPAN = np.dtype([("start", "<u4"), ("end", "<u4")])
_SENT = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])
_DEALT = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])
_STRIPPED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


class Batch:
    """Documents side by side: their ids and keys (a hash of the text, which tells rows with one id apart), and the hashes and documents of all words."""

    def __init__(self, ids: list[int], keys: list[int], texts: list[str]):
        self.ids, self.keys = np.array(ids, np.int64), np.array(keys, np.int64)
        raw = [t.encode() for t in texts]
        begin = np.cumsum([0, *(len(r) + 1 for r in raw)])
        place, self.one, self.two = hashed_words(b"\n".join(raw))
        self.first = np.searchsorted(place, begin)
        self.doc = np.repeat(np.arange(len(raw)), np.diff(self.first))

    def symbols(self, window: int):
        low = low_symbols(self.one, self.doc)
        name, doc, start, end = long_symbols(low, window)
        return low, _short(low.name), name, self.check(start, end), doc, start, end

    def check(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (contents(self.two, start, end) >> np.uint64(32)).astype(np.uint32)

    def window_names(self, start: np.ndarray, window: int) -> np.ndarray:
        out = np.zeros(len(start), np.uint64)
        for i in range(window):
            out = mixed(out + self.one[start + i] + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % 2**64))
        return out


def _short(name: np.ndarray) -> np.ndarray:
    return name >> np.uint64(64 - 8 * LOW_BYTES)


def _low_names(name: np.ndarray) -> bytes:
    return name.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :LOW_BYTES].tobytes()


def _low_names_of(raw: bytes) -> np.ndarray:
    whole = np.zeros((len(raw) // LOW_BYTES, 8), np.uint8)
    whole[:, :LOW_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, LOW_BYTES)
    return whole.view("<u8").ravel()


def _planes(name: np.ndarray, width: int) -> bytes:
    """Sorted names as byte planes of their differences, which compress well."""
    gaps = np.diff(name, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return np.ascontiguousarray(gaps.T).tobytes()


def _unplanes(raw: bytes, n: int, width: int) -> np.ndarray:
    planes = np.zeros((8, n), np.uint8)
    planes[:width] = np.frombuffer(raw, np.uint8, width * n).reshape(width, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _owned(ids: np.ndarray, keys: np.ndarray | None, rest: bytes) -> bytes:
    """A payload: the documents that it is of, with their keys in the second round, and what it says of them."""
    return len(ids).to_bytes(4, "little") + _planes(ids.astype(np.uint64), 8) + (keys.astype("<i8").tobytes() if keys is not None else b"") + rest


def _owners_of(raw: bytes, keyed: bool) -> tuple[np.ndarray, np.ndarray | None, bytes]:
    n = int.from_bytes(raw[:4], "little")
    ids = _unplanes(raw[4 : 4 + 8 * n], n, 8).astype(np.int64)
    to = 4 + 8 * n * (1 + keyed)
    return ids, np.frombuffer(raw, "<i8", n, 4 + 8 * n) if keyed else None, raw[to:]


def _part(ids: np.ndarray, parts: int) -> np.ndarray:
    """Where a document and its answers meet: a hash of the id."""
    return (mixed(ids.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) % np.uint64(parts)).astype(np.int64)


def _buckets_of(name: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """A name's bucket by its leading bits, so that sorted names are sorted by bucket."""
    return ((name >> np.uint64(bits - 32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _owners(fresh: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For entries sorted by what they are and then by document: the first document of each one's group."""
    return doc[np.maximum.accumulate(np.where(fresh, np.arange(len(doc)), 0))] if len(doc) else doc


def _groups(*columns: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(columns[0]), bool)
    if len(fresh):
        fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return fresh


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of each run of equal values."""
    if not len(values):
        return []
    cuts = np.flatnonzero(np.diff(values)) + 1
    return list(zip(np.append(0, cuts).tolist(), np.append(cuts, len(values)).tolist()))


def _entries(name: np.ndarray, check: np.ndarray) -> bytes:
    out = np.empty(len(name), _ENTRY)
    out["name"], out["check"] = name, check
    return out.tobytes()


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _sent_symbols(batch: Batch, window: int, buckets: int) -> list[tuple]:
    """Rows for the first round: symbols by bucket, and what the batch knows by itself, by part."""
    low, short, name, check, doc, _, _ = batch.symbols(window)
    part, rows = _part(batch.ids, buckets), []

    def known(kind: int, who: np.ndarray, payload) -> None:
        order = np.argsort(who, kind="stable")
        for a, b in _runs(who[order]):
            i = int(who[order[a]])
            rows.append((kind, int(part[i]), _owned(batch.ids[i : i + 1], None, payload(order[a:b]))))

    order = np.lexsort((low.doc, short))
    order = order[_groups(short[order], low.doc[order])]
    x, d = short[order], low.doc[order]
    fresh = _groups(x)
    ids = batch.ids[d]
    begin = np.flatnonzero(fresh)
    if len(begin):
        many = (np.minimum.reduceat(ids, begin) != np.maximum.reduceat(ids, begin))[np.cumsum(fresh) - 1]
        known(_LOW_KNOWN, d[many], lambda at, x=x[many]: _low_names(x[at]))
        x, d = x[fresh], d[fresh]
        bucket = _buckets_of(x, 8 * LOW_BYTES, buckets)
        for a, b in _runs(bucket):
            used, local = np.unique(d[a:b], return_inverse=True)
            rows.append((_LOW, int(bucket[a]), _owned(batch.ids[used], None, _planes(x[a:b], LOW_BYTES) + local.astype("<u2").tobytes())))

    order = np.lexsort((batch.ids[doc], check, name))
    x, c, d = name[order], check[order], doc[order]
    fresh = _groups(x, c)
    later = batch.ids[d] > _owners(fresh, batch.ids[d])
    known(_LONG_KNOWN, d[later], lambda at, x=x[later], c=c[later]: _entries(x[at], c[at]))
    x, c, d = x[fresh], c[fresh], d[fresh]
    bucket = _buckets_of(x, 64, buckets)
    for a, b in _runs(bucket):
        used, local = np.unique(d[a:b], return_inverse=True)
        rows.append((_LONG, int(bucket[a]), _owned(batch.ids[used], None, _planes(x[a:b], 8) + c[a:b].astype("<u4").tobytes() + local.astype("<u2").tobytes())))
    return rows


def _dealt(kind: int, ids: np.ndarray, keys: np.ndarray | None, payload: list[bytes], parts: int) -> list[tuple]:
    """One row for each part that has answers: the documents, the bytes of each one's, and the answers, end to end."""
    part, rows = _part(ids, parts), []
    order = np.argsort(part, kind="stable")
    for a, b in _runs(part[order]):
        own = order[a:b]
        said = [payload[i] for i in own]
        rows.append((int(part[own[0]]), kind, _owned(ids[own], keys[own] if keys is not None else None, np.array([len(x) for x in said], "<u8").tobytes() + b"".join(said))))
    return rows


def _passed_on(rows: pa.Table, kind: int, keyed: bool, parts: int) -> list[tuple]:
    """Rows that are answers already, each to one document."""
    ids, keys, said = zip(*(_owners_of(raw, keyed) for raw in rows.column("payload").to_pylist()))
    return _dealt(kind, np.concatenate(ids), np.concatenate(keys) if keyed else None, list(said), parts)


def _answered_symbols(rows: pa.Table, parts: int) -> list[tuple]:
    """Of a bucket: low symbols that two documents have, to all of them; long symbols that a smaller doc_id has, to the others."""
    kind = rows.column("kind")[0].as_py()
    if kind in (_LOW_KNOWN, _LONG_KNOWN):
        return _passed_on(rows, kind - 2, False, parts)
    names, checks, docs = [], [], []
    width = LOW_BYTES if kind == _LOW else 8
    for whole in rows.column("payload").to_pylist():
        ids, _, raw = _owners_of(whole, False)
        n = len(raw) // (width + (2 if kind == _LOW else 6))
        names.append(_unplanes(raw, n, width))
        checks.append(np.frombuffer(raw, "<u4", n, width * n) if kind == _LONG else np.zeros(n, np.uint32))
        docs.append(ids[np.frombuffer(raw, "<u2", n, len(raw) - 2 * n)])
    name, check, doc = map(np.concatenate, (names, checks, docs))
    order = np.lexsort((doc, check, name))
    name, check, doc = name[order], check[order], doc[order]
    fresh = _groups(name, check)
    if kind == _LOW:
        begin = np.flatnonzero(fresh)
        told = (np.minimum.reduceat(doc, begin) != np.maximum.reduceat(doc, begin))[np.cumsum(fresh) - 1]
    else:
        told = doc > _owners(fresh, doc)
    name, check, doc = name[told], check[told], doc[told]
    order = np.argsort(doc, kind="stable")
    name, check, doc = name[order], check[order], doc[order]
    runs = _runs(doc)
    payload = [_low_names(name[a:b]) if kind == _LOW else _entries(name[a:b], check[a:b]) for a, b in runs]
    return _dealt(kind, doc[[a for a, _ in runs]] if runs else doc, None, payload, parts)


def _covered(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any of the ranges."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, start, 1)
    np.add.at(steps, end, -1)
    return np.cumsum(steps)[:n] > 0


def _keyed(name: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mixed(name + mixed(doc.astype(np.uint64)))


def _sent_windows(batch: Batch, answers: dict[int, dict[int, bytes]], window: int, buckets: int) -> list[tuple]:
    """Rows for the second round: windows that may repeat, by bucket, and places that are known to be repeats, by part."""
    low, short, name, check, doc, start, end = batch.symbols(window)
    n, rows, part = len(batch.doc), [], _part(batch.ids, buckets)

    def told(kind: int, size: int) -> tuple[np.ndarray, bytes]:
        mine = [answers.get(int(i), {}).get(kind, b"") for i in batch.ids]
        return np.repeat(np.arange(len(mine)), [len(x) // size for x in mine]), b"".join(mine)

    who, raw = told(_LOW, LOW_BYTES)
    alone = ~np.isin(_keyed(short, low.doc), _keyed(_low_names_of(raw), who))
    who, raw = told(_LONG, _ENTRY.itemsize)
    entries = np.frombuffer(raw, _ENTRY)
    key = _keyed(entries["name"].astype(np.uint64), who)
    order = np.argsort(key, kind="stable")
    key, checks = key[order], entries["check"][order]
    mine = _keyed(name, doc)
    at = np.searchsorted(key, mine)
    earlier = np.zeros(len(mine), bool)
    for i in range(int(np.max(np.diff(np.append(np.flatnonzero(_groups(key)), len(key))), initial=0))):  # once, but for names that agree by chance
        place = np.minimum(at + i, max(len(key) - 1, 0))
        earlier |= (key[place] == mine) & (checks[place] == check)

    whole = np.arange(n) + window <= batch.first[batch.doc + 1] if n else np.zeros(0, bool)
    known = _covered(start[earlier], end[earlier] - window + 1, n)
    tight = alone & (low.right - low.left <= window)
    begin = np.maximum(low.right[tight] - window, 0)
    dead = _covered(begin, np.maximum(low.left[tight] + 1, begin), n)
    live = np.flatnonzero(whole & ~known & ~dead)

    gone_start, gone_end, gone_doc = start[earlier], end[earlier], doc[earlier]
    x = batch.window_names(live, window)
    c = batch.check(live, live + window)
    order = np.lexsort((live, batch.ids[batch.doc[live]], c, x))
    x, c, live = x[order], c[order], live[order]
    ids = batch.ids[batch.doc[live]]
    later = ids > _owners(_groups(x, c), ids)
    places = live[later]
    gone_start, gone_end, gone_doc = (np.concatenate(p) for p in ((gone_start, places), (gone_end, places + window), (gone_doc, batch.doc[places])))
    order = np.lexsort((gone_start, gone_doc))
    gone_start, gone_end, gone_doc = gone_start[order], gone_end[order], gone_doc[order]
    for a, b in _runs(gone_doc):
        i = int(gone_doc[a])
        rows.append((_LONG, int(part[i]), _owned(batch.ids[i : i + 1], batch.keys[i : i + 1], _spans(gone_start[a:b] - batch.first[i], gone_end[a:b] - batch.first[i]))))
    x, c, live = x[~later], c[~later], live[~later]
    bucket = _buckets_of(x, 64, buckets)
    for a, b in _runs(bucket):
        d = batch.doc[live[a:b]]
        used, local = np.unique(d, return_inverse=True)
        payload = _planes(x[a:b], 8) + c[a:b].astype("<u4").tobytes() + (live[a:b] - batch.first[d]).astype("<u4").tobytes() + local.astype("<u2").tobytes()
        rows.append((_LOW, int(bucket[a]), _owned(batch.ids[used], batch.keys[used], payload)))
    return rows


def _spans(start: np.ndarray, end: np.ndarray) -> bytes:
    """Sorted ranges, those that touch joined."""
    if not len(start):
        return b""
    reach = np.maximum.accumulate(end)
    fresh = np.ones(len(start), bool)
    fresh[1:] = start[1:] > reach[:-1]
    begin = np.flatnonzero(fresh)
    out = np.empty(len(begin), _SPAN)
    out["start"], out["end"] = start[begin], reach[np.append(begin[1:], len(reach)) - 1]
    return out.tobytes()


def _answered_windows(rows: pa.Table, window: int, parts: int) -> list[tuple]:
    """Of a bucket the places of windows that a smaller doc_id has too."""
    if rows.column("kind")[0].as_py() == _LONG:
        return _passed_on(rows, 0, True, parts)
    names, checks, docs, keys, places = [], [], [], [], []
    for whole in rows.column("payload").to_pylist():
        own, key, raw = _owners_of(whole, True)
        n = len(raw) // 18
        local = np.frombuffer(raw, "<u2", n, 16 * n)
        names.append(_unplanes(raw, n, 8))
        checks.append(np.frombuffer(raw, "<u4", n, 8 * n))
        places.append(np.frombuffer(raw, "<u4", n, 12 * n))
        docs.append(own[local])
        keys.append(key[local])
    name, check, doc, key, place = map(np.concatenate, (names, checks, docs, keys, places))
    order = np.lexsort((doc, check, name))
    doc, key, place = doc[order], key[order], place[order].astype(np.int64)
    gone = doc > _owners(_groups(name[order], check[order]), doc)
    doc, key, place = doc[gone], key[gone], place[gone]
    order = np.lexsort((place, key, doc))
    doc, key, place = doc[order], key[order], place[order]
    starts = np.flatnonzero(_groups(doc, key))
    ends = np.append(starts[1:], len(doc))
    return _dealt(0, doc[starts], key[starts], [_spans(place[a:b], place[a:b] + window) for a, b in zip(starts, ends)], parts)


def _key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def _batches(rows: Iterator[tuple[int, str]]) -> Iterator[Batch]:
    ids: list[int] = []
    texts: list[str] = []
    room = BATCH_BYTES
    for i, t in rows:
        if ids and (len(ids) >= BATCH_DOCUMENTS or room < len(t)):
            yield Batch(ids, [_key(t) for t in texts], texts)
            ids, texts, room = [], [], BATCH_BYTES
        ids.append(i)
        texts.append(t)
        room -= len(t)
    if ids:
        yield Batch(ids, [_key(t) for t in texts], texts)


def _packed(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """(part, texts): compressed slices of documents by part. Rows without doc_id have no answers to meet and go by a hash of the text."""
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in bounded(batches, 1, 10_000, SLICE_BYTES):
        ids = batch.column(0)
        own = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False)):
            own = own.copy()
            own[i] = _key(batch.column(1)[int(i)].as_py())
        part, rows = _part(own, parts), []
        order = np.argsort(part, kind="stable")
        for a, b in _runs(part[order]):
            some = batch.take(pa.array(order[a:b]))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, some.schema) as w:
                w.write_batch(some)
            rows.append((int(part[order[a]]), squeeze.compress(sink.getvalue().to_pybytes())))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([r for _, r in rows], pa.binary())], ["part", "texts"])


def _unpacked(texts: pa.Table) -> Iterator[tuple[int | None, str]]:
    squeeze = zstandard.ZstdDecompressor()
    for raw in texts.column("texts"):
        with pa.ipc.open_stream(squeeze.decompress(raw.as_py())) as r:
            for batch in r:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def _pieces(answers: pa.Table, keyed: bool) -> Iterator[tuple[int, int, int | None, bytes]]:
    """(kind, id, key, answer) of each answer."""
    for kind, whole in zip(answers.column("kind").to_pylist(), answers.column("payload").to_pylist()):
        ids, keys, raw = _owners_of(whole, keyed)
        at = 8 * len(ids)
        for i, k, n in zip(ids.tolist(), keys.tolist() if keyed else [None] * len(ids), np.frombuffer(raw, "<u8", len(ids)).tolist()):
            yield kind, i, k, raw[at : at + n]
            at += n


def strip_repeats(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_removed, kept (the words that stay, joined by one space).

    A null text has no words; a document of fewer words than the window keeps all. Rows that repeat a doc_id remove
    nothing from each other. Rows with a null doc_id keep all their words and remove none. An empty table gives an
    empty result. Texts may have any length up to what one row of Arrow holds (2 GB); one text is handled by one task.
    doc_id must be an integer column; only doc_id and text are read.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-int(size) // BUCKET_BYTES))
    sent, dealt = "kind int, bucket int, payload binary", "part int, kind int, payload binary"

    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
            yield _table(_SENT, _sent_symbols(batch, window, buckets))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(batches, buckets)

    def answer(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_table(_DEALT, _answered_symbols(rows, buckets))])

    def windows(texts: pa.Table, answers: pa.Table) -> pa.Table:
        got: dict[int, dict[int, bytes]] = {}
        for kind, i, _, raw in _pieces(answers, False):
            mine = got.setdefault(i, {})
            mine[kind] = mine.get(kind, b"") + raw
        out = [_table(_SENT, _sent_windows(batch, got, window, buckets)) for batch in _batches(row for row in _unpacked(texts) if row[0] is not None)]
        return pa.Table.from_batches(out, _SENT)

    def place(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_table(_DEALT, _answered_windows(rows, window, buckets))])

    def strip(texts: pa.Table, answers: pa.Table) -> pa.Table:
        got: dict[tuple[int, int | None], list[bytes]] = {}
        for _, i, key, raw in _pieces(answers, True):
            got.setdefault((i, key), []).append(raw)
        out = []
        for i, t in _unpacked(texts):
            words = split_words(t)
            mine = got.get((i, _key(t))) if got and i is not None else None
            if mine:
                spans = np.frombuffer(b"".join(mine), _SPAN)
                gone = _covered(spans["start"].astype(np.int64), spans["end"].astype(np.int64), len(words)).tolist()
                kept = [w for w, g in zip(words, gone) if not g]
            else:
                kept = words
            out.append((i, len(words), len(words) - len(kept), b" ".join(kept).decode()))
        return pa.Table.from_batches([_table(_STRIPPED, out)])

    texts = d.mapInArrow(pack, "part int, texts binary")
    first = d.where("doc_id IS NOT NULL").mapInArrow(symbols, sent).groupBy("kind", "bucket").applyInArrow(answer, dealt)
    second = texts.groupBy("part").cogroup(first.groupBy("part")).applyInArrow(windows, sent).groupBy("kind", "bucket").applyInArrow(place, dealt)
    return texts.groupBy("part").cogroup(second.groupBy("part")).applyInArrow(strip, "doc_id long, n_words long, n_removed long, kept string")


def repeats_report(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row of docs."""
    return strip_repeats(docs, window=window).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
