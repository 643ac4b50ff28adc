"""Near duplicates of short records within buckets, exactly, by a prefix-filtered join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from siltstone.engine import cannot_be_in, filter_of, may_be_in, stored
from siltstone.functions import text as T


#: The order of shingles is by their counts among one row in SAMPLE, for the MOST most frequent of those seen LEAST times there. It changes cost, not links.
SAMPLE, MOST, LEAST = 16, 200_000, 3
#: Of similar sets that are large enough, so many shingles meet in their prefixes, which are longer by one less.
SHARED = 8
#: Sets that are cut at once; shingles of the sets that one task compares, about, and of the partners that are looked up at once.
ROWS, CELL, AT_ONCE = 1_000, 1_000_000, 1_000_000


def _frequent(rows: DataFrame, shingles: Column) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and their counts in the sample."""
    some = rows.where(F.pmod(F.xxhash64("key"), F.lit(SAMPLE)) == 0)
    counts = some.select(F.explode(shingles).alias("token")).groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)
    found = counts.orderBy(F.desc("n"), "token").limit(MOST).toArrow().sort_by("token")
    return found["token"].to_numpy(), found["n"].to_numpy()


def _with_prefixes(sets: DataFrame, frequent: tuple[np.ndarray, np.ndarray], least: float) -> DataFrame:
    """Sets, rarest shingle first, cut to their first n - ceil(least * n) + SHARED, or whole. Shingles of one count are in the order of their hashes."""
    tokens, counts = frequent

    def run(batches):
        for b in (x.slice(at, ROWS) for x in batches for at in range(0, x.num_rows, ROWS)):
            lists = b.column(b.num_columns - 1)
            flat, n = lists.flatten().to_numpy(), pc.list_value_length(lists).to_numpy()
            at = np.minimum(np.searchsorted(tokens, flat), max(len(tokens) - 1, 0))
            rank = np.where(tokens[at] == flat, counts[at], 0) if len(tokens) else np.zeros(len(flat), np.int64)
            to = np.cumsum(n)
            size = np.minimum(n, n - np.ceil(n * least - 1e-9).astype(np.int64) + SHARED)
            cut = [flat[e - k:e][np.argsort(rank[e - k:e], kind="stable")[:m]] for e, k, m in zip(to, n, size, strict=True)]
            prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *cut]), pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], prefix], names=[*b.schema.names[:-1], "prefix"])

    kinds = StructType([*sets.schema.fields[:-1], StructField("prefix", sets.schema.fields[-1].dataType)])
    return sets.mapInArrow(run, kinds)


def _cells(pairs: DataFrame) -> DataFrame:
    """pairs with the cell that compares them. A pair belongs to the least partner of its smaller key, so that near copies of each other meet in
    one cell and a set is sent there once. Small ones share a cell; those of more than CELL shingles are dealt to cells of two blocks."""
    ends = pairs.select(F.col("key_a").alias("node"), F.col("key_a").alias("least")).unionByName(pairs.select(F.col("key_b").alias("node"), F.col("key_a").alias("least")))
    hubs = stored(ends.groupBy("node").agg(F.min("least").alias("hub")), "hubs")
    placed = stored(pairs.join(hubs.withColumnRenamed("node", "key_a"), "key_a"), "placed")
    members = placed.select("hub", F.explode(F.array(F.struct(F.col("key_a").alias("key"), F.col("n_a").alias("n")), F.struct(F.col("key_b").alias("key"), F.col("n_b").alias("n")))).alias("m")).distinct()
    sizes = stored(members.groupBy("hub").agg(F.sum("m.n").alias("size")), "hub-sizes")
    cells = F.lit((sizes.agg(F.sum("size")).first()[0] or 0) // CELL + 1)
    blocks = F.ceil(F.col("size") * 2 / CELL)
    block = lambda c: F.pmod(F.xxhash64(F.lit(1), c), blocks)
    x, y = block("key_a"), block("key_b")
    cell = F.when(F.col("size") > CELL, F.xxhash64("hub", F.least(x, y), F.greatest(x, y))).otherwise(F.pmod(F.xxhash64("hub"), cells))
    return placed.join(sizes, "hub").select("key_a", "key_b", cell.alias("cell"))


def _confirmed(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(duplicate, original): pairs (cell, key_a, key_b) whose sets (to, key, bucket, set) are similar enough."""
    kinds = StructType([StructField(n, pairs.schema["key_a"].dataType) for n in ("duplicate", "original")])

    def run(p, s):
        lists = s["set"].combine_chunks()
        flat, n = lists.flatten().to_numpy(), pc.list_value_length(lists).to_numpy().astype(np.int64)
        start, bucket = np.cumsum(n) - n, s["bucket"].to_numpy()
        keys = s["key"].combine_chunks()
        a, b = (pc.index_in(p[c].combine_chunks(), value_set=keys).to_numpy() for c in ("key_a", "key_b"))
        good = np.zeros(len(a), bool)
        order = np.argsort(a, kind="stable")
        for same in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
            if not len(same):
                continue
            one = a[same[0]]
            own = flat[start[one]:start[one] + n[one]]
            for some in np.split(same, np.flatnonzero(np.diff(np.cumsum(n[b[same]]) // AT_ONCE)) + 1):
                k = n[b[some]]
                ends = np.cumsum(k)
                tokens = flat[np.arange(ends[-1]) + np.repeat(start[b[some]] - ends + k, k)]
                hit = own[np.minimum(np.searchsorted(own, tokens), len(own) - 1)] == tokens
                inter = np.add.reduceat(hit, ends - k, dtype=np.int64)
                good[some] = (inter >= least * (n[one] + k - inter) - 1e-9) & (bucket[b[some]] == bucket[one])
        kept = p.filter(pa.array(good))
        return pa.table({"duplicate": kept["key_b"], "original": kept["key_a"]})

    return pairs.groupBy("cell").cogroup(sets.groupBy("to")).applyInArrow(run, kinds)


def _links(rows: DataFrame, key: str, text: Column, buckets: list[str], least: float, k: int) -> tuple[DataFrame, DataFrame]:
    """(duplicate, original) between the first members of classes, and from later members of a class to its first.

    Sets are never written: they are 64 bits for each word, more than their texts. A table holds a digest and the prefix of each; two sets that are
    similar enough share SHARED of their rarest n - ceil(least * n) + SHARED shingles, or, if they are smaller, ceil(least * n) of all. Sizes, and the places
    of the first SHARED that are in both, bound the candidates. Texts of candidates alone are read again, and whole sets confirm them, in cells to which a set is sent once.
    """
    rows = rows.select(F.col(key).alias("key"), text.alias("text"), *buckets).where(F.lit(True) if not buckets else F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in buckets)))
    shingles, n = T.word_shingles(F.col("text"), k), F.size("set")
    frequent = _frequent(rows, shingles)
    digest = F.unhex(F.sha2(F.array_join(F.transform("set", lambda x: x.cast("string")), ","), 256))
    sets = rows.select("key", *buckets, shingles.alias("set")).select("key", *buckets, n.alias("n"), digest.alias("set_id"), "set")
    sets = stored(_with_prefixes(sets, frequent, least), "prefixes").where("n > 0")
    heads = stored(sets.groupBy(*buckets, "set_id").agg(F.min("key").alias("head"), F.count("*").alias("rows")).where("rows > 1").drop("rows"), "heads")
    same = sets.select("key", *buckets, "set_id").join(heads, [*buckets, "set_id"]).where(F.col("key") > F.col("head"))
    same = stored(same.select(F.col("key").alias("duplicate"), F.col("head").alias("original")), "copies")
    later = filter_of(same, "duplicate")
    first = cannot_be_in(sets, F.col("key"), later).unionByName(may_be_in(sets, F.col("key"), later).join(same.select(F.col("duplicate").alias("key")), "key", "left_anti").select(*sets.columns))
    each = first.select("key", "n", *buckets, F.posexplode("prefix").alias("at", "token")).select(F.xxhash64("token", *buckets).alias("token"), "key", "n", "at")
    a, b = (each.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("key", "n", "at"))) for s in "ab")
    # Fewer than SHARED shingles that are shared lie before one of the first SHARED, all others behind it.
    need = (F.col("n_a") + F.col("n_b")) * F.lit(least / (1 + least)) - 1e-6 - (SHARED - 1)
    fits = (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * F.lit(least) - 1e-9) & (F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= need)
    met = a.join(b, "token").where((F.col("key_a") < F.col("key_b")) & fits).groupBy("key_a", "key_b", "n_a", "n_b").agg(F.count("*").alias("shared"))
    pairs = met.where(F.col("shared") >= F.least(F.lit(SHARED), F.ceil(F.least("n_a", "n_b") * F.lit(least) - 1e-9))).drop("shared")
    pairs = stored(_cells(stored(pairs, "pairs")), "cells")
    sent = pairs.select(F.col("cell").alias("to"), F.explode(F.array("key_a", "key_b")).alias("key")).distinct()
    texts = may_be_in(rows, F.col("key"), filter_of(sent, "key")).join(sent, "key")
    whole = texts.select("to", "key", F.xxhash64(F.lit(1), *buckets).alias("bucket"), shingles.alias("set"))
    return _confirmed(pairs, whole, least), same


def duplicate_links(rows: DataFrame, key: str, text: Column, buckets: list[str], least: float = 0.85, k: int = 3) -> DataFrame:
    """(duplicate, original): records of one bucket whose k-word shingle sets have a Jaccard similarity of least or more, the smaller key first.

    Records with equal sets are one class; its later members link to its first, and only first members are compared.
    """
    between, same = _links(rows, key, text, buckets, least, k)
    return between.unionByName(same)


def mark_duplicates(rows: DataFrame, key: str, text: Column, buckets: list[str], least: float = 0.85) -> DataFrame:
    """Adds duplicate_of, the least key that a row is a duplicate of, and status, rejected for duplicates.

    What the first of a class links to, its later members are duplicates of too, so they get the lesser of both. The
    least links of first members are written once, as two steps read them."""
    between, same = _links(rows, key, text, buckets, least, 3)
    near = stored(between.groupBy("duplicate").agg(F.min("original").alias("duplicate_of")), "least-links")
    copies = same.join(near.select(F.col("duplicate").alias("original"), "duplicate_of"), "original", "left").select("duplicate", F.least("original", "duplicate_of").alias("duplicate_of"))
    first = near.unionByName(copies).groupBy("duplicate").agg(F.min("duplicate_of").alias("duplicate_of"))
    out = rows.join(first, rows[key] == first["duplicate"], "left").drop("duplicate")
    return out.withColumn("status", F.when(F.col("duplicate_of").isNotNull(), "rejected").otherwise("accepted"))
