"""Exact duplicates by deterministic block naming, with DataFrame functions only.

A normalised text is cut into blocks of a fixed number of characters. All distinct blocks are
sorted within hash buckets, and bucket and rank make the block's integer name. Rounds then name
adjacent pairs of names in the same way, until each document is one name: equal names, equal texts.
No step trusts a hash: a fingerprint only routes a block to the sorted bucket that names it, and
blocks which share a fingerprint are told apart by their content.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.llm.common import dealt, gathered, stored, without

#: Characters of a block, and distinct blocks (about) in a sorted bucket.
BLOCK_CHARS = 4096
BUCKET_BLOCKS = 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _blocks(text: Column, chars: int) -> Column:
    cut = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{chars}}}+"), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(cut)


def _named_blocks(rows: DataFrame, fingerprint: Callable[[Column], Column], buckets: int) -> DataFrame:
    """(h, name, twin, block): one row for each distinct block. twin: others have its fingerprint too;
    only then is the block itself kept. collect_set drops copies before the shuffle."""
    each = rows.select(F.explode("blocks").alias("block"))
    each = each.select(F.pmod(fingerprint(F.col("block")).cast("long"), F.lit(buckets)).alias("bucket"), "block")
    sets = each.groupBy("bucket").agg(F.array_sort(F.collect_set("block")).alias("sorted"))
    sets = sets.withColumn("hs", F.transform("sorted", lambda b: fingerprint(b).cast("long")))
    sets = sets.withColumn("clean", F.size(F.array_distinct("hs")) == F.size("hs"))
    one = sets.select("bucket", "hs", "clean", F.posexplode("sorted").alias("rank", "block"))
    h = F.element_at("hs", F.col("rank") + 1)
    twin = ~F.col("clean") & (F.size(F.filter("hs", lambda x: x == h)) > 1)
    named = one.select(h.alias("h"), (F.shiftleft(F.col("bucket").cast("long"), 32) + F.col("rank")).alias("name"), twin.alias("twin"), "block")
    return named.withColumn("block", F.when(F.col("twin"), F.col("block")))


def _named_pairs(pairs: DataFrame, buckets: int) -> DataFrame:
    """(l, r, name) of each distinct pair: rank within a sorted hash bucket."""
    distinct = pairs.select("l", "r").distinct().withColumn("bucket", F.pmod(F.xxhash64("l", "r"), F.lit(buckets)))
    rank = F.row_number().over(W.partitionBy("bucket").orderBy("l", "r"))
    return distinct.select("l", "r", (F.shiftleft(F.col("bucket").cast("long"), 32) + rank).alias("name"))


def exact_groups(docs: DataFrame, *, block_chars: int = BLOCK_CHARS, fingerprint: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and all empty texts are one group. Rows that repeat a doc_id are rows of
    their own in group_size; with equal texts they stay or go together. A null doc_id is never keep_id
    unless its whole group has none. An empty table gives an empty result. Only doc_id and text are
    read, so other columns can't clash. Very long texts take one more round for each doubling.
    """
    text = normalised(F.col("text"))
    rows = docs.select("doc_id", text.alias("t")).select("doc_id", F.sha2(F.col("t"), 256).alias("sha"), _blocks(F.col("t"), block_chars).alias("blocks"))

    size = int(docs.select(F.sum(F.ceil(F.char_length(F.coalesce(F.col("text"), F.lit(""))) / block_chars) + 1)).first()[0] or 1)
    buckets = max(1, math.ceil(size / BUCKET_BLOCKS))
    # No table on the way has more rows than size. The tasks that sort blocks stay as many as they are.
    names = stored(dealt(_named_blocks(rows, fingerprint, buckets), size), "block-names")
    clash = not names.where("twin").isEmpty()

    hashes = F.transform("blocks", lambda b: fingerprint(b).cast("long"))
    if clash:
        seen = rows.select("doc_id", "sha", F.size("blocks").alias("n"), F.posexplode(F.arrays_zip(hashes.alias("h"), F.col("blocks").alias("b"))).alias("pos", "x"))
        seen = seen.select("doc_id", "sha", "n", "pos", F.col("x.h").alias("h"), F.col("x.b").alias("b"))
        met = (seen["h"] == names["h"]) & (~names["twin"] | (seen["b"] == names["block"]))
    else:
        seen = rows.select("doc_id", "sha", F.size("blocks").alias("n"), F.posexplode(hashes).alias("pos", "h"))
        met = seen["h"] == names["h"]
    level = seen.join(names, met).select("doc_id", "sha", "n", "pos", "name", F.lit(1).cast("long").alias("m"))
    level = stored(gathered(level, 2 * size), "block-ids")  # a row holds 64 characters of sha

    done = [level.where("n = 1").select("doc_id", "sha", "m", F.lit(0).alias("level"), "name")]
    longest = level.agg(F.max("n")).first()[0] or 1
    current, counted = level.where("n > 1"), False
    for k in range(1, math.ceil(math.log2(longest)) + 1 if longest > 1 else 1):
        even = F.col("pos") % 2 == 0
        many = F.max("m") if counted else F.sum(F.when(even, F.col("m")))
        pairs = current.groupBy("doc_id", "sha", "n", (F.col("pos") / 2).cast("int").alias("at")).agg(
            F.max(F.when(even, F.col("name"))).alias("l"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1).cast("long")).alias("r"), many.alias("m"))
        pairs, counted = stored(gathered(pairs, size), f"pairs-{k}"), True
        met = pairs.join(_named_pairs(pairs, max(1, buckets // 8)), ["l", "r"])
        current = met.select("doc_id", "sha", ((F.col("n") + 1) / 2).cast("int").alias("n"), F.col("at").alias("pos"), "name", "m")
        current = stored(gathered(current, size), f"names-{k}")
        done.append(current.where("n = 1").select("doc_id", "sha", "m", F.lit(k).alias("level"), "name"))
        current = current.where("n > 1")
    ids = done[0]
    for more in done[1:]:
        ids = ids.unionByName(more)
    # Written, as adaptive execution doesn't split a join that shares its stage with an aggregate; a large group of copies is one name.
    groups = ids.groupBy("level", "name").agg(F.min("doc_id").alias("keep_id"), F.sum("m").alias("group_size"))
    groups = stored(gathered(groups, size), "groups")
    out = ids.join(groups, ["level", "name"])
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact(docs: DataFrame) -> DataFrame:
    """docs without the later copies: of equal texts the row with the smallest doc_id stays; rows with a null doc_id stay.

    Rows go by doc_id and normalised text together. Of rows that repeat a doc_id, one with a text of its own stays when
    another is a copy; rows that repeat both doc_id and text stay or go together, as nothing tells them apart."""
    gone = exact_groups(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.col("text_sha256").alias("_sha"))
    rows = docs.count()
    gone = stored(gathered(gone, rows), "gone")
    return without(docs, gone, (docs["doc_id"] == gone["_gone"]) & (F.sha2(normalised(docs["text"]), 256) == gone["_sha"]), rows)
