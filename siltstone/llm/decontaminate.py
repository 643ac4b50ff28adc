"""Benchmark decontamination as a prefix-filtered set join, with DataFrame functions only.

Every window of a benchmark item asks for whole containment, so a necessary prefix holds one word: the
one that is rarest in all documents. Documents are probed at the positions of prefix words alone; there
the item-sized window must fit (length and position bounds) and then match word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import ascii_lower, filter_of, gathered, may_be_in, stored, without

WINDOW = 10
#: The probe table is broadcast up to so many windows and bytes of their words; beyond, documents meet it in a shuffled join.
BROADCAST_WINDOWS, BROADCAST_BYTES = 100_000, 16_000_000

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), F.lit(0))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(win, items): distinct windows as word arrays, and the ids, as strings, of the items that have them."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    each = w.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at"), window).alias("win"))
    return each.groupBy("win").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _with_prefix(windows: DataFrame, docs: DataFrame, few: bool, words_there: int) -> DataFrame:
    """(id, win, len, prefix, off): the rarest word of each window, and its first place there. Rarity counts all documents; ties go by the word.
    words_there: how many words the windows have at most."""
    vocabulary = windows.select(F.explode("win").alias("word")).distinct()
    seen = docs.select(F.explode(words(F.col("text"))).alias("word"))
    kept = seen.join(F.broadcast(vocabulary) if few else vocabulary, "word", "left_semi")
    # Written, as adaptive execution doesn't split a join that shares its stage with an aggregate; a word can be in most windows.
    rarity = stored(gathered(kept.groupBy("word").agg(F.count("*").alias("n")), words_there), "rarity")
    each = windows.select("id", F.posexplode("win").alias("off", "word")).join(rarity, "word", "left")
    first = each.groupBy("id").agg(F.min(F.struct(F.coalesce("n", F.lit(0).cast("long")), "word", "off")).alias("p"))
    return windows.select("id", "win").join(first, "id").select("id", "win", F.size("win").alias("len"), F.col("p.word").alias("prefix"), F.col("p.off").alias("off"))


def _prepared(docs: DataFrame, benchmark: DataFrame, window: int, broadcast_windows: int) -> tuple[DataFrame, DataFrame, bool]:
    """Written windows (id, win, items) and their probe table, and whether it may be broadcast."""
    chars = benchmark.agg(F.sum(F.char_length("text"))).first()[0] or 0  # at least twice the words, and so the windows, but for one an item
    windows = stored(gathered(item_windows(benchmark, window), chars).withColumn("id", F.monotonically_increasing_id()), "windows")
    size = windows.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.array_join("win", " "))).alias("bytes")).first()
    few = size["n"] <= broadcast_windows and (size["bytes"] or 0) <= BROADCAST_BYTES
    probe = _with_prefix(windows, docs, few, window * size["n"])
    return windows, stored(gathered(probe, 4 * size["n"]), "probe"), few  # a row is as wide as several narrow ones


def _probed(docs: DataFrame, probe: DataFrame, few: bool, window: int) -> DataFrame:
    """(doc_id, key, n_words, start, len, id): a row for each document, which has n_words, and one for each occurrence of a window."""
    d = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), words(F.col("text")).alias("w"))
    start = F.col("pos") - F.col("off")
    fits = (F.col("word") == F.col("prefix")) & (start >= 0)
    none = [F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("len"), F.lit(None).cast("long").alias("id")]
    if few:
        # The word null before all others stands for the document itself, so that one walk gives both kinds of rows.
        each = d.select("doc_id", "key", "w", F.posexplode(F.concat(F.array(F.lit(None).cast("string")), F.col("w"))).alias("place", "word")).withColumn("pos", F.col("place") - 1)
        good = fits & (start + F.col("len") <= F.size("w")) & (F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("len")) == F.col("win"))
        met = each.join(F.broadcast(probe), good, "left").where((F.col("place") == 0) | F.col("id").isNotNull())
        return met.select("doc_id", "key", F.when(F.col("place") == 0, F.size("w")).cast("long").alias("n_words"), start.alias("start"), "len", "id")
    # Rows shuffled by word carry the words around it only, so their size has a bound; words that are no prefix stay where they are.
    place = F.transform("w", lambda x, i: F.struct(x.alias("word"), i.alias("pos"), F.least(i, F.lit(window - 1)).alias("left"),
                                                   F.slice("w", F.greatest(i - window + 2, F.lit(1)), F.least(i, F.lit(window - 1)) + window).alias("near")))
    each = may_be_in(d.select("doc_id", "key", F.size("w").alias("n"), F.inline(place)), F.col("word"), filter_of(probe, "prefix"))
    inner = F.col("left") - F.col("off")
    met = each.join(probe, fits & (start + F.col("len") <= F.col("n")) & (F.slice("near", F.greatest(inner, F.lit(0)) + 1, F.col("len")) == F.col("win")))
    found = met.select("doc_id", "key", F.lit(None).cast("long").alias("n_words"), start.alias("start"), "len", "id")
    return d.select("doc_id", "key", F.size("w").cast("long").alias("n_words"), *none).unionByName(found)


def hits(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(doc_id, key, start, len, items) of each occurrence of an item window in a document; start counts words from 0.
    key is a fingerprint of the text, which tells rows with one doc_id apart."""
    windows, probe, few = _prepared(docs, benchmark, window, broadcast_windows)
    return _probed(docs, probe, few, window).where("id IS NOT NULL").join(windows.select("id", "items"), "id").select("doc_id", "key", "start", "len", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null text has no words; items without words have no windows; an item of fewer words than a window is
    one window. A null item_id counts its words as hit but is no item. Rows that repeat a doc_id are judged
    each by its own text. With an empty benchmark nothing is hit; empty docs give an empty result. Only
    doc_id, item_id and text are read.
    """
    windows, probe, few = _prepared(docs, benchmark, window, broadcast_windows)
    span = F.when(F.col("id").isNotNull(), F.struct("start", (F.col("start") + F.col("len")).alias("end")))
    per = _probed(docs, probe, few, window).groupBy("doc_id", "key").agg(F.count("n_words").alias("copies"), F.max("n_words").alias("n_words"), F.collect_set(span).alias("spans"), F.collect_set("id").alias("ids"))
    covered = F.aggregate(F.array_sort("spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
                          lambda a, x: F.struct((a["n"] + F.greatest(x["end"] - F.greatest(x["start"], a["to"]), F.lit(0))).alias("n"), F.greatest(a["to"], x["end"]).alias("to")), lambda a: a["n"])
    per = stored(per.select("doc_id", "key", "copies", "n_words", covered.cast("long").alias("n_hit"), "ids"), "judged")
    named = per.select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), F.explode("ids").alias("id")).join(windows.select("id", "items"), "id")
    named = named.groupBy("_doc", "_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    out = per.join(named, per["doc_id"].eqNullSafe(named["_doc"]) & (per["key"] == named["_key"]), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    out = out.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"))
    return out.drop("_copy")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """docs without the documents that hold a window of an item."""
    gone = hits(docs, benchmark, window=window).select(F.col("doc_id").alias("_gone"), F.col("key").alias("_key")).distinct()
    rows = docs.count()
    gone = stored(gathered(gone, rows), "gone")
    return without(docs, gone, docs["doc_id"].eqNullSafe(gone["_gone"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["_key"]), rows)
