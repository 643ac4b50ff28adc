"""Documents and chunks: licences, splits, screening, cleaning, chunking and packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.engine import stored
from siltstone.functions import text as T


def classify_license(docs: DataFrame, allow: tuple[str, ...] = T.ALLOW, flag: tuple[str, ...] = T.FLAG) -> DataFrame:
    """Adds verdict and restricted (any verdict but ALLOWED)."""
    out = docs.withColumn("verdict", T.license_verdict(F.col("license"), allow, flag))
    return out.withColumn("restricted", F.col("verdict") != "ALLOWED")


def assign_splits(docs: DataFrame, eval_percent: int = 10) -> DataFrame:
    """Gives a split to documents that have none; others keep theirs."""
    given = F.col("split") if "split" in docs.columns else F.lit(None).cast("string")
    return docs.withColumn("split", T.or_else(given, T.split_of(F.col("doc_id"), eval_percent)))


def first_of_title(docs: DataFrame, title: Column) -> DataFrame:
    """Adds norm_title and canonical_id, the least doc_id of the same normal title. Blank titles stand for themselves.

    The least id comes from an aggregate with map-side combining, which is written, so that adaptive execution can split
    the join back where a title is common: it doesn't split a join that shares its stage with an aggregate."""
    named = docs.withColumn("norm_title", T.normal_title(title))
    least = stored(named.where("norm_title <> ''").groupBy("norm_title").agg(F.min("doc_id").alias("_least")), "titles")
    return named.join(least, "norm_title", "left").withColumn("canonical_id", F.coalesce("_least", "doc_id")).drop("_least")


def first_of_work(docs: DataFrame, title: Column, doi: Column) -> DataFrame:
    """first_of_title, and titles that share a DOI are one work too: its canonical_id is the least of theirs. Blank DOIs join nothing."""
    named = first_of_title(docs.withColumn("_doi", F.nullif(F.lower(T.strip(doi)), F.lit(""))), title)
    heads = named.where("_doi IS NOT NULL").groupBy("_doi").agg(F.min("canonical_id").alias("_first"))
    heads = named.where("_doi IS NOT NULL").select("_doi", "canonical_id").distinct().join(heads, "_doi").groupBy("canonical_id").agg(F.min("_first").alias("_first"))
    heads = stored(heads.where("_first < canonical_id"), "works")
    return named.join(heads, "canonical_id", "left").withColumn("canonical_id", F.coalesce("_first", "canonical_id")).drop("_first", "_doi")


def sections(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, section, level, path, text): a page cut at its headings h1 to h6. path: the heading and those that it stands under.

    What comes before the first heading is section 0 with an empty path. Scripts, styles and comments go, tags become
    spaces, white space is single. A null page has no section. One page's sections come from one row; nothing is shuffled.
    """
    heading = r"(?is)<h([1-6])(?:\s[^>]*)?>(.*?)</h[1-6]\s*>"
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", " "), r"\s+", " "))
    clean = F.regexp_replace(F.col(html), r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", " ")
    found = lambda i: F.regexp_extract_all("_clean", F.lit(heading), F.lit(i))
    cut = pages.select(F.col(key), clean.alias("_clean")).where("_clean IS NOT NULL")
    cut = cut.select(key, F.zip_with(found(1), found(2), lambda a, b: F.struct(a.cast("int").alias("level"), plain(b).alias("title"))).alias("_heads"), F.split("_clean", heading).alias("_bodies"))
    none = F.array_repeat(F.lit(None).cast("string"), F.lit(6))
    zero = F.struct(none.alias("open"), F.array().cast("array<array<string>>").alias("paths"))

    def add(a: Column, x: Column) -> Column:
        now = F.transform(a["open"], lambda t, j: F.when(j == x["level"] - 1, x["title"]).when(j < x["level"], t))
        return F.struct(now.alias("open"), F.concat(a["paths"], F.array(F.array_compact(now))).alias("paths"))

    paths = F.aggregate("_heads", zero, add, lambda a: a["paths"])
    cut = cut.select(key, "_heads", "_bodies", paths.alias("_paths")).select(key, "_heads", "_paths", F.posexplode("_bodies").alias("section", "_body"))
    at = F.col("section") - 1
    return cut.select(key, "section", F.coalesce(F.get("_heads", at)["level"], F.lit(0)).alias("level"), F.coalesce(F.get("_paths", at), F.array().cast("array<string>")).alias("path"), plain(F.col("_body")).alias("text"))


def screen(docs: DataFrame, text: Column, must: list[list[str]], boost: dict[str, list[str]], accept: int = 1, license: Column | None = None) -> DataFrame:
    """Adds relevance and screening: words within a must group are alternatives, all groups are needed; boost groups
    that occur add to relevance. accepted from ``accept`` boosts on, else borderline; rejected without all groups, and, where a
    license is given, for one that may neither be published nor flagged."""
    w = T.words(text)
    some = lambda terms: F.arrays_overlap(w, F.array(*map(F.lit, terms)))
    needed = F.lit(True)
    for group in must:
        needed = needed & some(group)
    if license is not None:
        needed = needed & (T.license_verdict(license) != "REJECTED")
    relevance = sum((some(terms).cast("int") for terms in boost.values()), F.lit(0))
    verdict = F.when(~F.col("_all"), "rejected").when(F.col("relevance") >= accept, "accepted").otherwise("borderline")
    return docs.withColumns({"_all": needed, "relevance": relevance}).withColumn("screening", verdict).drop("_all")


def drop_garbled(rows: DataFrame, text: Column, most: float = 0.10) -> DataFrame:
    """Adds garble and keeps rows up to most."""
    return rows.withColumn("garble", T.garble_ratio(text)).where(F.col("garble") <= most)


def _starts(parts: str, size: Callable[[Column], Column], budget: int) -> Column:
    """Where groups begin, from 0, when the parts of an array are gathered in order while their sizes stay within budget.
    Only group starts are kept while the array is read, so the work is about linear in its length."""
    zero = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("at"), F.lit(0).cast("long").alias("n"))

    def step(a: Column, x: Column) -> Column:
        fresh = (a["at"] == 0) | (a["n"] + size(x) > budget)
        return F.struct(F.when(fresh, F.concat(a["starts"], F.array(a["at"]))).otherwise(a["starts"]).alias("starts"), (a["at"] + 1).alias("at"), F.when(fresh, size(x)).otherwise(a["n"] + size(x)).alias("n"))

    return F.aggregate(parts, zero, step, lambda a: a["starts"])


def _groups(parts: str, starts: str, then: Callable[[Column], Column]) -> Column:
    """then(slice) for each group."""
    cut = F.transform(starts, lambda s, i: F.slice(parts, s + 1, F.coalesce(F.get(starts, i + 1), F.size(parts)) - s))
    return F.transform(cut, then)


def _pieces(line: Column, most: int) -> Column:
    """A long line as sentences; a sentence that is still too long as runs of so many tokens."""
    def runs(t: Column) -> Column:
        at = lambda w: F.transform(F.sequence(F.lit(0), F.ceil(F.size(w) / most).cast("int") - 1), lambda i: F.array_join(F.slice(w, i * most + 1, most), " "))
        return F.when(T.token_count(t) <= most, F.array(t)).otherwise(F.transform(F.array(T.tokens(t)), at)[0])

    return F.flatten(F.transform(F.split(line, r"(?<=[.!?])\s+"), runs))


def chunk(docs: DataFrame, target: int = 1500, overlap: int = 0, most: int | None = None, count: Callable[[Column], Column] = T.token_count) -> DataFrame:
    """(chunk_id, doc_id, order, tokens, overlap_prev_tokens, text): lines of a document gathered until target tokens.

    Numbers in ids have two digits, or more from chunk 100 on. A line stays whole; with ``most``, a line of more tokens
    is cut at its sentences, and a sentence of more tokens after so many words. With overlap, a chunk begins with up to
    so many last words of the one before and a blank line. count: tokens of a text; words unless another counter is given.
    Null and blank texts have no chunk. One document's lines meet in one row only; nothing is shuffled.
    """
    part = lambda t, sep: F.struct(sep.alias("sep"), t.alias("text"), count(t).cast("long").alias("n"))
    lines = F.transform(F.filter(F.split("text", "\n"), lambda x: ~T.blank(x)), lambda x: part(x, F.lit("\n")))
    if most is not None:
        cut = lambda p: F.transform(_pieces(p["text"], most), lambda t, i: part(t, F.when(i == 0, "\n").otherwise(" ")))
        lines = F.flatten(F.transform(lines, lambda p: F.when(p["n"] <= most, F.array(p)).otherwise(cut(p))))
    # Each step reads the one before at least twice, so that the optimizer keeps them apart and nothing is found anew for each line.
    marked = docs.select("doc_id", lines.alias("parts")).select("doc_id", "parts", _starts("parts", lambda x: x["n"], target).alias("starts"))
    body = lambda p: F.struct(F.substring(F.array_join(F.transform(p, lambda x: F.concat(x["sep"], x["text"])), ""), 2, 2**31 - 1).alias("body"), F.aggregate(p, F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n"))
    bodies = marked.select("doc_id", _groups("parts", "starts", body).alias("all"))
    none = F.array().cast("array<string>")

    def tail(c: Column, i: Column) -> Column:
        last = F.transform(F.array(T.tokens(F.get("all", i - 1)["body"])), lambda w: F.slice(w, F.greatest(F.size(w) - overlap + 1, F.lit(1)), overlap))[0]
        return F.struct(c["body"].alias("body"), c["n"].alias("n"), F.when(i > 0, last).otherwise(none).alias("tail"))

    rows = F.transform("all", tail) if overlap else F.transform("all", lambda c: F.struct(c["body"].alias("body"), c["n"].alias("n"), none.alias("tail")))
    cut = bodies.select("doc_id", F.posexplode(rows).alias("order", "c"))
    text = F.when(F.size("c.tail") > 0, F.concat(F.array_join("c.tail", " "), F.lit("\n\n"), F.col("c.body"))).otherwise(F.col("c.body"))
    number = F.col("order").cast("string")
    return cut.select(F.concat(F.col("doc_id").cast("string"), F.lit("#c"), F.lpad(number, F.greatest(F.lit(2), F.length(number)), F.lit("0"))).alias("chunk_id"), "doc_id", "order",
                      F.col("c.n").alias("tokens"), F.size("c.tail").alias("overlap_prev_tokens"), text.alias("text"))


def pack(chunks: DataFrame, budget: int) -> DataFrame:
    """(doc_id, row, chunk_ids, tokens, text): a document's chunks in order, joined by a blank line while they fit the budget.

    Rows never cross documents. A chunk over the budget is a row of its own. Overlap with the chunk before is cut.
    Blank chunks go. A document's chunks meet in one row of an aggregate; it grows with the longest document only.
    """
    body = T.without_overlap(F.col("text"), F.col("overlap_prev_tokens"))
    part = F.struct("order", "chunk_id", F.col("tokens").cast("long").alias("tokens"), body.alias("text"))
    per = chunks.where(~T.blank(body)).groupBy("doc_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    marked = per.select("doc_id", "parts", _starts("parts", lambda x: x["tokens"], budget).alias("starts"))
    row = lambda p: F.struct(F.transform(p, lambda x: x["chunk_id"]).alias("chunk_ids"), F.aggregate(p, F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("tokens"), F.array_join(F.transform(p, lambda x: x["text"]), "\n\n").alias("text"))
    packed = marked.select("doc_id", F.posexplode(_groups("parts", "starts", row)).alias("row", "r"))
    return packed.select("doc_id", "row", "r.chunk_ids", "r.tokens", "r.text")


def link_images(rows: DataFrame, files: DataFrame) -> DataFrame:
    """(chunk_id, doc_id, images): paths of image files whose name a chunk refers to, by name; names without a file go, and chunks without any."""
    base = lambda c: F.element_at(F.split(c, "/"), -1)
    named = rows.select("chunk_id", "doc_id", F.explode("images").alias("image")).select("chunk_id", "doc_id", base(F.col("image")).alias("name"))
    pictures = files.where("kind = 'image'").select("doc_id", base(F.col("path")).alias("name"), "path")
    met = named.join(pictures, ["doc_id", "name"])
    return met.groupBy("chunk_id", "doc_id").agg(F.array_sort(F.collect_set("path")).alias("images"))

