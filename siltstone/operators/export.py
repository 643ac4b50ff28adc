"""Training exports, their attribution and the licence gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.engine import numbered
from siltstone.functions import text as T

SYSTEM_PROMPT = "You are a careful expert. Answer from evidence and say what is uncertain."


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def exportable(records: DataFrame, docs: DataFrame, status: str) -> DataFrame:
    """Records of a status whose first document has a split and isn't blacklisted, with the document's split, licence, title and key (DOI, else id)."""
    d = docs.where("split IS NOT NULL AND split <> '' AND NOT coalesce(blacklisted, false)")
    d = d.select(F.col("doc_id").alias("source_doc"), "split", F.col("license").alias("source_license"), "title", T.or_else(F.col("doi"), F.col("doc_id").cast("string")).alias("source_key"))
    r = records.where(F.col("status") == status).drop("split").withColumn("source_doc", F.try_element_at("doc_ids", F.lit(1)))
    return r.join(d, "source_doc")


def sft_rows(qa: DataFrame, negatives: DataFrame, docs: DataFrame, system: str = SYSTEM_PROMPT) -> DataFrame:
    """(split, row_index, id, messages, source columns): accepted questions, then generated negatives, numbered within each split."""
    q = exportable(qa, docs, "accepted").select(
        F.lit(0).alias("kind_order"), "id", "split", "source_doc", "source_key", "source_license", "title",
        F.concat(F.array(_message("system", T.or_else(F.col("system"), F.lit(system)))), F.col("turns")).alias("messages"))
    n = exportable(negatives, docs, "generated").select(
        F.lit(1).alias("kind_order"), "id", "split", "source_doc", "source_key", "source_license", "title",
        F.array(_message("system", F.lit(system)), _message("user", F.col("prompt")), _message("assistant", F.col("expert_response"))).alias("messages"))
    return numbered(q.unionByName(n), ["kind_order", "id"], "split")


def cpt_rows(chunks: DataFrame, docs: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """(split, row_index, id, text, source columns): chunks with text of exportable documents; extra rows (id, text, license, title) come last and in train only."""
    c = chunks.where(~T.blank(F.col("text"))).select(F.col("chunk_id").alias("id"), F.array("doc_id").alias("doc_ids"), "text", F.lit("ready").alias("status"))
    rows = exportable(c, docs, "ready").select(F.lit(0).alias("kind_order"), "id", "split", F.col("source_doc").cast("string").alias("source_doc"), "source_key", "source_license", "title", "text")
    if extra is not None:
        rows = rows.unionByName(extra.select(F.lit(1).alias("kind_order"), "id", F.lit("train").alias("split"), F.lit(None).cast("string").alias("source_doc"), F.col("id").alias("source_key"), F.col("license").alias("source_license"), "title", "text"))
    return numbered(rows, ["kind_order", "id"], "split")


def dpo_rows(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    return numbered(exportable(pairs, docs, "generated").select("id", "split", "source_doc", "source_key", "source_license", "title", "prompt", "chosen", "rejected"), ["id"], "split")


def invalid_rows(rows: DataFrame, kind: str) -> DataFrame:
    """Rows that training can't use, with error: a cpt row without text; an sft row without messages or without an assistant's."""
    if kind == "cpt":
        error = F.when(T.blank(F.col("text")), "no text")
    else:
        answers = F.exists("messages", lambda m: m["role"] == "assistant")
        error = F.when(F.coalesce(F.size("messages"), F.lit(0)) <= 0, "no messages").when(~answers, "no assistant message")
    return rows.withColumn("error", error).where("error IS NOT NULL")


def attribution(rows: DataFrame) -> DataFrame:
    """(split, source_key, license, title, row_indexes): which rows of an export come from which source."""
    return rows.groupBy("split", "source_key").agg(F.min("source_license").alias("license"), F.min("title").alias("title"), F.array_sort(F.collect_list("row_index")).alias("row_indexes"))


def attribution_union(*manifests: DataFrame) -> DataFrame:
    """(source_key, license, n_rows) over all manifests of a release."""
    every = manifests[0]
    for m in manifests[1:]:
        every = every.unionByName(m)
    return every.groupBy("source_key").agg(F.min("license").alias("license"), F.sum(F.size("row_indexes")).alias("n_rows"))


def gate(rows: DataFrame, files: list[str] | None = None, allow: tuple[str, ...] = T.ALLOW) -> DataFrame:
    """(split, shareable, n_rows, restricted_rows, restricted_docs): a file may be shared if all its sources are allowed. Named files without rows aren't shareable."""
    bad = T.license_verdict(F.col("source_license"), allow) != "ALLOWED"
    out = rows.groupBy("split").agg(F.bool_and(~bad).alias("shareable"), F.count("*").alias("n_rows"), F.count_if(bad).alias("restricted_rows"), F.countDistinct(F.when(bad, F.col("source_key"))).alias("restricted_docs"))
    if files is None:
        return out
    named = rows.sparkSession.createDataFrame([(f,) for f in files], "split string")
    zero = F.lit(0).cast("long")
    return named.join(out, "split", "left").select("split", F.coalesce("shareable", F.lit(False)).alias("shareable"), *(F.coalesce(c, zero).alias(c) for c in ("n_rows", "restricted_rows", "restricted_docs")))


def without_restricted(rows: DataFrame, order: list[str], allow: tuple[str, ...] = T.ALLOW) -> DataFrame:
    """Rows of allowed sources, numbered anew; old_index keeps the former number."""
    good = rows.where(T.license_verdict(F.col("source_license"), allow) == "ALLOWED").withColumnRenamed("row_index", "old_index")
    return numbered(good, order, "split")


def manifest_without(manifest: DataFrame, restricted: DataFrame) -> DataFrame:
    """(split, sources): an attribution manifest as one map from source key to (license, title, row_indexes) for each split, without restricted (source_key).

    Meant for the manifest of one file, which its writer holds as one document; the rows themselves stay in ``attribution``."""
    entry = F.struct("license", "title", "row_indexes")
    maps = manifest.groupBy("split").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("source_key"), entry.alias("entry"))))).alias("sources"))
    bad = restricted.agg(F.collect_set("source_key").alias("_bad"))
    return maps.join(bad).select("split", F.map_filter("sources", lambda k, v: ~F.array_contains("_bad", k)).alias("sources"))
