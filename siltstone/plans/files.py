"""Queries that write files into the shared folder and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siltstone.engine import shared_dir
from siltstone.operators import reports
from siltstone.plans import inputs as I
from siltstone.sources import jsonl

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _path(spark, name: str) -> str:
    return f"{shared_dir(spark)}/siltstone-{name}-{uuid.uuid4().hex}"


@query("SELECT conv_id, turn, role, nullif(text, '') AS text FROM conversations")
def jsonl_roundtrip(spark, d):
    """Null fields are left out of the lines and read as null again."""
    path, rows = _path(spark, "jsonl"), I.table(spark, d, "conversations").select("conv_id", "turn", "role", F.nullif("text", F.lit("")).alias("text"))
    jsonl.write_jsonl(rows, path, ["conv_id", "turn"], keep_nulls=False)
    return jsonl.read_jsonl(spark, path, "conv_id bigint, turn int, role string, text string").select("conv_id", "turn", "role", "text")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def csv_roundtrip(spark, d):
    path, rows = _path(spark, "csv"), I.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    jsonl.write_csv(rows, path)
    return spark.read.option("header", True).schema(rows.schema).csv(path)


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def allowed_ids(spark, d):
    """Rows whose id is on a written list, in which ids repeat and lines are blank."""
    path, ids = _path(spark, "ids"), I.table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("value"))
    ids.unionByName(ids).unionByName(ids.limit(1).select(F.lit("  ").alias("value"))).write.text(path)
    known = jsonl.read_ids(spark, path).select(F.col("id").cast("long").alias("doc_id"))
    return I.table(spark, d, "documents").select("doc_id").join(known, "doc_id", "left_semi")


@query("SELECT '{' || string_agg('\"' || lang || '\":' || n, ',' ORDER BY lang) || '}' AS document FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)")
def counts_document(spark, d):
    return jsonl.json_document(reports.breakdown(I.table(spark, d, "documents"), "lang"), "lang", "n")
