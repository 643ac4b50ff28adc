"""Bounded samples of labelled and unlabelled documents. Whole texts stay in a written table; the driver gets what is made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import gathered, stored

#: Documents of a sample, at most.
SAMPLE_ROWS = 4000


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves part over parts; ids that are null are held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == part, F.lit(True))


def drawn(docs: DataFrame, ids: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, y, text), a written table of whole texts: up to rows documents for the rows (doc_id, y) of ids that come
    first by a hash of the id, texts of any length. Null texts are empty. An id that docs repeat gives one row, its least text."""
    first = ids.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    d = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    got = d.join(F.broadcast(first), "doc_id")  # rows bounds what is broadcast
    got = got.groupBy("doc_id").agg(F.first("y").alias("y"), F.min("text").alias("text"))
    return stored(gathered(got, 50 * rows), "sample")  # a whole text is as wide as many narrow rows


def training_labels(labels: DataFrame, column: str, parts: int, part: int) -> DataFrame:
    """(doc_id, y) of labelled rows outside the held-out part; a document with both labels counts as 1."""
    y = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), parts, part))
    return y.groupBy("doc_id").agg(F.max(F.col(column)).cast("int").alias("y"))
