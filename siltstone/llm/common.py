"""Helpers that the operators of this package share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.engine import FILTER_BITS, cannot_be_in, filter_of, may_be_in, stored

__all__ = ["ascii_lower", "bounded", "dealt", "filter_of", "gathered", "may_be_in", "shuffle_width", "stored", "table", "without"]

#: ASCII letters; ``lower`` alone would also fold letters beyond ASCII.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone. Texts of ASCII only take the engine's fast path."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded(batches: Iterator[pa.RecordBatch], column: int, rows: int, size: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of batches with at most so many rows and bytes of a text column, unless one text alone has more. Null texts have none.
    After each batch the worker gives back memory that Arrow holds but doesn't use; idle workers stay, and count with their executor."""
    for batch in batches:
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)).cast(pa.int64()), 0)).to_pylist()
        at, before = 0, 0
        for i, end in enumerate(ends):
            if i > at and (i - at >= rows or end - before > size):
                yield batch.slice(at, i - at)
                at, before = i, ends[i - 1]
        if at < batch.num_rows:
            yield batch.slice(at)
        del batch
        pa.default_memory_pool().release_unused()


def few_files(rows: int) -> int:
    """Files for so many narrow rows: one for 25,000, up to 8, and beyond 1.6 million one for 200,000."""
    return max(1, min(8, -(-rows // 25_000)), -(-rows // 200_000))


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """df in as many partitions as so many narrow rows need, so that small tables don't become a file for each shuffle partition.
    Never more partitions than df has, so that large tables stay as they are."""
    return df.coalesce(few_files(rows))


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """df in as many partitions as so many narrow rows need, by a shuffle of its rows: for few rows that many long tasks return, which
    would each write a file. The tasks stay as many as they are."""
    return df.repartition(few_files(rows))


def without(docs: DataFrame, gone: DataFrame, same: Column, rows: int) -> DataFrame:
    """docs, of so many rows, without those that have a match in gone, a written table with the ids as _gone; same must ask for equal ids, too.

    Rows whose id can't be among those, by a filter of 2 MB, stay where they are; only the others are shuffled to the join, a
    merge join at any size, so that cost grows with the input alone. Hardly any of those stay, so few partitions come out of it. docs is read twice.
    """
    bits = filter_of(gone, "_gone")
    some = may_be_in(docs, docs["doc_id"], bits)
    # An anti join would be pushed below the filter, and all rows shuffled to it.
    met = some.join(gone.withColumn("_siltstone_hit", F.struct("_gone")).hint("merge"), same, "left")
    kept = met.where(F.col("_siltstone_hit").isNull()).select(*(some[c] for c in docs.columns))
    n = gone.count()
    met_rows = n + math.ceil(rows * min(1, n / FILTER_BITS))
    return cannot_be_in(docs, docs["doc_id"], bits).unionByName(gathered(kept, 8 * met_rows))  # a document is as wide as several narrow rows
