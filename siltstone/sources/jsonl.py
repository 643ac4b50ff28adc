"""JSON lines, CSV and id lists. All paths go through Spark's readers and writers, so any store it knows will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jsonl(spark: SparkSession, path: str, schema: str, *, allow_empty: bool = False) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are skipped, text that is no object lands in _corrupt. Empty input is an error unless allowed."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    if not allow_empty and lines.isEmpty():
        raise ValueError(f"{path} has no rows")
    parsed = lines.select(F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    return parsed.select("r.*")


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None, *, keep_nulls: bool = True) -> None:
    """One object a line, non-ASCII text kept. order sorts the whole output by range, so its files in name order are in order."""
    rows = df.orderBy(*order) if order else df
    rows.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": str(not keep_nulls).lower()}).alias("value")).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> bool:
    """CSV with a header; nothing is written, and False returned, for an empty frame."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def read_ids(spark: SparkSession, path: str, column: str = "id") -> DataFrame:
    """Distinct ids, one a line; blank lines are skipped. Meant for a left semi join."""
    return spark.read.text(path).select(F.trim("value").alias(column)).where(F.col(column) != "").distinct()


def json_document(df: DataFrame, key: str, value: str, name: str = "document") -> DataFrame:
    """One row, one JSON object {key: value} by key. For small aggregates such as counts: a report, not a data path."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("key"), F.col(value).alias("value"))))
    return df.agg(F.to_json(F.map_from_entries(entries)).alias(name))
