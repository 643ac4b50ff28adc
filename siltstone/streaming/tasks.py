"""Append-only inputs as a stream that takes what is there and ends; state lives in a table keyed by task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest(spark: SparkSession, path: str, schema: str, checkpoint: str, target: str, key: str, order: str) -> DataFrame:
    """Reads new files under path once each and appends the newest row of each key of a batch to target; gives the newest row of each key over all batches.

    A batch that is run again overwrites its own folder, so a lost driver doesn't double rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        newest = batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), order).alias("_r")).select("_r.*")
        newest.write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = spark.readStream.schema(schema).parquet(path).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.schema(f"{schema}").parquet(target)
    names = [c for c in rows.columns if c != "batch"]
    return rows.groupBy(key).agg(F.max_by(F.struct(*names), order).alias("_r")).select("_r.*")
