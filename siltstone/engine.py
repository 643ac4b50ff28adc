"""Tables in the shared folder, global numbering of rows, and filters of a fixed size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bits of a filter: 2 MB, whatever the number of values.
FILTER_BITS = 1 << 24
#: Bits of the bitmaps that the engine's aggregate makes (fixed value).
BITMAP_BITS = 32768
#: How tables of the shared folder are written. In a local folder (file:) Hadoop starts several processes for each file, to set
#: permissions of the file and of its checksum file; without checksum files, and without a marker of success, it is one. Each such process
#: counts as a second JVM while it starts. Other file systems only miss the marker.
TABLE_OPTIONS = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true", "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Where the session names none, a temporary one in local mode; on a cluster that is an
    error, as each executor would write to its own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="siltstone-"))
    return spark.sparkContext.getCheckpointDir()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back. The folder goes when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/siltstone-{label}-{uuid.uuid4().hex}"
    df.write.options(**TABLE_OPTIONS).parquet(path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[str], group: str | None = None, name: str = "row_index") -> DataFrame:
    """Adds a gapless number from 0 by order, anew within each group.

    A window over the whole frame, or over two splits, would be one or two tasks. Here rows are sorted by range,
    numbered within each range, and moved on by the counts of the ranges before; only these counts meet in one task.
    """
    keys = [group, *order] if group else order
    ranged = stored(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "ranges")
    by = ["_range", group] if group else ["_range"]
    counts = ranged.groupBy(*by).agg(F.count("*").alias("_n"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1) if not group else W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long"))).drop("_n")
    own = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return ranged.join(starts, by).withColumn(name, (own - 1 + F.col("_start")).cast("long")).drop("_range", "_start")


def _bit(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(FILTER_BITS))


def filter_of(values: DataFrame, column: str) -> DataFrame:
    """A bit for each value, as up to FILTER_BITS / 32768 rows of 4 kB. Its size is bounded, so it may be broadcast; with very many
    values it lets everything through, and the join that follows does the work. Null is a value like others."""
    bit = _bit(F.col(column))
    return values.groupBy(F.floor(bit / BITMAP_BITS).alias("_filter_bucket")).agg(F.bitmap_construct_agg(bit % BITMAP_BITS).alias("_filter_bits"))


def _split(rows: DataFrame, value: Column, bits: DataFrame, there: bool) -> DataFrame:
    bit = _bit(value)
    byte = F.conv(F.hex(F.substring("_filter_bits", (F.floor(bit % BITMAP_BITS / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    is_set = F.call_function("getbit", byte, (bit % 8).cast("int")) == 1
    met = rows.join(F.broadcast(bits), F.floor(bit / BITMAP_BITS) == F.col("_filter_bucket"), "inner" if there else "left")
    return met.where(is_set if there else F.coalesce(~is_set, F.lit(True))).drop("_filter_bucket", "_filter_bits")


def may_be_in(rows: DataFrame, value: Column, bits: DataFrame) -> DataFrame:
    """rows whose value may be among those of a filter: all that are, and a few others."""
    return _split(rows, value, bits, True)


def cannot_be_in(rows: DataFrame, value: Column, bits: DataFrame) -> DataFrame:
    """The other rows: their value is none of those of the filter."""
    return _split(rows, value, bits, False)
