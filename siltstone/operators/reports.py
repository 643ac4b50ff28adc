"""Counts and comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) of all tables."""
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def breakdown(df: DataFrame, column: str) -> DataFrame:
    """(column, n), the most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def model_summary(runs: DataFrame, label: str, ok: Column, facts: Column, comparisons: Column, seconds: Column, retries: Column) -> DataFrame:
    """One row for each model: successes, yields and mean time of successes, retries."""
    return runs.groupBy(label).agg(
        F.count_if(ok).alias("succeeded"), F.count("*").alias("total"), F.coalesce(F.sum(F.when(ok, facts)), F.lit(0)).cast("long").alias("total_facts"),
        F.coalesce(F.sum(F.when(ok, comparisons)), F.lit(0)).cast("long").alias("total_comparisons"), F.avg(F.when(ok, seconds)).alias("avg_seconds"),
        F.sum(retries).cast("long").alias("total_retries"), F.count_if(retries > 0).alias("chunks_needing_retry"))


def model_pivot(runs: DataFrame, chunk: str, label: str, labels: list[str], cell: Column) -> DataFrame:
    """chunk by model; n/a where a model didn't run."""
    wide = runs.groupBy(chunk).pivot(label, labels).agg(F.min(cell))
    return wide.na.fill("n/a", labels)


def step_deltas(log: DataFrame, run: str, step: str, cumulative: list[str], elapsed: str | None = None, started: str | None = None) -> DataFrame:
    """Adds d_x for each cumulative column x: its growth since the run's step before, from 0 at the first.

    With elapsed (seconds since the run began, cumulative) and started (the run's start, seconds since 1970) also
    start_time, when the step began, as UTC text."""
    w = W.partitionBy(run).orderBy(step)
    out = log.withColumns({f"d_{c}": F.col(c) - F.lag(c, 1, 0).over(w) for c in cumulative})
    return out if elapsed is None else out.withColumn("start_time", utc_text(F.col(started) + F.lag(elapsed, 1, 0).over(w)))


def utc_text(seconds: Column) -> Column:
    """Seconds since 1970 as 2026-01-31T12:00:00Z, whatever the session's time zone; fractions are cut."""
    whole = F.floor(seconds).cast("long")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(whole / 86_400).cast("int"))
    left = F.pmod(whole, F.lit(86_400))
    two = lambda c: F.lpad(F.floor(c).cast("string"), 2, "0")
    return F.concat(day.cast("string"), F.lit("T"), two(left / 3600), F.lit(":"), two(left % 3600 / 60), F.lit(":"), two(left % 60), F.lit("Z"))


def first_and_more(df: DataFrame, item: str, n: int = 8) -> DataFrame:
    """(items, more): the first n distinct items in order and how many are left. One row, also for none."""
    names = df.select(F.col(item).alias("_i")).where("_i IS NOT NULL").distinct()
    first = names.orderBy("_i").limit(n).agg(F.array_sort(F.collect_list("_i")).alias("items"))
    return first.join(names.agg(F.count("*").alias("_n"))).select("items", F.greatest(F.col("_n") - n, F.lit(0).cast("long")).alias("more"))


def log_rows(log: DataFrame, at: str, *, level: str | None = None, levels: tuple[str, ...] = ("debug", "info", "warning", "error"), since: Column | None = None, holds: Column | None = None, last: int | None = None) -> DataFrame:
    """Rows of a log at ``level`` or above, from ``since`` on, that hold; with last the newest so many by time, the table's other columns settling ties."""
    out = log
    if level is not None:
        out = out.where(F.col("level").isin(*levels[levels.index(level):]))
    if since is not None:
        out = out.where(F.col(at) >= since)
    if holds is not None:
        out = out.where(holds)
    return out if last is None else out.orderBy(F.desc(at), *(F.desc(c) for c in log.columns if c != at)).limit(last)


def last_step(log: DataFrame, run: str, step: str, *columns: str) -> DataFrame:
    return log.groupBy(run).agg(F.max_by(F.struct(step, *columns), step).alias("_l")).select(run, F.col(f"_l.{step}").alias(step), *(F.col(f"_l.{c}").alias(c) for c in columns))


def schema_differences(actual: DataFrame, wanted: DataFrame) -> DataFrame:
    """(table_name, column_name, difference): wanted tables that are missing, and wanted columns of tables that are there."""
    tables = actual.select("table_name").distinct()
    gone = wanted.select("table_name").distinct().join(tables, "table_name", "left_anti").select("table_name", F.lit("").alias("column_name"), F.lit("missing table").alias("difference"))
    columns = wanted.join(tables, "table_name", "left_semi").exceptAll(actual).select("table_name", "column_name", F.lit("missing column").alias("difference"))
    return gone.unionByName(columns)


def cell_balance(rows: DataFrame, a: str, b: str, target: int) -> DataFrame:
    """(a, b, n, missing) of each cell and its margins, all as null, against a target for each cell."""
    cells = rows.cube(a, b).agg(F.count("*").alias("n"))
    return cells.withColumn("missing", F.greatest(F.lit(target) - F.col("n"), F.lit(0).cast("long")))


def acceptance_stability(decisions: DataFrame, group: str, order: str, accepted: Column, window: int = 200, tolerance: float = 0.03) -> DataFrame:
    """Adds rate, the share accepted among the last ``window`` decisions, and stable, whether it is within tolerance of the rate a window before."""
    w = W.partitionBy(group).orderBy(order)
    rate = F.avg(accepted.cast("double")).over(w.rowsBetween(-(window - 1), 0))
    out = decisions.withColumn("rate", rate).withColumn("_n", F.row_number().over(w))
    before = F.lag("rate", window).over(w)
    return out.withColumn("stable", F.coalesce((F.col("_n") >= 2 * window) & (F.abs(F.col("rate") - before) <= tolerance), F.lit(False))).drop("_n")
