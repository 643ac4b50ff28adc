"""Task tables: pending work, attempts, batches, outcomes, call logs and routes."""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.engine import numbered, stored
from siltstone.operators import records


@dataclass(frozen=True)
class Stage:
    """A step that asks a model: its task type, the prompt of a row, the contract of replies, and what rows come from valid ones."""

    task_type: str
    prompt: Callable[[DataFrame], Column]
    contract: str
    rows: Callable[[DataFrame], DataFrame]

    def run(self, candidates: DataFrame, tasks: DataFrame, item: str, fn: Callable[[list[str]], list[str]], *, first: int | None = None, force: bool = False, cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """(rows, outcomes): pending candidates are asked and their replies judged. outcomes (key, status, error) is written, so that a model is asked once."""
        todo = pending(candidates, tasks, self.task_type, item, force=force, first=first)
        asked = complete(todo.withColumn("_prompt", self.prompt(todo)), "_prompt", fn, None if force else cache)
        judged = stored(records.validate(asked, "reply", self.contract), f"stage-{self.task_type}")
        status = F.when(F.col("valid"), "done").otherwise("failed")
        return self.rows(judged.where("valid")), judged.select(task_key(self.task_type, F.col(item)).alias("key"), status.alias("status"), "error")


def task_key(task_type: str, item: Column) -> Column:
    return F.concat(F.lit(f"{task_type}:"), item.cast("string"))


def pending(candidates: DataFrame, tasks: DataFrame, task_type: str, item: str, *, force: bool = False, first: int | None = None) -> DataFrame:
    """Candidates whose task isn't done; all with force. first: only so many, the least by item."""
    todo = candidates
    if not force:
        done = tasks.where("status = 'done'").select(F.col("key").alias("_key")).distinct()
        todo = candidates.join(done, task_key(task_type, F.col(item)) == F.col("_key"), "left_anti")
    return todo if first is None else todo.orderBy(item).limit(first)


def latest_state(attempts: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    """(key, attempts, columns...): how often each task was tried and its state after the last."""
    last = F.max_by(F.struct(*columns), F.struct(order, *columns))
    return attempts.groupBy(key).agg(F.count("*").alias("attempts"), last.alias("_last")).select(key, "attempts", *(F.col(f"_last.{c}").alias(c) for c in columns))


def batches(items: DataFrame, order: str, size: int) -> DataFrame:
    """Adds batch_id and chunk_index, the place within the batch, by order."""
    n = numbered(items, [order], name="_n")
    return n.withColumns({"batch_id": F.floor(F.col("_n") / size).cast("long"), "chunk_index": (F.col("_n") % size).cast("int")}).drop("_n")


def complete(rows: DataFrame, prompt: str, fn: Callable[[list[str]], list[str]], cache: DataFrame | None = None) -> DataFrame:
    """Adds reply from fn, which gets a list of prompts on an executor. cache (prompt_sha, reply) answers what it knows, and only misses
    are asked. Of several replies to a prompt the least by text counts, so that a row never becomes two."""
    keyed = rows.withColumn("prompt_sha", F.sha2(F.col(prompt), 256))
    names = keyed.columns

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(reply=fn(f[prompt].tolist()))

    typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema) + ", reply string"
    if cache is None:
        return keyed.mapInPandas(ask, typed)
    known = cache.groupBy("prompt_sha").agg(F.min("reply").alias("reply"))
    hits = keyed.join(known, "prompt_sha").select(*names, "reply")
    return hits.unionByName(keyed.join(known, "prompt_sha", "left_anti").select(*names).mapInPandas(ask, typed))


def match_replies(asked: DataFrame, replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """asked (batch_id, chunk_index, ...) with their result from replies (batch_id, results), and those that a reply left out, to be asked singly."""
    each = replies.select("batch_id", F.explode("results").alias("result")).withColumn("chunk_index", F.col("result.chunk_index"))
    keys = ["batch_id", "chunk_index"]
    return asked.join(each, keys), asked.join(each.select(*keys), keys, "left_anti")


def outcomes(rows: DataFrame, outcome: str) -> DataFrame:
    return rows.groupBy(outcome).agg(F.count("*").alias("n"))


def failure_islands(results: DataFrame, group: str, order: str, failed: Column, least: int) -> DataFrame:
    """(group, first, last, length) of unbroken runs of at least ``least`` failures: the stop rule as a report."""
    w = W.partitionBy(group).orderBy(order)
    marked = results.withColumn("_failed", failed).withColumn("_island", F.row_number().over(w) - F.row_number().over(W.partitionBy(group, "_failed").orderBy(order)))
    runs = marked.where("_failed").groupBy(group, "_island").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("length"))
    return runs.where(F.col("length") >= least).drop("_island")


def blacklist(tasks: DataFrame, doc: str, least: int) -> DataFrame:
    """(doc, n_failed) of documents with at least so many failed tasks."""
    return tasks.where("status = 'failed'").groupBy(doc).agg(F.count("*").alias("n_failed")).where(F.col("n_failed") >= least)


def ledger(calls: DataFrame, deployment: str, at: str, cost: str) -> DataFrame:
    """(deployment, day, n_calls, spend): calls and spend by UTC day."""
    return calls.groupBy(deployment, F.to_date(at).alias("day")).agg(F.count("*").alias("n_calls"), F.sum(cost).alias("spend"))


def usage(days: DataFrame, limits: DataFrame, deployment: str) -> DataFrame:
    """A ledger against limits (deployment, rpd): adds rpd, left and exhausted. A deployment without a limit, or with null, is never exhausted."""
    left = F.greatest(F.col("rpd") - F.col("n_calls"), F.lit(0)).cast("long")
    return days.join(limits, deployment, "left").withColumns({"left": left, "exhausted": F.coalesce(F.col("n_calls") >= F.col("rpd"), F.lit(False))})


def in_window(calls: DataFrame, group: str, at: str, seconds: int) -> DataFrame:
    """Adds n_in_window, the calls of the group in the last so many seconds, this one included."""
    back = W.partitionBy(group).orderBy(F.unix_micros(F.col(at).cast("timestamp"))).rangeBetween(-(seconds - 1) * 1_000_000, 0)
    return calls.withColumn("n_in_window", F.count("*").over(back))


def in_cooldown(calls: DataFrame, group: str, at: str, failed: Column, seconds: int) -> DataFrame:
    """Adds cooling: a call within so many seconds after the group's last failure before it."""
    before = W.partitionBy(group).orderBy(at).rowsBetween(W.unboundedPreceding, -1)
    last = F.max(F.when(failed, F.col(at))).over(before)
    gap = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(last.cast("timestamp"))
    return calls.withColumn("cooling", F.coalesce(gap < seconds * 1_000_000, F.lit(False)))


def choose_route(routes: DataFrame, deployments: DataFrame, generator_family: DataFrame, tried: DataFrame | None = None, most: int = 3, most_in_all: int = 10) -> DataFrame:
    """(task, name): each task's first available deployment of another family than its generator's; of the same family only if no other is left.

    tried (task, name, attempts): deployments with ``most`` attempts are left out, and tasks with ``most_in_all`` get no route."""
    r = routes.join(deployments.where("available"), "name").join(generator_family, "task", "left")
    if tried is not None:
        spent = tried.groupBy("task").agg(F.sum("attempts").alias("_all")).where(F.col("_all") >= most_in_all)
        r = r.join(tried.where(F.col("attempts") >= most).select("task", "name").distinct(), ["task", "name"], "left_anti").join(spent, "task", "left_anti")
    same = F.coalesce(F.col("family") == F.col("generator_family"), F.lit(False))
    return r.groupBy("task").agg(F.min_by("name", F.struct(same, "position")).alias("name"))
