"""Held-out benchmark and its scores."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.functions import metrics as M
from siltstone.functions import text as T

#: Items of each category at most (fixed values). All are under the limit at which the engine prunes ranks before the sort.
TARGETS = {"closed_qa": 600, "open_qa": 400, "negative_detection": 300, "ideation": 200}


def gold(qa: DataFrame, negatives: DataFrame, ideas: DataFrame, docs: DataFrame, targets: dict[str, int] = TARGETS) -> DataFrame:
    """(gold_id, category, source_id, question, reference_answer, closed_label): items whose first document is held out, the first by id of each category up to its target."""
    held = docs.where("split = 'eval'").select(F.col("doc_id").alias("_doc"))
    none = F.lit(None).cast("string")

    def part(rows: DataFrame, category: Column, question: Column, answer: Column, label: Column) -> DataFrame:
        return rows.select(category.alias("category"), F.col("id").alias("source_id"), question.alias("question"), answer.alias("reference_answer"), label.alias("closed_label"), F.try_element_at("doc_ids", F.lit(1)).alias("_doc"))

    turn = lambda i: F.get("turns", F.lit(i))["content"]
    kinds = F.when(F.col("answer_type") == "CLOSED", "closed_qa").otherwise("open_qa")
    problem = F.when(F.size("constraints") > 0, F.concat("problem", F.lit("\n\nConstraints: "), F.array_join("constraints", "; "))).otherwise(F.col("problem"))
    every = part(qa.where("status = 'accepted' AND answer_type IN ('OPEN', 'CLOSED')"), kinds, turn(0), turn(1), F.when(F.col("answer_type") == "CLOSED", F.col("closed_label")))
    every = every.unionByName(part(negatives.where("status = 'generated'"), F.lit("negative_detection"), F.col("prompt"), F.col("expert_response"), none))
    every = every.unionByName(part(ideas.where("status = 'accepted'"), F.lit("ideation"), problem, F.array_join(F.transform("ideas", lambda i: i["hypothesis"]), "; "), none))
    cap = F.lit(0)
    for name, n in targets.items():
        cap = F.when(F.col("category") == name, n).otherwise(cap)
    first = every.join(held, "_doc", "left_semi").withColumn("_n", F.row_number().over(W.partitionBy("category").orderBy("source_id")))
    out = first.where(F.col("_n") <= max(targets.values(), default=0)).where(F.col("_n") <= cap)
    return out.select(F.concat(F.lit("gold-"), "category", F.lit("-"), F.col("source_id").cast("string")).alias("gold_id"), "category", "source_id", "question", "reference_answer", "closed_label")


def score_closed(rows: DataFrame, answer: str = "answer", label: str = "closed_label") -> DataFrame:
    """Adds correct: the answer's yes or no, else its first character, is the label; a blank label is never right."""
    same = T.yes_no(F.col(answer)) == F.lower(T.strip(F.col(label)))
    return rows.withColumn("correct", ~T.blank(F.col(label)) & F.coalesce(same, F.lit(False)))


def answer_with(rows: DataFrame, question: str, fn: Callable[[list[str]], list[str]]) -> DataFrame:
    """Adds answer, from a function that gets a list of questions on an executor."""
    @F.pandas_udf("string")
    def ask(q: pd.Series) -> pd.Series:
        return pd.Series(fn(q.tolist()))

    return rows.withColumn("answer", ask(question))


def accuracy(results: DataFrame, group: str = "category") -> DataFrame:
    """(group, n, n_correct, accuracy, low, high): accuracy and its Wilson interval at 95 %; rows that weren't judged don't count."""
    g = results.where("correct IS NOT NULL").groupBy(group).agg(F.count("*").alias("n"), F.sum(F.col("correct").cast("long")).alias("n_correct"))
    low, high = M.wilson(F.col("n_correct"), F.col("n"))
    ratio = F.col("n_correct").cast("double") / F.col("n")
    return g.select(group, "n", "n_correct", *(T.rounded(c, 4).alias(n) for c, n in ((ratio, "accuracy"), (low, "low"), (high, "high"))))


def aggregate(results: DataFrame) -> DataFrame:
    """(category, n, accuracy, mean_score): each null where a category has none of it."""
    g = results.groupBy("category").agg(F.count("*").alias("n"), F.avg(F.col("correct").cast("double")).alias("a"), F.avg("score").alias("s"))
    return g.select("category", "n", T.rounded(F.col("a"), 4).alias("accuracy"), T.rounded(F.col("s"), 3).alias("mean_score"))


def rubric_means(results: DataFrame, scores: str = "scores") -> DataFrame:
    """(dimension, n, mean) over a map of scores."""
    return results.select(F.explode(scores).alias("dimension", "score")).groupBy("dimension").agg(F.count("score").alias("n"), T.rounded(F.avg("score"), 3).alias("mean"))
