"""A class hierarchy as data: scan, ancestors, definitions and terms in questions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import text as T

_NAME = r"[A-Za-z]+_[0-9a-f]{8}(?:_[0-9a-f]{4}){3}_[0-9a-f]{12}"


def parse_classes(blocks: DataFrame, definition: str = "definition", formula: str = "formula") -> DataFrame:
    """(id, label, alt_label, definition, formula, parent_id) of blocks (value), the pieces between class headings. A parent that is no plain class is none."""
    got = lambda pattern: F.nullif(F.regexp_extract("value", pattern, 1), F.lit(""))
    return blocks.select(
        got(rf"\Ahttps://[^\s]+#({_NAME})\s*(?:\n|\z)").alias("id"), got(r'skos:prefLabel "([^"]+)"').alias("label"), got(r'skos:altLabel "([^"]+)"').alias("alt_label"),
        got(rf'{definition}[^"]*"([^"]+)"').alias("definition"), got(rf'{formula}[^"]*"([^"]+)"').alias("formula"), got(rf"rdfs:subClassOf :({_NAME})").alias("parent_id")).where("id IS NOT NULL")


def read_classes(spark: SparkSession, path: str, **names: str) -> DataFrame:
    return parse_classes(spark.read.option("lineSep", "###  ").text(path), **names)


def ancestors(classes: DataFrame) -> DataFrame:
    """(id, depth, ancestor): each class, itself at depth 0, up to the first parent that isn't there; a cycle ends where it closes.

    The hierarchy is a recursive query; its depth is bounded by the engine's recursion limit, and a class has one parent.
    """
    view = f"_siltstone_classes_{uuid.uuid4().hex}"
    classes.createOrReplaceTempView(view)
    found = classes.sparkSession.sql(f"""
        WITH RECURSIVE up(id, depth, ancestor, path) AS (
            SELECT id, 0, id, array(id) FROM {view}
            UNION ALL
            SELECT u.id, u.depth + 1, p.id, concat(u.path, array(p.id)) FROM up u JOIN {view} c ON c.id = u.ancestor JOIN {view} p ON p.id = c.parent_id
            WHERE NOT array_contains(u.path, p.id))
        SELECT id, depth, ancestor FROM up""")
    classes.sparkSession.catalog.dropTempView(view)
    return found


def subtree(classes: DataFrame, *labels: str, pattern: str | None = None) -> DataFrame:
    """(id) of classes below any of the labelled ones, those whose label matches the pattern, these themselves and all their ancestors."""
    up = ancestors(classes)
    root = classes.where(F.col("label").isin(*labels)).select(F.col("id").alias("ancestor"))
    some = up.join(root, "ancestor", "left_semi").select("id")
    if pattern is not None:
        some = some.unionByName(classes.where(F.col("label").rlike(pattern)).select("id"))
    return up.join(some.distinct(), "id", "left_semi").select(F.col("ancestor").alias("id")).distinct()


def _name(c: Column) -> Column:
    return F.coalesce(c["label"], c["alt_label"], c["id"])


def chains(classes: DataFrame) -> DataFrame:
    """(id, chain): a class and its ancestors as structs, nearest first."""
    facts = classes.select(F.col("id").alias("ancestor"), F.struct("id", "label", "alt_label", "definition", "formula").alias("c"))
    return ancestors(classes).join(facts, "ancestor").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", "c"))), lambda x: x["c"]).alias("chain"))


def definitions(classes: DataFrame) -> DataFrame:
    """(id, text): what a class is and which kinds it belongs to; classes of which nothing is known are left out."""

    def sentence(c: Column, i: Column) -> Column:
        name = _name(c)
        start = F.when(i == 0, F.concat(name, F.lit(" is"))).otherwise(F.concat(F.lit("It is a kind of "), name, F.lit(":")))
        ends = F.rtrim(c["definition"]).rlike(r"[.)]$")
        body = F.concat(c["definition"], F.when(ends, "").otherwise("."))
        known = F.array_join(F.array_compact(F.array(F.concat(F.lit("formula "), c["formula"]), F.when(c["alt_label"] != name, F.concat(F.lit("also called "), c["alt_label"])))), ", ")
        return F.when(c["definition"].isNotNull(), F.concat(start, F.lit(" "), body)).when(known != "", F.concat(start, F.lit(" "), known, F.lit(".")))

    text = F.array_join(F.array_compact(F.transform("chain", sentence)), " ")
    return chains(classes).select("id", text.alias("text")).where("text <> ''")


def search_terms(classes: DataFrame, names: tuple[str, ...] = ("label", "alt_label")) -> DataFrame:
    """(term, id): the names of a class, by default its labels and other labels, in lower case, and their words set apart."""
    names = classes.select("id", F.explode(F.array_compact(F.array(*names))).alias("n"))
    spaced = F.lower(F.trim(F.regexp_replace("n", "([A-Z])", " $1")))
    return names.select("id", F.explode(F.array(F.lower("n"), spaced)).alias("term")).where("term <> ''").distinct()


def find_terms(questions: DataFrame, key: str, question: str, terms: DataFrame, any_mark: bool = False) -> DataFrame:
    """(key, id, term, start): classes named in a question, each once, as whole words; of overlapping names the longest stays, by term and id among equals.

    Questions meet terms on a term's first word, an equi-join, and then the whole term is tested at its first
    occurrence. One pass over the candidates of a question, longest first, keeps those that overlap none kept before.
    With any_mark a term is of words and spaces, a question that holds it is searched with a space for each character that is of no word,
    and the first place found that way counts.
    """
    word = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    t = terms.select("id", "term", F.try_element_at(word(F.col("term")), F.lit(1)).alias("w")).where("w IS NOT NULL")
    q = questions.select(F.col(key).alias("key"), F.lower(question).alias("q")).select("key", "q", F.explode(F.array_distinct(word(F.col("q")))).alias("w"))
    met = q.join(t, "w")
    # The term is a pattern of its own here, so the extraction is written as SQL, where a pattern may be a column.
    asked = r"regexp_replace(q, '[^\\p{L}\\p{N}_]', ' ')" if any_mark else "q"
    met = met.where(F.contains("q", "term")) if any_mark else met
    before = rf"regexp_extract({asked}, concat('(?s)^(.*?)(?<![\\p{{L}}\\p{{N}}_])\\Q', term, '\\E(?![\\p{{L}}\\p{{N}}_])'), 0)"
    met = met.withColumn("through", F.expr(before)).where("through <> ''").withColumn("start", F.char_length("through") - F.char_length("term"))
    one = F.struct((-F.char_length("term")).alias("by"), F.col("term").alias("term"), F.col("id").alias("id"), F.col("start").alias("start"), (F.col("start") + F.char_length("term")).alias("end"))
    per = met.groupBy("key").agg(F.array_sort(F.collect_set(one)).alias("found"))
    none = F.array().cast("array<struct<by:int,term:string,id:string,start:int,end:int>>")

    def keep(a: Column, x: Column) -> Column:
        taken = F.exists(a, lambda y: (y["id"] == x["id"]) | ((x["start"] < y["end"]) & (y["start"] < x["end"])))
        return F.when(taken, a).otherwise(F.concat(a, F.array(x)))

    return per.select("key", F.explode(F.aggregate("found", none, keep)).alias("m")).select(F.col("key").alias(key), "m.id", "m.term", "m.start")


def context_block(chain: Column) -> Column:
    """A class and its kinds, for a prompt."""
    more = lambda c: F.coalesce(c["definition"], c["alt_label"])
    line = lambda c: F.concat(F.lit("  is a kind of: "), T.spaced_name(_name(c)), F.coalesce(F.concat(F.lit(' ("'), more(c), F.lit('")')), F.lit("")))
    own = chain[0]
    return F.array_join(F.concat(F.array(F.concat(F.lit("["), T.spaced_name(F.coalesce(own["label"], own["id"])), F.lit("]"))), F.transform(F.slice(chain, 2, 1000), line)), "\n")


def classification_line(chain: Column) -> Column:
    """A class, its kinds in one line, and what its nearest kind means."""
    parent = F.coalesce(F.get(chain, F.lit(1)), chain[0])
    more = F.coalesce(parent["definition"], parent["alt_label"])
    kinds = F.array_join(F.transform(chain, lambda c: T.spaced_name(_name(c))), " is a kind of ")
    return F.concat(F.lit("- "), T.spaced_name(F.coalesce(chain[0]["label"], chain[0]["id"])), F.lit(": "), kinds, F.coalesce(F.concat(F.lit(' - "'), more, F.lit('"')), F.lit("")))


#: Headings of a report and what stands where a question names nothing (fixed values).
CLASSES_HEADING, ANSWER_HEADING = "## Ontology Classification", "## Mechanism / Explanation"
NO_CONTEXT = "No ontology context was found for this question - proceed with general domain knowledge."


def classification_section(lines: Column) -> Column:
    """The heading and the classification lines (array) of a question, or a note where there are none."""
    body = F.when(F.coalesce(F.size(lines), F.lit(0)) > 0, F.array_join(lines, "\n")).otherwise(NO_CONTEXT)
    return F.concat(F.lit(f"{CLASSES_HEADING}\n"), body)


def context_blocks(chains: Column) -> Column:
    """Context blocks of all classes of a question, a blank line between them; empty for none."""
    return F.coalesce(F.array_join(F.transform(chains, context_block), "\n\n"), F.lit(""))


def explanation_prompt(question: Column, blocks: Column) -> Column:
    """What a model is asked: the context, or the note where there is none, and the question."""
    known = F.concat(F.lit("Classes that the question names (they are settled; don't repeat them):\n"), blocks)
    return F.concat(F.when(blocks != "", known).otherwise(NO_CONTEXT), F.lit("\n\nQuestion:\n"), question)


def assembled_answer(section: Column, explanation: Column) -> Column:
    """The report: the classification section, which no model writes, and the stripped explanation under its heading."""
    return F.concat(section, F.lit(f"\n\n{ANSWER_HEADING}\n"), F.coalesce(T.strip(explanation), F.lit("")))
