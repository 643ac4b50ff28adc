"""Generated records: validation of structured output, derivation, judging, replacement by key."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import schemas as S
from siltstone.engine import stored
from siltstone.functions import text as T


def json_part(text: Column) -> Column:
    """The outermost braces of a reply, without code fences or prose round them; empty where there are none."""
    return F.regexp_extract(text, r"(?s)\{.*\}", 0)


Check = Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Field:
    """A field of a reply. ddl: how it is read from JSON. good: whether its value, and whether its key is there at all,
    will do. clean: the value that is kept. inner: the contract of the object, or of each object of a list (many)."""

    name: str
    ddl: str
    message: str
    good: Check
    clean: Callable[[Column], Column] = lambda v: v
    inner: str = ""
    many: bool = False


Contract = tuple[Field, ...]


def _filled(name: str) -> Field:
    return Field(name, "string", "blank", lambda v, has: ~T.blank(v), T.strip)


def _given(name: str) -> Field:
    return Field(name, "string", "missing", lambda v, has: v.isNotNull())


def _maybe(name: str) -> Field:
    return Field(name, "string", "", lambda v, has: F.lit(True))


def _blank_to_null(name: str) -> Field:
    return Field(name, "string", "", lambda v, has: F.lit(True), lambda v: F.nullif(T.strip(v), F.lit("")))


def _said(name: str) -> Field:
    return Field(name, "string", "null", lambda v, has: ~has | v.isNotNull(), lambda v: F.coalesce(v, F.lit("")))


def _word(name: str, values: tuple[str, ...], *, optional: bool = False, default: str | None = None) -> Field:
    """One of values. optional: null will do. default: what an absent key stands for; null won't do then."""

    def good(v: Column, has: Column) -> Column:
        known = F.coalesce(v.isin(*values), F.lit(False))
        return known | v.isNull() if optional else known | ~has if default else known

    return Field(name, "string", "not an allowed value", good, lambda v: F.coalesce(v, F.lit(default)) if default else v)


def _score(name: str) -> Field:
    return Field(name, "int", "not from 1 to 5", lambda v, has: v.between(1, 5))


def _needed(name: str, ddl: str) -> Field:
    return Field(name, ddl, "missing", lambda v, has: v.isNotNull())


def _texts(name: str) -> Field:
    return Field(name, "array<string>", "not a list of texts", lambda v, has: ~has | F.forall(v, lambda x: x.isNotNull()), lambda v: F.coalesce(v, F.array().cast("array<string>")))


def _triple(name: str) -> Field:
    return Field(name, "array<string>", "three elements or none", lambda v, has: ~has | F.size(v).isin(0, 3), lambda v: F.coalesce(v, F.array().cast("array<string>")))


def _entries(name: str) -> Field:
    return Field(name, "map<string,string>", "not a map of texts", lambda v, has: ~has | F.forall(F.map_values(v), lambda x: x.isNotNull()), lambda v: F.coalesce(v, F.create_map().cast("map<string,string>")))


def _object(name: str, inner: str) -> Field:
    return Field(name, "string", "missing", lambda v, has: v.isNotNull(), inner=inner)


def _objects(name: str, inner: str) -> Field:
    return Field(name, "array<string>", "not a list", lambda v, has: ~has | v.isNotNull(), inner=inner, many=True)


#: Field names and vocabularies are fixed values. By record: material, fact, comparison, batches of both, claim pairs,
#: questions, false premise, rejection, ideas and judges.
CONTRACTS: dict[str, Contract] = {
    "material": (_given("name"), _maybe("formula"), _maybe("class"), _word("component", S.COMPONENTS, optional=True)),
    "fact": (_object("material", "material"), _filled("property"), _maybe("value"), _maybe("unit"), _entries("conditions"), _word("category", S.FACT_CATEGORIES),
             _word("polarity", S.POLARITIES, default="positive"), _triple("triple"), _filled("evidence_sentence")),
    "comparison": (_filled("baseline"), _filled("modification"), _filled("metric"), _word("direction", S.DIRECTIONS), _maybe("magnitude"), _entries("conditions"),
                   _word("component", S.COMPONENTS, optional=True), _filled("evidence_sentence")),
    "chunk_extraction": (_needed("chunk_index", "int"), _objects("facts", "fact"), _objects("comparisons", "comparison")),
    "extraction_batch": (_objects("results", "chunk_extraction"),),
    "claim_pair": (_filled("sentence_1"), _filled("sentence_2"), _word("category", S.PAIR_CATEGORIES), _word("subset_name", S.PAIR_SUBSETS)),
    "chunk_pairs": (_needed("chunk_index", "int"), _objects("pairs", "claim_pair")),
    "claim_batch": (_objects("results", "chunk_pairs"),),
    "qa_item": (_filled("question"), _filled("answer"), _filled("reasoning"), _word("question_type", S.QUESTION_TYPES), _word("answer_type", S.ANSWER_TYPES), _word("component", S.COMPONENTS, optional=True), _maybe("chemistry")),
    "qa_generation": (_objects("items", "qa_item"),),
    "false_premise": tuple(map(_blank_to_null, ("prompt", "flawed_element", "expert_response", "reasoning"))),
    "dpo_rejection": (_filled("rejected"), _word("error_type", S.DPO_ERRORS)),
    "idea": (_filled("hypothesis"), _filled("mechanism"), _filled("risks"), _texts("validation_experiments"), _texts("success_metrics")),
    "ideation": (_filled("problem"), _texts("constraints"), _filled("reasoning"), _objects("ideas", "idea")),
    "qa_judge": (_score("faithfulness"), _score("correctness"), _score("specificity"), _said("rationale")),
    "ideation_judge": (_score("groundedness"), _score("correctness"), _score("novelty"), _score("feasibility"), _said("rationale")),
    "open_judge": (_needed("correct", "boolean"), _score("score"), _said("rationale")),
    "negative_judge": (_needed("caught_flaw", "boolean"), _said("rationale")),
}


def _read(raw: Column, contract: Contract, then: Callable[[Column, Column, Column], Column]) -> Column:
    """then(fields, keys, whether raw is an object). The parse is bound as the element of a one-element array, so that it happens once."""
    ddl = ", ".join(f"`{f.name}` {f.ddl}" for f in contract) + ", _bad string"
    one = F.struct(F.from_json(raw, ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("s"), F.json_object_keys(raw).alias("k"))
    return F.transform(F.array(one), lambda x: then(x["s"], x["k"], x["k"].isNotNull() & x["s"].isNotNull() & x["s"]["_bad"].isNull()))[0]


def _first(errors: list[Column]) -> Column:
    return F.coalesce(*errors, F.lit(None).cast("string"))


def _problem(raw: Column, contract: Contract, *, top: bool = False) -> Column:
    """The first rule that a JSON text breaks, fields in their order; null if it keeps all. Within lists the first object that breaks one tells."""

    def judged(s: Column, keys: Column, whole: Column) -> Column:
        errors = [F.when(~F.coalesce(whole, F.lit(False)), "not JSON")]
        if top:
            known = F.arrays_overlap(keys, F.array(*(F.lit(f.name) for f in contract)))
            errors.append(F.when((F.size(keys) > 0) & ~known, "no field of the schema"))
        for f in contract:
            good = f.good(s[f.name], F.array_contains(keys, f.name))
            errors.append(F.when(~F.coalesce(good, F.lit(False)), f"{f.name}: {f.message}"))
            if f.many:
                found = F.filter(F.transform(s[f.name], _judge_of(f.inner)), lambda e: e.isNotNull())
                errors.append(F.concat(F.lit(f"{f.name}: "), F.try_element_at(found, F.lit(1))))
            elif f.inner:
                errors.append(F.concat(F.lit(f"{f.name}: "), _problem(s[f.name], CONTRACTS[f.inner])))
        return _first(errors)

    return _read(raw, contract, judged)


def _judge_of(name: str) -> Callable[[Column], Column]:
    return lambda raw: _problem(raw, CONTRACTS[name])


def _cleaned(raw: Column, contract: Contract) -> Column:
    """The fields of a text that keeps all rules, as a struct: texts stripped, defaults filled in."""

    def value(f: Field, v: Column) -> Column:
        if f.many:
            return F.coalesce(F.transform(v, lambda x: _cleaned(x, CONTRACTS[f.inner])), F.array())
        return _cleaned(v, CONTRACTS[f.inner]) if f.inner else f.clean(v)

    return _read(raw, contract, lambda s, keys, whole: F.struct(*(value(f, s[f.name]).alias(f.name) for f in contract)))


def validate(rows: DataFrame, reply: str, contract: str) -> DataFrame:
    """rows with parsed (struct, null unless valid), valid and error, the first rule that fails.

    A reply that is no JSON object is an error, and so is an object that shares no field with the contract; {} is judged
    by the rules alone. Texts that must be filled are stripped, absent lists, maps and words with a default get it. A
    key that is there with null isn't absent. Columns of these three names are replaced.
    """
    raw = json_part(F.col(reply))
    out = rows.withColumn("error", _problem(raw, CONTRACTS[contract], top=True))
    return out.withColumns({"valid": F.col("error").isNull(), "parsed": F.when(F.col("error").isNull(), _cleaned(raw, CONTRACTS[contract]))})


def expand(rows: DataFrame, items: str, suffix: str, base: Column) -> DataFrame:
    """One row for each element of an array, with id = base, #, suffix and the element's place from 0."""
    flat = rows.select("*", F.posexplode(items).alias("_at", "item"))
    return flat.withColumn("id", F.concat(base, F.lit(f"#{suffix}"), F.col("_at").cast("string"))).drop("_at")


def check_grounding(rows: DataFrame, statement: Column, source: Column, least: float = 0.6) -> DataFrame:
    """Adds overlap, status (generated or rejected) and reject_reason."""
    good = F.col("overlap") >= least
    return rows.withColumn("overlap", T.overlap_ratio(statement, source)).withColumn("status", F.when(good, "generated").otherwise("rejected")).withColumn("reject_reason", F.when(~good, "not_grounded"))


#: Statements and their words are broadcast up to so many words and bytes; beyond, sources meet them in shuffled joins.
BROADCAST_WORDS, BROADCAST_BYTES = 100_000, 4_000_000


def grounded_sources(statements: DataFrame, key: str, statement: Column, sources: DataFrame, source_key: str, source: Column, least: float = 0.6, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """(key, source_key, overlap): all sources that hold at least ``least`` of a statement's distinct words. Statements without words have none.

    A prefix-filtered join: of n words at least ceil(least * n) must be there, so one of any n - ceil(least * n) + 1 is.
    The rarest words of all sources make this prefix. Sources are reduced to the numbers of words that some statement has and
    written once, as counting, joining and confirming read them; only pairs that share a prefix word are ever made. A source's
    candidates are one row of keys, and texts and words are never sent to pairs while the statements are few.
    """
    s = stored(statements.select(F.col(key).alias("_key"), F.array_distinct(T.words(statement)).alias("_s")), "statements").where(F.size("_s") > 0)
    vocabulary = stored(s.select(F.explode("_s").alias("_word")).distinct().withColumn("_id", F.monotonically_increasing_id()), "vocabulary")
    size = s.agg(F.sum(F.size("_s")).alias("n"), F.sum(F.octet_length(F.array_join("_s", " "))).alias("bytes")).first()
    few = (size["n"] or 0) <= broadcast_words and (size["bytes"] or 0) <= BROADCAST_BYTES
    small = F.broadcast if few else lambda df: df
    each = sources.select(F.col(source_key).alias("_source"), F.array_distinct(T.words(source)).alias("_all")).select("_source", F.explode("_all").alias("_word")).join(small(vocabulary), "_word")
    w = stored(each.groupBy("_source").agg(F.collect_set("_id").alias("_w")), "source-words")
    rarity = stored(w.select(F.explode("_w").alias("_id")).groupBy("_id").agg(F.count("*").alias("_n")), "rarity")
    ids = s.select("_key", F.explode("_s").alias("_word")).join(small(vocabulary), "_word").join(small(rarity), "_id", "left")
    ranked = ids.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("_n", F.lit(0).cast("long")).alias("n"), F.col("_id").alias("w")))).alias("_r"))
    ranked = stored(ranked.select("_key", F.transform("_r", lambda x: x["w"]).alias("_s")), "ranked")
    n = F.size("_s")
    prefix = ranked.select("_key", F.explode(F.slice("_s", F.lit(1), (n - F.ceil(n * F.lit(least) - 1e-9) + 1).cast("int"))).alias("_id"))
    pairs = w.select("_source", F.explode("_w").alias("_id")).join(small(prefix), "_id").groupBy("_source").agg(F.collect_set("_key").alias("_keys"))
    whole = pairs.join(w, "_source").select("_source", "_w", F.explode("_keys").alias("_key")).join(small(ranked), "_key")
    return whole.select(F.col("_key").alias(key), F.col("_source").alias(source_key), T.overlap_of(F.col("_s"), F.col("_w")).alias("overlap")).where(F.col("overlap") >= least)


#: Least score by dimension, for questions and for ideas (fixed values).
QA_FLOOR = {"faithfulness": 4, "correctness": 4, "specificity": 3}
IDEATION_FLOOR = {"groundedness": 4, "correctness": 4, "novelty": 3, "feasibility": 3}


def judge(rows: DataFrame, floor: dict[str, int], rationale: Column, score=F.col) -> DataFrame:
    """Adds status and reject_reason: accepted if each score reaches its floor, a missing score being 0."""
    passes = F.lit(True)
    for name, least in floor.items():
        passes = passes & (F.coalesce(score(name), F.lit(0)) >= least)
    why = F.when(F.coalesce(rationale, F.lit("")) != "", F.substring(F.concat(F.lit("judge:"), rationale), 1, 2000)).otherwise("judge:below_threshold")
    return rows.withColumn("status", F.when(passes, "accepted").otherwise("rejected")).withColumn("reject_reason", F.when(~passes, why))


def contradiction_negatives(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """A negative example for each generated contradiction; its licence is the pair's, else the document's."""
    p = pairs.where("category = 'contradiction' AND status = 'generated'").withColumn("_doc", F.try_element_at("doc_ids", F.lit(1)))
    d = docs.select(F.col("doc_id").alias("_doc"), F.col("license").alias("_license"))
    j = p.join(d, "_doc", "left")
    return j.select(
        F.concat("id", F.lit("#neg")).alias("id"), "doc_ids", T.or_else(F.col("license"), F.col("_license")).alias("license"), F.lit("generated").alias("status"), F.lit("contradiction_detection").alias("kind"),
        F.concat(F.lit('Is the following statement right, going by the source? "'), "sentence_2", F.lit('"')).alias("prompt"), F.col("sentence_2").alias("flawed_element"),
        F.concat(F.lit('It is not. The source says: "'), "sentence_1", F.lit('" (what was changed: '), "subset_name", F.lit(").")).alias("expert_response"), F.col("id").alias("linked_positive_id"))


def false_premises(rows: DataFrame) -> DataFrame:
    """Rows (chunk_id, doc_id, parsed) with a prompt, as negatives."""
    clean = [f.name for f in CONTRACTS["false_premise"]]
    out = rows.withColumns({n: F.col(f"parsed.{n}") for n in clean}).where("prompt IS NOT NULL")
    return out.select(F.concat("chunk_id", F.lit("#negfp")).alias("id"), F.array("doc_id").alias("doc_ids"), F.array("chunk_id").alias("chunk_ids"), F.lit("generated").alias("status"), F.lit("false_premise").alias("kind"), *clean)


def dpo_pairs(qa: DataFrame, rejected: Column, error_type: Column) -> DataFrame:
    """A preference pair for each accepted question: its first turn, its answer, and the given wrong answer."""
    said = lambda role, c: F.array(F.struct(F.lit(role).alias("role"), c.alias("content")))
    q = qa.where("status = 'accepted' AND size(turns) >= 2")
    return q.select(F.concat("id", F.lit("#dpo")).alias("id"), F.col("id").alias("source_qa_id"), "doc_ids", F.lit("generated").alias("status"), said("user", F.col("turns")[0]["content"]).alias("prompt"),
                    said("assistant", F.col("turns")[1]["content"]).alias("chosen"), said("assistant", rejected).alias("rejected"), error_type.alias("error_type"))


def ideations(rows: DataFrame) -> DataFrame:
    """Rows (chunk_id, doc_id, parsed) with at least one idea, as ideation records."""
    return rows.where("size(parsed.ideas) > 0").select(F.concat("chunk_id", F.lit("#idea")).alias("id"), F.array("doc_id").alias("doc_ids"), F.array("chunk_id").alias("chunk_ids"), F.lit("generated").alias("status"), "parsed.problem", "parsed.constraints", "parsed.reasoning", "parsed.ideas")


def enough_evidence(facts: DataFrame, comparisons: DataFrame, least: int = 2) -> DataFrame:
    """(chunk_id, n) of chunks with at least so many generated facts and comparisons together."""
    both = facts.where("status = 'generated'").select(F.explode("chunk_ids").alias("chunk_id")).unionByName(comparisons.where("status = 'generated'").select(F.explode("chunk_ids").alias("chunk_id")))
    return both.groupBy("chunk_id").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def of_parent(rows: DataFrame, key: str, parents: DataFrame, parent: str) -> DataFrame:
    """rows whose id begins with a parent's id and #, so doc:1 doesn't take doc:10#0. An equi-join on what stands before the first #
    of each #-ended beginning; rows without # belong to nobody. Each row stays once."""
    cuts = F.transform(F.sequence(F.lit(1), F.size(F.split(F.col(key), "#")) - 1), lambda i: F.call_function("substring_index", F.col(key), F.lit("#"), i))
    begins = rows.withColumn("_begins", F.when(F.contains(F.col(key), F.lit("#")), cuts))
    known = parents.select(F.col(parent).cast("string").alias("_parent")).distinct()
    met = begins.select(F.col(key).alias("_key"), F.explode("_begins").alias("_parent")).join(known, "_parent", "left_semi").select("_key").distinct()
    return rows.join(met, rows[key] == met["_key"], "left_semi")


def about_chunk(rows: DataFrame, chunk_id: str, chunk_ids: str = "chunk_ids") -> DataFrame:
    """rows whose list of chunks holds one; null lists hold none."""
    return rows.where(F.array_contains(chunk_ids, chunk_id))


def replace_by_key(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old without the keys that new brings, and new."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def chunk_texts(records: DataFrame, chunks: DataFrame) -> DataFrame:
    """(id, source_text): the texts of a record's chunks in the order of its list, joined by a blank line."""
    each = records.select("id", F.posexplode("chunk_ids").alias("at", "chunk_id")).join(chunks.select("chunk_id", "text"), "chunk_id")
    return each.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "\n\n").alias("source_text"))


def batch_prompt(texts: Column) -> Column:
    """Excerpts of a batch, numbered from 0."""
    return F.array_join(F.transform(texts, lambda t, i: F.concat(F.lit("[Excerpt "), i.cast("string"), F.lit("]\n"), t)), "\n\n")
