"""Record tables made from the driver's tables, for the registered queries, each with the SQL that makes the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import schemas as S
from siltstone.functions import text as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with title, license (from a licence line, else by id), split, doi and blacklisted."""
    c = F.col("text").contains
    license = F.when(c("Apache License"), "Apache-2.0").when(c("MIT License"), "MIT").when(c("GNU General Public"), "GPL-3.0").when(c("CC BY-NC"), "CC-BY-NC-4.0").when(F.col("doc_id") % 3 == 0, "CC-BY-4.0").when(F.col("doc_id") % 3 == 1, "CC0-1.0")
    return table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", "source", "n_chars", F.substring("text", 1, 40).alias("title"), license.alias("license"), T.split_of(F.col("doc_id")).alias("split"),
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("doi:"), F.col("doc_id").cast("string"))).alias("doi"), c("GNU General Public").alias("blacklisted"))


HASH = "('0x' || substr(md5({0}::VARCHAR), 1, 8))::BIGINT"
DOCS = f"""docs AS (SELECT doc_id, text, lang, source, n_chars, substr(text, 1, 40) AS title,
    CASE WHEN contains(text, 'Apache License') THEN 'Apache-2.0' WHEN contains(text, 'MIT License') THEN 'MIT' WHEN contains(text, 'GNU General Public') THEN 'GPL-3.0'
         WHEN contains(text, 'CC BY-NC') THEN 'CC-BY-NC-4.0' WHEN doc_id % 3 = 0 THEN 'CC-BY-4.0' WHEN doc_id % 3 = 1 THEN 'CC0-1.0' END AS license,
    CASE WHEN {HASH.format('doc_id')} % 100 < 10 THEN 'eval' ELSE 'train' END AS split,
    CASE WHEN doc_id % 5 = 0 THEN 'doi:' || doc_id END AS doi, contains(text, 'GNU General Public') AS blacklisted FROM documents)"""

#: Verdict on a licence column, in SQL.
VERDICT = r"""(CASE WHEN coalesce({0}, '') = '' THEN 'UNKNOWN' WHEN regexp_replace({0}, '-[0-9]+(\.[0-9]+)*$', '') IN ('CC0', 'CC-BY', 'public-domain') THEN 'ALLOWED'
    WHEN regexp_replace({0}, '-[0-9]+(\.[0-9]+)*$', '') IN ('CC-BY-SA') THEN 'FLAGGED' ELSE 'REJECTED' END)"""


def _pick(values: tuple[str, ...], at: str) -> str:
    return f"element_at(array({', '.join(repr(v) for v in values)}), cast({at} % {len(values)} AS int) + 1)"


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question for each conversation: its turns but the system's, in order."""
    conv = table(spark, sf_dir, "conversations")
    turns = F.array_sort(F.collect_list(F.when(F.col("role") != "system", F.struct("turn", "role", F.col("text").alias("content")))))
    per = conv.groupBy("conv_id").agg(F.max(F.when(F.col("role") == "system", F.col("text"))).alias("system"), F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("turns"))
    i = "conv_id"
    return per.select(
        "conv_id", F.concat(F.lit("qa"), F.col(i).cast("string")).alias("id"), F.array(i).alias("doc_ids"), F.when(F.col(i) % 3 == 0, "generated").otherwise("accepted").alias("status"), "system", "turns",
        F.when(F.col(i) % 2 == 0, "CLOSED").otherwise("OPEN").alias("answer_type"), F.when(F.col(i) % 4 == 0, "yes").otherwise("").alias("closed_label"),
        F.expr(_pick(S.QUESTION_TYPES, i)).alias("question_type"), F.expr(_pick(S.COMPONENTS, i)).alias("component"))


QA = f"""conv AS (SELECT conv_id, max(text) FILTER (WHERE role = 'system') AS system, list({{'role': role, 'content': text}} ORDER BY turn) FILTER (WHERE role <> 'system') AS turns FROM conversations GROUP BY conv_id),
qa AS (SELECT conv_id, 'qa' || conv_id AS id, conv_id AS doc, CASE WHEN conv_id % 3 = 0 THEN 'generated' ELSE 'accepted' END AS status, system, turns,
    CASE WHEN conv_id % 2 = 0 THEN 'CLOSED' ELSE 'OPEN' END AS answer_type, CASE WHEN conv_id % 4 = 0 THEN 'yes' ELSE '' END AS closed_label,
    ([{', '.join(repr(v) for v in S.QUESTION_TYPES)}])[conv_id % {len(S.QUESTION_TYPES)} + 1] AS question_type, ([{', '.join(repr(v) for v in S.COMPONENTS)}])[conv_id % {len(S.COMPONENTS)} + 1] AS component FROM conv)"""


def claim_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("item_id")
    return table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("item"), i.cast("string")).alias("id"), F.array(i).alias("doc_ids"), F.when(i % 4 == 0, "CC-BY-4.0").alias("license"), F.when(i % 3 == 0, "rejected").otherwise("generated").alias("status"),
        F.substring("text", 1, 60).alias("sentence_1"), F.substring("text", 61, 60).alias("sentence_2"), F.when(i % 2 == 0, "contradiction").otherwise("paraphrase").alias("category"), F.lit("numeric").alias("subset_name"))


PAIRS = """pairs AS (SELECT 'item' || item_id AS id, item_id AS doc, CASE WHEN item_id % 4 = 0 THEN 'CC-BY-4.0' END AS license, CASE WHEN item_id % 3 = 0 THEN 'rejected' ELSE 'generated' END AS status,
    substr(text, 1, 60) AS sentence_1, substr(text, 61, 60) AS sentence_2, CASE WHEN item_id % 2 = 0 THEN 'contradiction' ELSE 'paraphrase' END AS category, 'numeric' AS subset_name FROM benchmark)"""

NEGATIVES = f"""{PAIRS}, negatives AS (SELECT p.id || '#neg' AS id, p.doc, coalesce(nullif(p.license, ''), d.license) AS license, 'generated' AS status,
    'Is the following statement right, going by the source? "' || sentence_2 || '"' AS prompt, sentence_2 AS flawed_element,
    'It is not. The source says: "' || sentence_1 || '" (what was changed: ' || subset_name || ').' AS expert_response, p.id AS linked_positive_id
    FROM pairs p LEFT JOIN docs d ON d.doc_id = p.doc WHERE category = 'contradiction' AND status = 'generated')"""


def ideas(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    return table(spark, sf_dir, "labels").select(
        F.concat(F.lit("idea"), i.cast("string")).alias("id"), F.array(i).alias("doc_ids"), F.when(F.col("quality") == 1, "accepted").otherwise("rejected").alias("status"), F.concat(F.lit("Problem "), i.cast("string")).alias("problem"),
        F.when(i % 2 == 0, F.array(F.lit("cheap"), F.lit("safe"))).otherwise(F.array().cast("array<string>")).alias("constraints"),
        F.array(F.struct(F.concat(F.lit("h"), i.cast("string")).alias("hypothesis")), F.struct(F.lit("null result").alias("hypothesis"))).alias("ideas"))


IDEAS = """ideas AS (SELECT 'idea' || doc_id AS id, doc_id AS doc, CASE WHEN quality = 1 THEN 'accepted' ELSE 'rejected' END AS status,
    'Problem ' || doc_id || CASE WHEN doc_id % 2 = 0 THEN chr(10) || chr(10) || 'Constraints: cheap; safe' ELSE '' END AS question, 'h' || doc_id || '; null result' AS answer FROM labels)"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task attempts from events: the task is the user's and the type's, an error is a failure."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "ts", F.col("user_id").alias("doc"), "value", F.concat(F.lit("extract:"), (F.col("user_id") * 7 + F.col("event_id") % 7).cast("string")).alias("key"),
                    F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("done").alias("status"), F.col("event_type").alias("deployment"))


ATTEMPTS = """attempts AS (SELECT event_id, ts, user_id AS doc, value, 'extract:' || (user_id * 7 + event_id % 7) AS key,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'done' END AS status, event_type AS deployment FROM events)"""


def messages_text(c: str):
    return F.array_join(F.transform(c, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")


#: An own small hierarchy in the form of a class file (fixed values).
CLASSES = "".join(
    f"###  https://example.org/demo#Demo_{n:08x}_0000_0000_0000_{n:012x}\nrdfs:subClassOf :Demo_{p:08x}_0000_0000_0000_{p:012x} ;\nskos:prefLabel \"{label}\"@en ;\n" + (f'skos:altLabel "{alt}"@en ;\n' if alt else "") + (f'definition "{text}"@en .\n' if text else ".\n") + (f'formula "{formula}" .\n' if formula else "")
    for n, p, label, alt, text, formula in (
        (1, 99, "Thing", "", "anything at all", ""), (2, 1, "Device", "", "A thing made for a purpose.", ""), (3, 2, "BatteryCell", "cell", "A device that stores charge", ""),
        (4, 3, "LithiumCell", "of the", "", ""), (5, 4, "SolidStateLithiumCell", "the", "", ""), (6, 1, "Salt", "", "", ""), (7, 6, "LithiumSalt", "and", "", "LiX"), (8, 9, "LoopA", "", "a loop", ""), (9, 8, "LoopB", "", "", "")))


def classes(spark: SparkSession) -> DataFrame:
    from siltstone.operators import ontology

    return ontology.parse_classes(spark.createDataFrame([(b,) for b in CLASSES.split("###  ")], "value string"))


_ID = "'Demo_' || lpad({0}, 8, '0') || '_0000_0000_0000_' || lpad({0}, 12, '0')"
CLASS_ROWS = f"""classes AS (SELECT {_ID.format('n')} AS id, label, alt_label, definition, formula, CASE WHEN p <> '99' THEN {_ID.format('p')} END AS parent_id FROM (VALUES
    ('1', '99', 'Thing', NULL, 'anything at all', NULL), ('2', '1', 'Device', NULL, 'A thing made for a purpose.', NULL), ('3', '2', 'BatteryCell', 'cell', 'A device that stores charge', NULL),
    ('4', '3', 'LithiumCell', 'of the', NULL, NULL), ('5', '4', 'SolidStateLithiumCell', 'the', NULL, NULL), ('6', '1', 'Salt', NULL, NULL, NULL), ('7', '6', 'LithiumSalt', 'and', NULL, 'LiX'),
    ('8', '9', 'LoopA', NULL, 'a loop', NULL), ('9', '8', 'LoopB', NULL, NULL, NULL)) AS v(n, p, label, alt_label, definition, formula))"""
