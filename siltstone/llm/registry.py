"""The queries of this package and, where SQL can express one, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import bpe, decontaminate, exact_dedup, html_extract, licenses, near_dedup, pii, quality, substring_dedup, toxicity
from siltstone.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats_report(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.pages_report(table(spark, sf_dir, "pages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_pii, op2_quality, op3_substring_dedup, op4_near_dedup, op5_html_extract, op6_exact_dedup, op7_licenses, op8_toxicity, op9_decontaminate, op10_bpe)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op3_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT doc_id, p, sha256(array_to_string(list_slice(w, p, p + 12), ' ')) AS k
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13)),
        least_doc AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)),
        gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS q FROM win JOIN least_doc USING (k) WHERE doc_id > m),
        word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS q, unnest(w) AS x FROM d),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY q) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op4_near_dedup": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, sha256(array_to_string(list_slice(w, p, p + 4), ' ')) AS k
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_ways AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT u, v FROM both_ways JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
        reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, links.v FROM reach JOIN links ON links.u = reach.r),
        root AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept, class_id
        FROM d LEFT JOIN n USING (doc_id) JOIN root USING (doc_id) JOIN
             (SELECT doc_id, CASE WHEN k IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY k) END AS class_id
              FROM (SELECT d.doc_id, string_agg(s.k, ',' ORDER BY s.k) AS k FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id)) USING (doc_id)""",
    "op7_licenses": licenses.oracle_sql(),
    "op6_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM n""",
    "op9_decontaminate": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, p, p + least(len(w), 10) - 1), ' ') AS win
               FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10 + 1, 1) + 1)) AS p FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM bw),
        dw AS (SELECT doc_id, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS win
               FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
        hit AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN bw USING (n, win)),
        words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
