"""Queries over documents, pages and chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.operators import corpus, dedupe, records, reports
from siltstone.plans import inputs as I

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_TABLES = ("documents", "labels", "benchmark", "conversations", "pages", "embeddings", "events", "lineitem", "orders", "customer", "supplier", "part", "nation", "region")
_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _TABLES))
def table_stats(spark, d):
    return reports.table_counts({t: I.table(spark, d, t) for t in _TABLES})


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def doc_breakdown_lang(spark, d):
    return reports.breakdown(I.table(spark, d, "documents"), "lang")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def doc_breakdown_source(spark, d):
    return reports.breakdown(I.table(spark, d, "documents"), "source")


@query(f"WITH {I.DOCS} SELECT doc_id, license, {I.VERDICT.format('license')} AS verdict, {I.VERDICT.format('license')} <> 'ALLOWED' AS restricted FROM docs")
def license_classify(spark, d):
    return corpus.classify_license(I.documents(spark, d)).select("doc_id", "license", "verdict", "restricted")


@query(f"WITH {I.DOCS} SELECT doc_id, split FROM docs")
def split_assign(spark, d):
    return corpus.assign_splits(I.table(spark, d, "documents")).select("doc_id", "split")


@query(f"WITH {I.DOCS} SELECT s.split, count(doc_id) AS n FROM (VALUES ('train'), ('eval')) AS s(split) LEFT JOIN docs USING (split) GROUP BY s.split")
def split_counts(spark, d):
    counts = I.documents(spark, d).groupBy("split").agg(F.count("*").alias("n"))
    return spark.createDataFrame([("train",), ("eval",)], "split string").join(counts, "split", "left").na.fill(0, ["n"])


@query(f"""WITH {I.DOCS}, t AS (SELECT doc_id, array_to_string({_WORDS.format('title')}, ' ') AS norm_title FROM docs)
    SELECT doc_id, norm_title, CASE WHEN norm_title = '' THEN doc_id ELSE min(doc_id) OVER (PARTITION BY norm_title) END AS canonical_id FROM t""")
def norm_title_dedupe(spark, d):
    return corpus.first_of_title(I.documents(spark, d), F.col("title")).select("doc_id", "norm_title", "canonical_id")


@query(f"""WITH {I.DOCS}, t AS (SELECT doc_id, array_to_string({_WORDS.format('title')}, ' ') AS norm_title, 'doi:' || doc_id % 211 AS doi, doc_id % 5 = 0 AS has FROM docs),
    c AS (SELECT *, CASE WHEN norm_title = '' THEN doc_id ELSE min(doc_id) OVER (PARTITION BY norm_title) END AS c FROM t), f AS (SELECT doi, min(c) AS first FROM c WHERE has GROUP BY doi),
    h AS (SELECT c, min(first) AS first FROM c JOIN f USING (doi) WHERE has GROUP BY c) SELECT doc_id, norm_title, coalesce(least(first, c.c), c.c) AS canonical_id FROM c LEFT JOIN h ON h.c = c.c""")
def discover_dedupe(spark, d):
    docs = I.documents(spark, d).withColumn("doi", F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit(" DOI:"), (F.col("doc_id") % 211).cast("string"))))
    return corpus.first_of_work(docs, F.col("title"), F.col("doi")).select("doc_id", "norm_title", "canonical_id")


_CLEAN = r"regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g')"
_HEAD = r"(?is)<h([1-6])(?:\s[^>]*)?>(.*?)</h[1-6]\s*>"
_PLAIN = r"trim(regexp_replace(regexp_replace({0}, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"


@query(rf"""WITH c AS (SELECT page_id, {_CLEAN} AS h FROM pages WHERE html IS NOT NULL),
    a AS (SELECT page_id, regexp_extract_all(h, '{_HEAD}', 1) AS levels, regexp_extract_all(h, '{_HEAD}', 2) AS titles, string_split(regexp_replace(h, '{_HEAD}', chr(1), 'g'), chr(1)) AS bodies FROM c),
    s AS (SELECT page_id, unnest(bodies) AS body, unnest(range(0, len(bodies))) AS section FROM a),
    t AS (SELECT page_id, unnest(levels)::INT AS level, unnest(titles) AS title, unnest(range(1, len(levels) + 1)) AS section FROM a),
    p AS (SELECT x.page_id, x.section, string_agg({_PLAIN.format('y.title')}, ' > ' ORDER BY y.section) AS path FROM t x JOIN t y ON y.page_id = x.page_id AND y.section <= x.section AND (y.section = x.section OR y.level < x.level)
          WHERE NOT EXISTS (SELECT 1 FROM t z WHERE z.page_id = x.page_id AND z.section > y.section AND z.section <= x.section AND z.level <= y.level) GROUP BY ALL)
    SELECT page_id, section::INT AS section, coalesce(level, 0) AS level, coalesce(path, '') AS path, md5({_PLAIN.format('body')}) AS text_md5 FROM s LEFT JOIN t USING (page_id, section) LEFT JOIN p USING (page_id, section)""")
def page_sections(spark, d):
    s = corpus.sections(I.table(spark, d, "pages"), "page_id")
    return s.select("page_id", "section", "level", F.array_join("path", " > ").alias("path"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(f"""WITH w AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
    s AS (SELECT doc_id, list_has_any(w, ['the', 'der', 'les']) AND list_has_any(w, ['of', 'die', 'des']) AS must, list_has_any(w, ['with', 'mit'])::INT + list_has_any(w, ['from', 'sur'])::INT AS relevance FROM w)
    SELECT doc_id, relevance, CASE WHEN NOT must THEN 'rejected' WHEN relevance >= 1 THEN 'accepted' ELSE 'borderline' END AS screening FROM s""")
def screen_relevance(spark, d):
    must, boost = [["the", "der", "les"], ["of", "die", "des"]], {"a": ["with", "mit"], "b": ["from", "sur"]}
    return corpus.screen(I.table(spark, d, "documents"), F.col("text"), must, boost).select("doc_id", "relevance", "screening")


@query(f"""WITH {I.DOCS}, w AS (SELECT doc_id, {I.VERDICT.format('license')} AS verdict, {_WORDS.format('text')} AS w FROM docs)
    SELECT doc_id, CASE WHEN verdict = 'REJECTED' OR NOT list_has_any(w, ['the', 'der', 'les', 'la']) THEN 'rejected' WHEN list_has_any(w, ['with', 'mit']) THEN 'accepted' ELSE 'borderline' END AS screening FROM w""")
def screen_licensed(spark, d):
    docs = I.documents(spark, d)
    return corpus.screen(docs, F.col("text"), [["the", "der", "les", "la"]], {"a": ["with", "mit"]}, license=F.col("license")).select("doc_id", "screening")


@query(r"""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS w FROM documents),
    u AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM t),
    g AS (SELECT doc_id, len(x) = 1 AS one, i - row_number() OVER (PARTITION BY doc_id, len(x) = 1 ORDER BY i) AS island FROM u),
    b AS (SELECT doc_id, sum(n) AS bad FROM (SELECT doc_id, count(*) AS n FROM g WHERE one GROUP BY doc_id, island HAVING count(*) >= 4) GROUP BY doc_id)
    SELECT doc_id, CASE WHEN len(w) > 0 THEN coalesce(bad, 0)::DOUBLE / len(w) ELSE 0 END AS garble FROM t LEFT JOIN b USING (doc_id) WHERE coalesce(bad, 0)::DOUBLE / greatest(len(w), 1) <= 0.1""")
def garble_filter(spark, d):
    return corpus.drop_garbled(I.table(spark, d, "documents"), F.col("text")).select("doc_id", "garble")


_CHUNKS = r"""lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g') <> '') AS l FROM documents)),
    sized AS (SELECT doc_id, line, i, {size} AS n FROM lines),
    walk AS (SELECT doc_id, i, 0 AS ord, n FROM sized WHERE i = 1 UNION ALL
        SELECT s.doc_id, s.i, CASE WHEN w.n + s.n <= {target} THEN w.ord ELSE w.ord + 1 END, CASE WHEN w.n + s.n <= {target} THEN w.n + s.n ELSE s.n END FROM walk w JOIN sized s ON s.doc_id = w.doc_id AND s.i = w.i + 1),
    chunks AS (SELECT doc_id, ord, sum(s.n)::BIGINT AS tokens, string_agg(line, chr(10) ORDER BY s.i) AS body FROM walk JOIN sized s USING (doc_id, i) GROUP BY doc_id, ord)"""
_COUNT = r"len(list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> ''))"
_LINES = _CHUNKS.format(size=_COUNT.format("line"), target=100)


@query(f"WITH RECURSIVE {_LINES} SELECT doc_id || '#c' || lpad(ord::VARCHAR, greatest(2, len(ord::VARCHAR))::INT, '0') AS chunk_id, doc_id, ord::INT AS chunk_order, tokens, md5(body) AS text_md5 FROM chunks")
def chunk_segments(spark, d):
    c = corpus.chunk(I.table(spark, d, "documents"), target=100)
    return c.select("chunk_id", "doc_id", F.col("order").alias("chunk_order"), "tokens", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(f"WITH RECURSIVE {_LINES} SELECT doc_id, ord::INT AS chunk_order, md5(body) AS body_md5 FROM chunks")
def chunk_overlap_strip(spark, d):
    c = corpus.chunk(I.table(spark, d, "documents"), target=100, overlap=15)
    return c.select("doc_id", F.col("order").alias("chunk_order"), F.md5(T.without_overlap(F.col("text"), F.col("overlap_prev_tokens")).cast("binary")).alias("body_md5"))


@query(f"""WITH RECURSIVE {_LINES}, pack AS (SELECT doc_id, ord, 0 AS row, tokens AS n FROM chunks WHERE ord = 0 UNION ALL
    SELECT c.doc_id, c.ord, CASE WHEN p.n + c.tokens <= 250 THEN p.row ELSE p.row + 1 END, CASE WHEN p.n + c.tokens <= 250 THEN p.n + c.tokens ELSE c.tokens END FROM pack p JOIN chunks c ON c.doc_id = p.doc_id AND c.ord = p.ord + 1)
    SELECT doc_id, row::INT AS pack_row, sum(tokens)::BIGINT AS tokens, count(*)::INT AS n_chunks, md5(string_agg(body, chr(10) || chr(10) ORDER BY ord)) AS text_md5 FROM pack JOIN chunks USING (doc_id, ord) GROUP BY doc_id, row""")
def cpt_pack(spark, d):
    p = corpus.pack(corpus.chunk(I.table(spark, d, "documents"), target=100, overlap=15), budget=250)
    return p.select("doc_id", F.col("row").alias("pack_row"), "tokens", F.size("chunk_ids").alias("n_chunks"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(f"""WITH RECURSIVE {_LINES} SELECT c.doc_id, c.ord::INT AS chunk_order, md5(coalesce(array_to_string(list_slice(list_filter(regexp_split_to_array(p.body, '\\s+'), lambda w: w <> ''), -15, -1), ' ') || chr(10) || chr(10), '') || c.body) AS text_md5,
    CASE WHEN p.body IS NULL THEN 0 ELSE least(15, {_COUNT.format('p.body')}) END::INT AS overlap FROM chunks c LEFT JOIN chunks p ON p.doc_id = c.doc_id AND p.ord = c.ord - 1""")
def chunk_overlap_tail(spark, d):
    c = corpus.chunk(I.table(spark, d, "documents"), target=100, overlap=15)
    return c.select("doc_id", F.col("order").alias("chunk_order"), F.md5(F.col("text").cast("binary")).alias("text_md5"), F.col("overlap_prev_tokens").alias("overlap"))


@query(f"WITH RECURSIVE {_CHUNKS.format(size='(len(line) + 3) // 4', target=150)} SELECT doc_id, ord::INT AS chunk_order, tokens, md5(body) AS text_md5 FROM chunks")
def chunk_by_characters(spark, d):
    """Chunks by an injected counter: four characters, or what is left of them, are a token."""
    quarter = lambda t: F.floor((F.char_length(t) + 3) / 4)
    c = corpus.chunk(I.table(spark, d, "documents"), target=150, count=quarter)
    return c.select("doc_id", F.col("order").alias("chunk_order"), "tokens", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(f"""WITH {I.QA}, s AS (SELECT id, doc, list_distinct({_WORDS.format('turns[2].content')}) AS s FROM qa), r AS (SELECT id, CASE WHEN len(s) > 0 THEN len(list_intersect(s, {_WORDS.format('text')}))::DOUBLE / len(s) ELSE 0 END AS overlap FROM s JOIN documents ON doc_id = doc)
    SELECT id, overlap, CASE WHEN overlap >= 0.1 THEN 'generated' ELSE 'rejected' END AS status, CASE WHEN overlap < 0.1 THEN 'not_grounded' END AS reject_reason FROM r""")
def grounding_check(spark, d):
    """Each answer against the document that it comes from. The invented answers share few words with it, so the bound is low."""
    qa = I.qa(spark, d).select("id", F.col("doc_ids")[0].alias("doc_id"), F.get("turns", F.lit(1))["content"].alias("answer"))
    rows = qa.join(I.table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    return records.check_grounding(rows, F.coalesce("answer", F.lit("")), F.col("text"), least=0.1).select("id", "overlap", "status", "reject_reason")


@query(f"""WITH s AS (SELECT item_id, list_distinct({_WORDS.format('text')}) AS s FROM benchmark), w AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
    r AS (SELECT item_id, doc_id, len(list_intersect(s, w))::DOUBLE / len(s) AS overlap FROM s CROSS JOIN w WHERE len(s) > 0) SELECT * FROM r WHERE overlap >= 0.6""")
def grounded_sources(spark, d):
    """For each benchmark item all documents that ground it."""
    return records.grounded_sources(I.table(spark, d, "benchmark"), "item_id", F.col("text"), I.table(spark, d, "documents"), "doc_id", F.col("text"))


_SETS = f"""w AS (SELECT doc_id, lang, source, {_WORDS.format('text')} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, lang, source, md5(array_to_string(list_slice(w, p, p + 2), ' ')) AS k FROM (SELECT doc_id, lang, source, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (lang, source, k) WHERE a.doc_id < b.doc_id GROUP BY ALL)"""


@query(f"""WITH {_SETS}, l AS (SELECT y AS doc_id, min(x) AS duplicate_of FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE c >= 0.85 * (a.n + b.n - c) - 1e-9 GROUP BY y)
    SELECT d.doc_id, duplicate_of, CASE WHEN duplicate_of IS NULL THEN 'accepted' ELSE 'rejected' END AS status FROM documents d LEFT JOIN l USING (doc_id)""")
def near_dup_exact(spark, d):
    return dedupe.mark_duplicates(I.table(spark, d, "documents"), "doc_id", F.col("text"), ["lang", "source"]).select("doc_id", "duplicate_of", "status")


@query(r"""WITH i AS (SELECT page_id, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)) AS image FROM pages),
    f AS (SELECT DISTINCT page_id, '/store/' || string_split(image, '/')[-1] AS path FROM i WHERE length(image) % 2 = 0)
    SELECT page_id || '#c0' AS chunk_id, page_id AS doc_id, array_to_string(list_sort(list(DISTINCT path)), ',') AS images FROM (SELECT i.page_id, path FROM i JOIN f ON f.page_id = i.page_id AND string_split(f.path, '/')[-1] = string_split(i.image, '/')[-1]) GROUP BY page_id""")
def image_link(spark, d):
    links = F.regexp_extract_all("html", F.lit('<a[^>]*href="([^"]*)"'), F.lit(1))
    chunks = I.table(spark, d, "pages").select(F.concat(F.col("page_id").cast("string"), F.lit("#c0")).alias("chunk_id"), F.col("page_id").alias("doc_id"), links.alias("images"))
    each = chunks.select("doc_id", F.explode("images").alias("image")).where(F.char_length("image") % 2 == 0)
    files = each.select("doc_id", F.lit("image").alias("kind"), F.concat(F.lit("/store/"), F.element_at(F.split("image", "/"), -1)).alias("path")).distinct()
    return corpus.link_images(chunks, files).select("chunk_id", "doc_id", F.array_join("images", ",").alias("images"))
