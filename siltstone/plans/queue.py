"""Queries over task attempts, call logs, routes and step logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions import metrics as M
from siltstone.functions import text as T
from siltstone.operators import records, reports, tasks
from siltstone.plans import inputs as I

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"WITH {I.ATTEMPTS} SELECT doc_id FROM documents WHERE 'extract:' || doc_id NOT IN (SELECT key FROM attempts WHERE status = 'done')")
def pending_tasks(spark, d):
    return tasks.pending(I.table(spark, d, "documents").select("doc_id"), I.attempts(spark, d), "extract", "doc_id")


@query(f"WITH {I.ATTEMPTS} SELECT doc_id FROM documents WHERE 'extract:' || doc_id NOT IN (SELECT key FROM attempts WHERE status = 'done') ORDER BY doc_id LIMIT 25")
def first_pending(spark, d):
    return tasks.pending(I.table(spark, d, "documents").select("doc_id"), I.attempts(spark, d), "extract", "doc_id", first=25)


@query(f"WITH {I.ATTEMPTS} SELECT key, count(*) AS attempts, arg_max(status, event_id) AS status, arg_max(value, event_id) AS value FROM attempts GROUP BY key")
def task_latest_state(spark, d):
    return tasks.latest_state(I.attempts(spark, d), "key", "event_id", "status", "value")


@query("SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 32)::BIGINT AS batch_id, ((row_number() OVER (ORDER BY doc_id) - 1) % 32)::INT AS chunk_index FROM documents")
def batch_plan(spark, d):
    return tasks.batches(I.table(spark, d, "documents").select("doc_id"), "doc_id", 32).select("doc_id", "batch_id", "chunk_index")


@query(f"WITH {I.ATTEMPTS} SELECT status, count(*) AS n FROM attempts GROUP BY status")
def task_outcomes(spark, d):
    return tasks.outcomes(I.attempts(spark, d), "status")


@query(f"""WITH {I.ATTEMPTS}, m AS (SELECT doc, event_id, status = 'failed' AS f, row_number() OVER (PARTITION BY doc ORDER BY event_id) - row_number() OVER (PARTITION BY doc, status = 'failed' ORDER BY event_id) AS i FROM attempts)
    SELECT doc, min(event_id) AS first, max(event_id) AS last, count(*) AS length FROM m WHERE f GROUP BY doc, i HAVING count(*) >= 3""")
def failure_islands(spark, d):
    return tasks.failure_islands(I.attempts(spark, d), "doc", "event_id", F.col("status") == "failed", 3)


@query(f"WITH {I.ATTEMPTS} SELECT doc, count(*) AS n_failed FROM attempts WHERE status = 'failed' GROUP BY doc HAVING count(*) >= 15")
def blacklist_candidates(spark, d):
    return tasks.blacklist(I.attempts(spark, d), "doc", 15)


@query(f"WITH {I.ATTEMPTS}, n AS (SELECT key, event_id FROM attempts WHERE status = 'failed') SELECT key, event_id, 'old' AS origin FROM attempts WHERE key NOT IN (SELECT key FROM n) UNION ALL SELECT key, event_id, 'new' FROM n")
def replace_by_key(spark, d):
    a = I.attempts(spark, d)
    return records.replace_by_key(a.select("key", "event_id", F.lit("old").alias("origin")), a.where("status = 'failed'").select("key", "event_id", F.lit("new").alias("origin")), ["key"])


@query(f"WITH {I.ATTEMPTS} SELECT deployment, ts::DATE AS day, count(*) AS n_calls, sum((value * 100)::BIGINT)::BIGINT AS spend FROM attempts GROUP BY deployment, ts::DATE")
def ledger_daily(spark, d):
    a = I.attempts(spark, d).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return tasks.ledger(a, "deployment", "ts", "cents")


@query(f"""WITH {I.ATTEMPTS}, u AS (SELECT deployment, ts::DATE AS day, count(*) AS n_calls FROM attempts GROUP BY ALL), l AS (SELECT * FROM (VALUES ('view', 20), ('click', 0), ('error', NULL)) AS v(deployment, rpd))
    SELECT deployment, day, n_calls, rpd, greatest(rpd - n_calls, 0) AS "left", coalesce(n_calls >= rpd, false) AS exhausted FROM u LEFT JOIN l USING (deployment)""".replace('AS "left"', 'AS calls_left').replace("greatest(rpd - n_calls, 0)", "CASE WHEN rpd IS NOT NULL THEN greatest(rpd - n_calls, 0) END"))
def ledger_usage(spark, d):
    limits = spark.createDataFrame([("view", 20), ("click", 0), ("error", None)], "deployment string, rpd int")
    days = tasks.ledger(I.attempts(spark, d), "deployment", "ts", "event_id").drop("spend")
    return tasks.usage(days, limits, "deployment").select("deployment", "day", "n_calls", "rpd", F.when(F.col("rpd").isNotNull(), F.col("left")).alias("calls_left"), "exhausted")


@query(f"WITH {I.ATTEMPTS} SELECT event_id, deployment, count(*) OVER (PARTITION BY deployment ORDER BY ts RANGE BETWEEN INTERVAL 3599 SECONDS PRECEDING AND CURRENT ROW) AS n_in_window FROM attempts")
def rate_window(spark, d):
    return tasks.in_window(I.attempts(spark, d), "deployment", "ts", 3600).select("event_id", "deployment", "n_in_window")


@query(f"""WITH {I.ATTEMPTS} SELECT event_id, coalesce(epoch_us(ts) - epoch_us(max(ts) FILTER (WHERE status = 'failed') OVER (PARTITION BY doc ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) < 86400000000, false) AS cooling FROM attempts""")
def cooldown_overlap(spark, d):
    return tasks.in_cooldown(I.attempts(spark, d), "doc", "ts", F.col("status") == "failed", 86_400).select("event_id", "cooling")


@query("SELECT * FROM (VALUES ('extract', 'b'), ('judge', 'a'), ('qa', 'c'), ('lone', 'c')) AS v(task, name)")
def route_select(spark, d):
    routes = spark.createDataFrame([("extract", "a", 0), ("extract", "b", 1), ("judge", "b", 0), ("judge", "a", 1), ("qa", "d", 0), ("qa", "c", 1), ("lone", "c", 0)], "task string, name string, position int")
    deployments = spark.createDataFrame([("a", "x/alpha-1", True), ("b", "y/beta-2", True), ("c", "z/gamma-3", True), ("d", "z/delta", False)], "name string, model string, available boolean")
    made = spark.createDataFrame([("extract", "alpha"), ("judge", "beta"), ("lone", "gamma")], "task string, generator_family string")
    return tasks.choose_route(routes, deployments.withColumn("family", T.model_family(F.col("model"))), made)


#: Overhead and answer tokens by task, and whether it takes several chunks (fixed values).
CONTEXT_TASKS = (("facts", 681, 3000, True), ("claims", 211, 1900, True), ("qa", 163, 2500, False), ("negatives", 150, 1500, False), ("judge", 56, 800, False))
_CTX = ", ".join(f"('{t}', {o}, {a}, {str(b).lower()})" for t, o, a, b in CONTEXT_TASKS)


@query(f"SELECT task, batch, (ceil(1.2::DOUBLE * (o + CASE WHEN b THEN batch ELSE 1 END * (900 + a)) / 1024) * 1024)::BIGINT AS num_ctx, max((ceil(1.2::DOUBLE * (o + CASE WHEN b THEN batch ELSE 1 END * (900 + a)) / 1024) * 1024)::BIGINT) OVER (PARTITION BY batch) AS global_ctx FROM (VALUES {_CTX}) AS v(task, o, a, b), (VALUES (1), (5)) AS s(batch)")
def context_budget(spark, d):
    rows = spark.createDataFrame(CONTEXT_TASKS, "task string, o int, a int, b boolean").withColumn("batch", F.explode(F.array(F.lit(1), F.lit(5))))
    sized = rows.withColumn("num_ctx", M.context_size(F.col("o"), F.lit(900), F.col("a"), F.when(F.col("b"), F.col("batch")).otherwise(1)))
    most = sized.groupBy("batch").agg(F.max("num_ctx").alias("global_ctx"))
    return sized.join(most, "batch").select("task", "batch", "num_ctx", "global_ctx")


@query("SELECT user_id, event_id, value - coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS d_value FROM events")
def step_diff(spark, d):
    return reports.step_deltas(I.table(spark, d, "events"), "user_id", "event_id", ["value"]).select("user_id", "event_id", "d_value")


@query("""SELECT user_id, event_id, strftime(make_timestamp(((user_id * 86399 + floor(coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY event_id), 0)))::BIGINT * 1000000)::BIGINT), '%Y-%m-%dT%H:%M:%SZ') AS start_time FROM events""")
def step_times(spark, d):
    e = I.table(spark, d, "events").withColumn("began", F.col("user_id") * 86_399)
    return reports.step_deltas(e, "user_id", "event_id", ["value"], "value", "began").select("user_id", "event_id", "start_time")


@query("SELECT event_id, ts, event_type, value FROM events WHERE event_type IN ('click', 'error') AND ts >= (SELECT min(ts) FROM events) AND value > 5 ORDER BY ts DESC, event_id DESC LIMIT 100")
def log_tail(spark, d):
    log = I.table(spark, d, "events").withColumn("level", F.col("event_type")).select("event_id", "ts", "level", "event_type", "value")
    since = F.lit("1990-01-01").cast("timestamp_ntz")
    return reports.log_rows(log, "ts", level="click", levels=("view", "click", "error"), since=since, holds=F.col("value") > 5, last=100).select("event_id", "ts", "event_type", "value")


@query("SELECT array_to_string(list_sort(list(DISTINCT c_mktsegment))[1:3], ',') AS items, count(DISTINCT c_mktsegment) - 3 AS more FROM customer")
def first_and_more(spark, d):
    return reports.first_and_more(I.table(spark, d, "customer"), "c_mktsegment", 3).select(F.array_join("items", ",").alias("items"), "more")


@query("SELECT doc_id, (doc_id - (SELECT min(doc_id) FROM documents)) % 7 <> 3 AS answered FROM documents")
def batch_replies(spark, d):
    """Replies to batches of 32: each leaves out the documents of one remainder, which are asked again singly."""
    docs = I.table(spark, d, "documents").select("doc_id")
    asked = tasks.batches(docs, "doc_id", 32)
    first = docs.agg(F.min("doc_id").alias("first"))
    given = asked.join(first).where((F.col("doc_id") - F.col("first")) % 7 != 3)
    replies = given.groupBy("batch_id").agg(F.collect_list(F.struct("chunk_index", F.lit("ok").alias("said"))).alias("results"))
    got, missed = tasks.match_replies(asked, replies)
    return got.select("doc_id", F.lit(True).alias("answered")).unionByName(missed.select("doc_id", F.lit(False).alias("answered")))


@query("SELECT conv_id, turn, CASE WHEN min(conv_id * 100 + turn) OVER (PARTITION BY text) % 2 = 0 THEN 'known ' || substr(text, 1, 5) ELSE 'asked ' || substr(text, 1, 5) END AS reply FROM conversations")
def cached_replies(spark, d):
    """Prompts of which some are cached, one of them twice; the others are asked of a given function."""
    c = I.table(spark, d, "conversations")
    seen = c.groupBy("text").agg(F.min(F.col("conv_id") * 100 + F.col("turn")).alias("k")).where("k % 2 = 0")
    cache = seen.select(F.sha2("text", 256).alias("prompt_sha"), F.concat(F.lit("known "), F.substring("text", 1, 5)).alias("reply"))
    twice = cache.unionByName(cache.select("prompt_sha", F.concat("reply", F.lit("!")).alias("reply")))
    return tasks.complete(c.select("conv_id", "turn", "text"), "text", lambda prompts: [f"asked {p[:5]}" for p in prompts], twice).select("conv_id", "turn", "reply")


@query("SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def last_step(spark, d):
    return reports.last_step(I.table(spark, d, "events"), "user_id", "event_id", "value")


@query("""SELECT event_type, count(*) FILTER (WHERE value > 10) AS succeeded, count(*) AS total, coalesce(sum(event_id % 5) FILTER (WHERE value > 10), 0)::BIGINT AS total_facts, coalesce(sum(event_id % 3) FILTER (WHERE value > 10), 0)::BIGINT AS total_comparisons,
    floor(avg(floor(value)) FILTER (WHERE value > 10) * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE AS avg_seconds, sum((user_id % 4 = 0)::INT)::BIGINT AS total_retries, count(*) FILTER (WHERE user_id % 4 = 0) AS chunks_needing_retry FROM events GROUP BY event_type""")
def model_summary(spark, d):
    e = I.table(spark, d, "events")
    out = reports.model_summary(e, "event_type", F.col("value") > 10, F.col("event_id") % 5, F.col("event_id") % 3, F.floor("value").cast("double"), (F.col("user_id") % 4 == 0).cast("int"))
    return out.withColumn("avg_seconds", T.rounded(F.col("avg_seconds"), 3))


_CELL = "min(CASE WHEN value > 10 THEN (event_id % 5) || 'f' ELSE 'FAILED' END) FILTER (WHERE event_type = '{0}')"


@query("SELECT user_id, " + ", ".join(f"coalesce({_CELL.format(t)}, 'n/a') AS \"{t}\"" for t in ("view", "click", "error")) + " FROM events GROUP BY user_id")
def model_pivot(spark, d):
    return reports.model_pivot(I.table(spark, d, "events"), "user_id", "event_type", ["view", "click", "error"], F.when(F.col("value") > 10, F.concat((F.col("event_id") % 5).cast("string"), F.lit("f"))).otherwise("FAILED"))


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def stream_tasks(spark, d):
    """Newest attempt of each user, from events read as a stream that ends with what is there."""
    import uuid

    from siltstone.engine import shared_dir, stored
    from siltstone.streaming import tasks as stream

    base = f"{shared_dir(spark)}/siltstone-stream-{uuid.uuid4().hex}"
    events = I.table(spark, d, "events")
    source = stored(events, "stream-source")
    return stream.ingest(spark, source.inputFiles()[0].rsplit("/", 1)[0], events._jdf.schema().toDDL(), f"{base}/checkpoint", f"{base}/target", "user_id", "event_id").select("user_id", "event_id", "event_type", "value")
