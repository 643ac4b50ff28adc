import math

import re

import pytest
from pyspark.sql import functions as F

from siltstone import catalog
from siltstone.functions import metrics as M
from siltstone.functions import text as T
from siltstone.operators import corpus, dedupe, evaluate, export, ontology, records, reports, tasks
from siltstone.sources import jsonl


def one(spark, column, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, F.lit(v) if not isinstance(v, list) else F.array(*map(F.lit, v)))
    return df.select(column.alias("x")).first()["x"]


def moved_bytes(spark):
    """Bytes that all stages so far have shuffled, spilled and written."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(x.shuffleWriteBytes() + x.diskBytesSpilled() + x.outputBytes() for x in (stages.apply(i) for i in range(stages.size())))


@pytest.mark.parametrize(("text", "want"), [("Yes, it is", "yes"), ("I think NO.", "no"), ("  Maybe", "m"), ("yesterday no", "no"), ("", "")])
def test_yes_no(spark, text, want):
    assert one(spark, T.yes_no(F.col("t")), t=text) == want


@pytest.mark.parametrize(("name", "want"), [("MixedMetalOxide", "mixed metal oxide"), ("NickelOxide811", "nickel oxide 811"), ("cell", "cell")])
def test_spaced_name(spark, name, want):
    assert one(spark, T.spaced_name(F.col("t")), t=name) == want


def test_model_family_and_licences(spark):
    assert one(spark, T.model_family(F.col("t")), t="a/b/qwen-2-7b") == "qwen"
    assert one(spark, T.model_family(F.col("t")), t="") is None
    for license, want in (("CC-BY-4.0", "ALLOWED"), ("CC-BY-SA-4.0", "FLAGGED"), ("CC-BY-NC-4.0", "REJECTED"), ("", "UNKNOWN"), ("CC0-1.0", "ALLOWED"), ("public-domain", "ALLOWED")):
        assert one(spark, T.license_verdict(F.col("t")), t=license) == want


def test_garble_counts_whole_runs(spark):
    assert one(spark, T.garble_ratio(F.col("t")), t="a b c d word") == 0.8
    assert one(spark, T.garble_ratio(F.col("t")), t="a b c word d") == 0.0
    assert one(spark, T.garble_ratio(F.col("t")), t="  ") == 0.0


def test_grounding(spark):
    assert one(spark, T.overlap_ratio(F.col("s"), F.col("c")), s="The cell lost 12 %", c="the cell was lost") == 0.75
    assert one(spark, T.overlap_ratio(F.col("s"), F.col("c")), s="...", c="x") == 0.0


def test_each_item_meets_each_document(spark, tmp_path):
    from siltstone.plans import corpus as plans

    spark.createDataFrame([(1, "the cell lost charge"), (2, "..."), (3, "lost")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(1, "nothing here"), (2, "The CELL lost some"), (41, "lost")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["item_id"], r["doc_id"]): r["overlap"] for r in plans.grounded_sources(spark, str(tmp_path)).collect()}
    assert got == {(1, 2): 0.75, (3, 2): 1.0, (3, 41): 1.0}
    pairs = spark.createDataFrame([("the cell lost charge", "The CELL lost some"), ("lost", "nothing"), ("...", "x")], "a string, b string")
    checked = [(r["overlap"], r["status"], r["reject_reason"]) for r in records.check_grounding(pairs, F.col("a"), F.col("b")).collect()]
    assert checked == [(0.75, "generated", None), (0.0, "rejected", "not_grounded"), (0.0, "rejected", "not_grounded")]


def test_overlap_prefix_ends_at_the_first_blank_line(spark):
    assert one(spark, T.without_overlap(F.col("t"), F.col("n")), t="tail\n\nbody\n\nmore", n=3) == "body\n\nmore"
    assert one(spark, T.without_overlap(F.col("t"), F.col("n")), t="a\n\nb", n=0) == "a\n\nb"


def test_wilson(spark):
    def wilson(k, n):
        low, high = M.wilson(F.col("k"), F.col("n"))
        return one(spark, F.array(low, high), k=k, n=n)

    assert wilson(0, 0) == [0.0, 0.0] and wilson(5, 5)[1] == 1.0
    p, z, n = 0.7, 1.96, 10
    mid, half = (p + z * z / (2 * n)) / (1 + z * z / n), z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    assert wilson(7, 10) == pytest.approx([mid - half, mid + half])


def test_power_of_a_wrapped_reading(spark):
    drawn = M.battery_power_mw(F.lit(False), F.lit(None).cast("double"), F.lit("18446744073709551115").cast("decimal(20,0)"), F.lit(4000.0))
    assert one(spark, drawn) == pytest.approx(501 * 4.0)
    assert one(spark, M.battery_power_mw(F.lit(True), F.lit(9.0), F.lit(None).cast("decimal(20,0)"), F.lit(1.0))) == 9.0
    assert one(spark, M.gib(F.lit(1 << 31))) == 2.0


CHUNK = "chunk_id string, doc_id string, order int, tokens int, text string, overlap_prev_tokens int"


def test_packing_stays_within_documents_and_budget(spark):
    rows = [(f"a#{i}", "a", i, n, f"t{i}", 0) for i, n in enumerate((30, 35, 20, 45))] + [("b#0", "b", 0, 10, "u", 0), ("b#1", "b", 1, 5, "  ", 0), ("c#0", "c", 0, 500, "big", 0)]
    got = {(r["doc_id"], r["row"]): (r["tokens"], r["text"]) for r in corpus.pack(spark.createDataFrame(rows, CHUNK), 100).collect()}
    assert got == {("a", 0): (85, "t0\n\nt1\n\nt2"), ("a", 1): (45, "t3"), ("b", 0): (10, "u"), ("c", 0): (500, "big")}


def test_chunks_overlap_by_last_tokens(spark):
    df = spark.createDataFrame([(1, "a b c\n\nd e\nf"), (2, None), (3, "")], "doc_id long, text string")
    got = [(r["chunk_id"], r["text"], r["overlap_prev_tokens"]) for r in corpus.chunk(df, 3, 2).orderBy("chunk_id").collect()]
    assert got == [("1#c00", "a b c", 0), ("1#c01", "b c\n\nd e\nf", 2)]


def test_chunk_ids_stay_unique_past_the_hundredth(spark, tmp_path):
    from siltstone.plans import corpus as plans

    df = spark.createDataFrame([(1, "\n".join(f"w{i} " * 100 for i in range(130)))], "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = [r["chunk_id"] for r in plans.chunk_segments(spark, str(tmp_path)).orderBy("chunk_order").collect()]
    assert got == [f"1#c{i:02d}" for i in range(130)]


def brute_pieces(text, most):
    out = []
    for line in filter(str.strip, text.split("\n")):
        if len(line.split()) <= most:
            out.append(("\n", line))
            continue
        runs = []
        for s in re.split(r"(?<=[.!?])\s+", line):
            w = s.split()
            runs += [s] if len(w) <= most else [" ".join(w[i : i + most]) for i in range(0, len(w), most)]
        out += [("\n" if i == 0 else " ", s) for i, s in enumerate(runs)]
    return out


def test_long_lines_are_cut_at_sentences(spark):
    text = "one two three. four five!  six\n\nseven eight nine ten eleven twelve thirteen? fourteen. " + "w " * 23 + "end. last\nshort"
    for target, most in ((4, 5), (10, 7), (3, 3)):
        want, n = [], 0
        for sep, piece in brute_pieces(text, most):
            size = len(piece.split())
            if want and n + size <= target:
                want[-1] += sep + piece
                n += size
            else:
                want.append(piece)
                n = size
        got = corpus.chunk(spark.createDataFrame([(1, text)], "doc_id long, text string"), target, most=most).orderBy("order").collect()
        assert [r["text"] for r in got] == want
        assert [r["tokens"] for r in got] == [len(t.split()) for t in want] and max(r["tokens"] for r in got) <= max(target, most)


def test_chunking_and_packing_of_a_long_document(spark):
    lines = [" ".join(f"w{i}_{j}" for j in range(1 + i * 7 % 13)) for i in range(3000)]
    docs = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    chunks = corpus.chunk(docs, 50, overlap=5)
    packed = corpus.pack(chunks, 200).orderBy("row").collect()
    assert "\n".join(r["text"] for r in packed).replace("\n\n", "\n") == "\n".join(lines) and max(r["tokens"] for r in packed) <= 200
    assert [r["row"] for r in packed] == list(range(len(packed))) and sum(len(r["chunk_ids"]) for r in packed) == chunks.count()


def test_sections_keep_their_path(spark):
    page = "<html><script>var a='<h1>no</h1>';</script>before<h1>A</h1>one<h3 class=x>C <b>c</b></h3>two<H2>B</H2>three<h3>D</h3>four<h1>E</h1><!-- <h2>no</h2> -->"
    rows = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id int, html string")
    got = {(r["page_id"], r["section"]): (r["level"], r["path"], r["text"]) for r in corpus.sections(rows, "page_id").collect()}
    assert got == {(1, 0): (0, [], "before"), (1, 1): (1, ["A"], "one"), (1, 2): (3, ["A", "C c"], "two"), (1, 3): (2, ["A", "B"], "three"), (1, 4): (3, ["A", "B", "D"], "four"), (1, 5): (1, ["E"], ""), (3, 0): (0, [], "")}


def test_works_by_title_and_doi(spark):
    rows = [(1, "A b", None), (2, "a  B!", "10/x"), (3, "other", " 10/X "), (4, "", "10/y"), (5, None, "10/y"), (6, "Alone", "")]
    got = {r["doc_id"]: r["canonical_id"] for r in corpus.first_of_work(spark.createDataFrame(rows, "doc_id int, title string, d string"), F.col("title"), F.col("d")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6}


def test_grounded_sources_match_all_pairs(spark):
    import random

    r = random.Random(3)
    text = lambda n: " ".join(r.choice("abcdefghijklmnop") for _ in range(n))
    s, d = [(i, text(r.randint(0, 8))) for i in range(30)] + [(99, None)], [(i, text(r.randint(0, 14))) for i in range(60)] + [(98, None)]
    got = records.grounded_sources(spark.createDataFrame(s, "s int, t string"), "s", F.col("t"), spark.createDataFrame(d, "d int, t string"), "d", F.col("t")).collect()
    want = {(i, j) for i, t in s for j, u in d if t and u and len(set(t.split()) & set(u.split())) / len(set(t.split())) >= 0.6 - 1e-9}
    assert {(x["s"], x["d"]) for x in got} == want and len(got) == len(want)


@pytest.mark.parametrize("words", [0, 100_000])
def test_grounded_sources_move_little(spark, tmp_path, words):
    import random

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    r = random.Random(4)
    text = lambda n: " ".join(f"word{r.randrange(400)}" for _ in range(n))
    s, d = [(i, text(30)) for i in range(60)] + [(98, None), (99, "...")], [(i, text(200)) for i in range(600)]
    d += [(1000 + i, t.upper()) for i, t in s[:5]] + [(2000, None), (2001, "")]
    for name, rows in (("s", s), ("d", d)):
        spark.createDataFrame(rows, "k long, t string").write.parquet(str(tmp_path / name))
    before = moved_bytes(spark)
    named = {"broadcast_words": words} if words != 100_000 else {}
    got = records.grounded_sources(spark.read.parquet(str(tmp_path / "s")), "k", F.col("t"), spark.read.parquet(str(tmp_path / "d")).withColumnRenamed("k", "j"), "j", F.col("t"), **named).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    moved, sets = moved_bytes(spark) - before, [[(k, set((t or "").lower().split()) - {"..."}) for k, t in x] for x in (s, d)]
    want = {(i, j): len(x & y) / len(x) for i, x in sets[0] for j, y in sets[1] if x and len(x & y) >= 0.6 * len(x) - 1e-9}
    assert {(x["k"], x["j"]): x["overlap"] for x in got} == want and len(got) == len(want) >= 5
    assert not words or moved < sum(len(t or "") for _, t in d)


def test_a_stage_asks_pending_items_once(spark):
    stage = tasks.Stage("reject", lambda rows: F.col("q"), "dpo_rejection", lambda good: good.select("id", F.col("parsed.rejected").alias("rejected")))
    rows = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "done before"), (4, "later")], "id int, q string")
    done = spark.createDataFrame([("reject:3", "done"), ("reject:2", "failed")], "key string, status string")
    answers = lambda prompts: ['{"rejected": " no ", "error_type": "overclaiming"}' if p == "good" else "no idea" for p in prompts]
    made, outcomes = stage.run(rows, done, "id", answers, first=2)
    assert [tuple(r) for r in made.collect()] == [(1, "no")]
    assert sorted(tuple(r) for r in outcomes.collect()) == [("reject:1", "done", None), ("reject:2", "failed", "not JSON")]


def test_routes_respect_attempts(spark):
    routes = spark.createDataFrame([("t", "a", 0), ("t", "b", 1), ("u", "a", 0)], "task string, name string, position int")
    deployments = spark.createDataFrame([("a", "fa", True), ("b", "fb", True)], "name string, family string, available boolean")
    made = spark.createDataFrame([], "task string, generator_family string")
    tried = spark.createDataFrame([("t", "a", 3), ("u", "a", 10)], "task string, name string, attempts int")
    assert sorted(tuple(r) for r in tasks.choose_route(routes, deployments, made).collect()) == [("t", "a"), ("u", "a")]
    assert [tuple(r) for r in tasks.choose_route(routes, deployments, made, tried).collect()] == [("t", "b")]


def test_times_and_manifest_filter(spark):
    got = spark.createDataFrame([(0.0,), (1_700_000_000.9,), (-1.0,)], "t double").select(reports.utc_text(F.col("t"))).collect()
    assert [r[0] for r in got] == ["1970-01-01T00:00:00Z", "2023-11-14T22:13:20Z", "1969-12-31T23:59:59Z"]
    none = spark.createDataFrame([], "x string")
    assert [tuple(r) for r in reports.first_and_more(none, "x").collect()] == [([], 0)]
    manifest = spark.createDataFrame([("train", "d1", "MIT", "t", [0, 2]), ("train", "d2", None, "u", [1])], "split string, source_key string, license string, title string, row_indexes array<long>")
    kept = export.manifest_without(manifest, spark.createDataFrame([("d2",)], "source_key string")).first()
    assert list(kept["sources"]) == ["d1"] and kept["sources"]["d1"]["row_indexes"] == [0, 2]


def test_rows_of_parents_need_the_whole_id(spark):
    rows = spark.createDataFrame([("d:1#c0",), ("d:10#c0",), ("d:1#c0#neg",), ("d:1",), (None,)], "id string")
    parents = spark.createDataFrame([("d:1",), ("d:1",), (None,)], "p string")
    assert sorted(r[0] for r in records.of_parent(rows, "id", parents, "p").collect()) == ["d:1#c0", "d:1#c0#neg"]
    assert records.of_parent(rows, "id", spark.createDataFrame([("d:10#c0",)], "p string"), "p").collect() == []


def test_garble_counts_whole_runs(spark):
    texts = ["a b c d", "a b c de", "aa b c d e ff g h i j", "", "é ü \t ö ä", "a  b\nc d e word"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.garble_ratio(F.col("t"))).collect()]

    def ratio(t):
        w, bad, run = t.split(), 0, 0
        for x in [*w, "--"]:
            if len(x) == 1:
                run += 1
            else:
                bad, run = bad + (run if run >= 4 else 0), 0
        return bad / len(w) if w else 0

    assert got == [ratio(t) for t in texts]


def test_filters_keep_all_that_is_there(spark):
    from siltstone import engine

    values = spark.range(0, 3000, 3).select((F.col("id") * 7919).alias("v")).unionByName(spark.createDataFrame([(None,)], "v long"))
    rows = spark.range(6000).select(F.when(F.col("id") > 0, F.col("id") * 7919).alias("k"), F.col("id").alias("n"))
    for some in (values, values.limit(0)):
        bits, there = engine.filter_of(some, "v"), {r["v"] for r in some.collect()}
        maybe, no = ({(r["k"], r["n"]) for r in f(rows, F.col("k"), bits).collect()} for f in (engine.may_be_in, engine.cannot_be_in))
        assert len(maybe) + len(no) == 6000 and not maybe & no and not {k for k, _ in no} & there
        assert len(maybe) <= len(there) + 5 and engine.may_be_in(rows, F.col("k"), bits).columns == ["k", "n"]


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from siltstone import engine

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        engine.shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))


def test_evidence_and_pivot_read_every_event(spark, tmp_path):
    from siltstone.plans import queue, training

    rows = [(1, 7, "view", 20.0), (2, 7, "click", 6.0), (3, 8, "view", 20.0), (4, 7, "error", 1.0), (20, 8, "view", 2.0)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    assert [tuple(r) for r in training.enough_facts(spark, str(tmp_path)).collect()] == [("c7", 2)]
    assert {tuple(r) for r in queue.model_pivot(spark, str(tmp_path)).select("user_id", "view", "click", "error").collect()} == {(7, "1f", "FAILED", "FAILED"), (8, "3f", "n/a", "n/a")}


def test_benchmark_takes_the_fixed_targets(spark, monkeypatch):
    from siltstone.plans import training

    d, seen = "/root/testdata/sf0.1", []
    gold = evaluate.gold
    monkeypatch.setattr(evaluate, "gold", lambda *a, **k: seen.append(a) or gold(*a, **k))
    got = {r["category"]: r["n"] for r in training.gold_counts(spark, d).collect()}
    qa, negatives, ideas, docs = seen[0][:4]
    whole = {r["category"]: r["count"] for r in gold(qa, negatives, ideas, docs, dict.fromkeys(evaluate.TARGETS, 10**6)).groupBy("category").count().collect()}
    assert got == {k: min(n, evaluate.TARGETS[k]) for k, n in whole.items()} and whole["closed_qa"] > 3
    small = {r["category"]: r["count"] for r in gold(qa, negatives, ideas, docs, evaluate.TARGETS | {"closed_qa": 2}).groupBy("category").count().collect()}
    assert small == got | {"closed_qa": 2}


def test_images_link_by_name(spark):
    chunks = spark.createDataFrame([("c1", "d", ["fig/a.png", "b.png"]), ("c2", "d", ["none.png"]), ("c3", "e", ["a.png"])], "chunk_id string, doc_id string, images array<string>")
    files = spark.createDataFrame([("d", "image", "/s/a.png"), ("d", "pdf", "/s/b.png")], "doc_id string, kind string, path string")
    assert [tuple(r) for r in corpus.link_images(chunks, files).collect()] == [("c1", "d", ["/s/a.png"])]


@pytest.mark.parametrize(("reply", "contract", "error"), [
    ('{"name": "LFP", "class": "phosphate"}', "material", None), ('Sure:\n```json\n{"name": "LFP"}\n```', "material", None), ("no json", "material", "not JSON"), ('{"name": ', "material", "not JSON"), ('{"x": 1}', "material", "no field of the schema"),
    ('{"name": " "}', "material", None), ('{"name": null}', "material", "name: missing"), ('{"name": "a", "component": "wheel"}', "material", "component: not an allowed value"), ("{}", "extraction_batch", None), ('{"results": [{"facts": []}]}', "extraction_batch", "results: chunk_index: missing"),
    ('{"results": [{"chunk_index": 0, "pairs": [{"sentence_1": "a", "sentence_2": "b", "category": "paraphrase", "subset_name": "odd"}]}]}', "claim_batch", "results: pairs: subset_name: not an allowed value"), ('{"correct": true, "score": 6}', "open_judge", "score: not from 1 to 5"),
    ('{"score": 3}', "open_judge", "correct: missing"), ('{"caught_flaw": false}', "negative_judge", None), ('{"groundedness": 4, "correctness": 4, "novelty": 3, "feasibility": 0}', "ideation_judge", "feasibility: not from 1 to 5"),
    ('{"rejected": "x", "error_type": "overclaiming"}', "dpo_rejection", None), ('{"problem": "p", "reasoning": "r", "ideas": [{"hypothesis": "h", "mechanism": "", "risks": "r"}]}', "ideation", "ideas: mechanism: blank"),
    ('{"items": []}', "qa_generation", None), ('{"hypothesis": "h", "mechanism": "m", "risks": "r"}', "idea", None), ('{"sentence_1": "a", "sentence_2": "b", "category": "contradiction", "subset_name": "swap"}', "claim_pair", None),
    ('{"baseline": "a", "modification": "b", "metric": "c", "direction": "up", "evidence_sentence": "e"}', "comparison", "direction: not an allowed value")])
def test_contracts(spark, reply, contract, error):
    got = records.validate(spark.createDataFrame([(reply,)], "reply string"), "reply", contract).first()
    assert (got["error"], got["valid"]) == (error, error is None)


def test_judge_and_rationale(spark):
    rows = spark.createDataFrame([(4, 4, 3, "ok"), (4, 3, 3, "weak"), (4, 4, None, "")], "faithfulness int, correctness int, specificity int, why string")
    assert [(r["status"], r["reject_reason"]) for r in records.judge(rows, records.QA_FLOOR, F.col("why")).collect()] == [("accepted", None), ("rejected", "judge:weak"), ("rejected", "judge:below_threshold")]


def test_long_rationales_are_cut(spark):
    rows = spark.createDataFrame([(1, "é" * 3000)], "faithfulness int, why string")
    reason = records.judge(rows, {"faithfulness": 4}, F.col("why")).first()["reject_reason"]
    assert len(reason) == 2000 and reason == "judge:" + "é" * 1994


def test_replies_meet_their_chunks(spark):
    asked = spark.createDataFrame([(0, 0, "a"), (0, 1, "b"), (1, 0, "c")], "batch_id long, chunk_index int, chunk_id string")
    replies = spark.createDataFrame([(0, [(1, "x")]), (1, [(0, "y")])], "batch_id long, results array<struct<chunk_index:int,v:string>>")
    met, left = tasks.match_replies(asked, replies)
    assert {r["chunk_id"] for r in met.collect()} == {"b", "c"} and [r["chunk_id"] for r in left.collect()] == ["a"]


def test_completion_asks_only_what_the_cache_lacks(spark):
    rows = spark.createDataFrame([(1, "p1"), (2, "p2")], "id long, prompt string")
    cache = spark.createDataFrame([("p1", "known")], "p string, reply string").select(F.sha2("p", 256).alias("prompt_sha"), "reply")
    got = tasks.complete(rows, "prompt", lambda ps: [p.upper() for p in ps], cache)
    assert {(r["id"], r["reply"]) for r in got.collect()} == {(1, "known"), (2, "P2")}
    twice = tasks.complete(rows, "prompt", lambda ps: [p.upper() for p in ps], cache.unionByName(cache.withColumn("reply", F.lit("zz"))))
    assert sorted((r["id"], r["reply"]) for r in twice.collect()) == [(1, "known"), (2, "P2")]


def test_duplicates_within_buckets(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(1, base, "x"), (2, base + " end", "x"), (3, base, "y"), (4, base.upper(), "x"), (5, "other words here now", "x"), (6, "", "x")], "id long, t string, b string")
    got = {r["id"]: (r["duplicate_of"], r["status"]) for r in dedupe.mark_duplicates(rows, "id", F.col("t"), ["b"]).collect()}
    assert got == {1: (None, "accepted"), 2: (1, "rejected"), 3: (None, "accepted"), 4: (1, "rejected"), 5: (None, "accepted"), 6: (None, "accepted")}


def test_copies_get_the_least_key_of_all_they_duplicate(spark):
    base = " ".join(f"w{i}" for i in range(60))
    x, y = base, base + " end"
    for texts, want in (((x, y, y), [None, 1, 1]), ((y, x, x, y), [None, 1, 1, 1])):
        df = spark.createDataFrame([(i + 1, t, "b") for i, t in enumerate(texts)], "id long, t string, b string")
        assert [r["duplicate_of"] for r in dedupe.mark_duplicates(df, "id", F.col("t"), ["b"]).orderBy("id").collect()] == want


def test_near_duplicates_of_texts_with_a_common_line_move_little(spark, tmp_path):
    import random

    r = random.Random(5)
    text = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    line = text(120)
    rows = [(i, f"{text(150)} {line} {text(150)}", "b") for i in range(400)]
    rows += [(1000 + i, rows[7][1] + f" end{i}", "b") for i in range(3)]
    spark.createDataFrame(rows, "id long, t string, b string").write.parquet(str(tmp_path / "d"))
    before, df = moved_bytes(spark), spark.read.parquet(str(tmp_path / "d"))
    got = {x["id"]: x["duplicate_of"] for x in dedupe.mark_duplicates(df, "id", F.col("t"), ["b"]).collect()}
    assert {k: v for k, v in got.items() if v is not None} == {1000: 7, 1001: 7, 1002: 7} and len(got) == len(rows)
    assert moved_bytes(spark) - before < sum(len(x[1]) for x in rows)


@pytest.mark.parametrize("cell", [10, 1_000_000])
def test_near_duplicates_as_by_brute_force(spark, monkeypatch, cell):
    import random

    monkeypatch.setattr(dedupe, "SAMPLE", 2)
    monkeypatch.setattr(dedupe, "CELL", cell)
    r = random.Random(11)
    texts = []
    for i in range(160):
        if i % 4 == 0 or not texts:
            w = [r.choice("abcdefghij") + str(r.randrange(4)) for _ in range(r.choice((0, 1, 2, 3, 5, 9, 14, 40, 90)))]
        else:
            w = list(texts[r.randrange(len(texts))])
            for _ in range(r.randrange(4)):
                w.insert(r.randrange(len(w) + 1), r.choice("abc"))
        texts.append(w)
    rows = [(i, " ".join(w) if i != 50 else None, "xy"[i % 2] if i % 40 else None) for i, w in enumerate(texts)]
    sets = {i: {tuple(t.split()[p:p + 3]) for p in range(max(len(t.split()) - 2, 1))} if t else set() for i, t, _ in rows}
    like = lambda x, y: bool(x and y) and len(x & y) >= 0.85 * len(x | y) - 1e-9
    want = {i: min((j for j, _, c in rows[:i] if b is not None and b == c and like(sets[i], sets[j])), default=None) for i, _, b in rows}
    got = {x["id"]: x["duplicate_of"] for x in dedupe.mark_duplicates(spark.createDataFrame(rows, "id long, t string, b string"), "id", F.col("t"), ["b"]).collect()}
    assert got == want and sum(v is not None for v in want.values()) > 20
    links = {(x["duplicate"], x["original"]) for x in dedupe.duplicate_links(spark.createDataFrame(rows, "id long, t string, b string"), "id", F.col("t"), ["b"]).collect()}
    assert all(like(sets[a], sets[b]) and b < a for a, b in links)


def test_exports_guard_and_number(spark):
    docs = spark.createDataFrame([("d1", "train", "CC-BY-4.0", "t1", None, False), ("d2", None, "CC-BY-4.0", "t2", None, False), ("d3", "train", "CC-BY-NC-4.0", "t3", "10/x", False), ("d4", "eval", "CC0-1.0", "t4", None, True)], "doc_id string, split string, license string, title string, doi string, blacklisted boolean")
    chunks = spark.createDataFrame([("c1", "d1", "one"), ("c2", "d1", " \n"), ("c3", "d2", "two"), ("c4", "d3", "three"), ("c5", "d4", "four")], "chunk_id string, doc_id string, text string")
    extra = spark.createDataFrame([("o1", "ontology", "CC-BY-4.0", "onto")], "id string, text string, license string, title string")
    rows = export.cpt_rows(chunks, docs, extra)
    assert sorted((r["id"], r["split"], r["row_index"]) for r in rows.collect()) == [("c1", "train", 0), ("c4", "train", 1), ("o1", "train", 2)]
    assert sorted((r["id"], r["old_index"], r["row_index"]) for r in export.without_restricted(rows, ["old_index"]).collect()) == [("c1", 0, 0), ("o1", 2, 1)]
    assert [(r["shareable"], r["restricted_docs"]) for r in export.gate(rows).collect()] == [(False, 1)]
    assert {r["source_key"]: r["row_indexes"] for r in export.attribution(rows).collect()} == {"d1": [0], "10/x": [1], "o1": [2]}


def test_terms_longest_first_and_whole_words(spark):
    terms = spark.createDataFrame([("graphite electrode", "G"), ("electrode", "E"), ("si", "S"), ("c++ (alloy)", "A")], "term string, id string")
    q = spark.createDataFrame([(1, "Is a Graphite Electrode classified?"), (2, "An electrode of Si."), (3, "nothing"), (4, "on c++ (alloy) si")], "k int, q string")
    got = sorted((r["k"], r["id"]) for r in ontology.find_terms(q, "k", "q", terms).collect())
    assert got == [(1, "G"), (2, "E"), (2, "S"), (4, "A"), (4, "S")]


def test_term_match_as_its_sql_on_labels_and_marks(spark, tmp_path):
    import duckdb

    from siltstone.plans import training

    texts = ["A thing of the cell", "thing", "of-the end of the line", "of-the and proof theory", "of\nthe cell", "of-the cell", "THE, cell_ and-of the", "a salt of  the", "", None]
    spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{tmp_path}/benchmark.parquet/*.parquet')")
    got = training.term_match(spark, str(tmp_path)).select("item_id", "id", "term", "start").collect()
    want = con.execute(f"SELECT item_id, id, term, start FROM ({catalog.ORACLE_SQL['term_match']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want) and not any(r["term"] == "thing" for r in got)


def test_hierarchy_with_a_cycle(spark):
    c = spark.createDataFrame([("a", "A", None, None, None, "b"), ("b", "B", None, "is b", None, "a"), ("x", "MyCell", None, None, None, "gone")], "id string, label string, alt_label string, definition string, formula string, parent_id string")
    assert sorted((r["id"], r["depth"], r["ancestor"]) for r in ontology.ancestors(c).collect()) == [("a", 0, "a"), ("a", 1, "b"), ("b", 0, "b"), ("b", 1, "a"), ("x", 0, "x")]
    assert {r["id"] for r in ontology.subtree(c, "B").collect()} == {"a", "b"}
    chains = ontology.chains(c)
    assert chains.where("id = 'a'").select(ontology.context_block(F.col("chain"))).first()[0] == '[a]\n  is a kind of: b ("is b")'
    assert chains.where("id = 'a'").select(ontology.classification_line(F.col("chain"))).first()[0] == '- a: a is a kind of b - "is b"'


def test_reports(spark):
    log = spark.createDataFrame([("r", 1, 2.0, 10), ("r", 2, 5.0, 30)], "run string, step int, elapsed double, tokens long")
    assert [(r["d_elapsed"], r["d_tokens"]) for r in reports.step_deltas(log, "run", "step", ["elapsed", "tokens"]).orderBy("step").collect()] == [(2.0, 10), (3.0, 20)]
    assert evaluate.rubric_means(spark.createDataFrame([({"a": 1, "b": 2},), ({"a": 2},)], "scores map<string,int>")).orderBy("dimension").collect()[0]["mean"] == 1.5


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([(2, "é"), (1, None)], "id int, t string")
    jsonl.write_jsonl(rows, f"{tmp_path}/a", ["id"])
    assert [tuple(r) for r in jsonl.read_jsonl(spark, f"{tmp_path}/a", "id int, t string").select("id", "t").orderBy("id").collect()] == [(1, None), (2, "é")]
    (tmp_path / "empty.jsonl").write_text("\n\n")
    with pytest.raises(ValueError, match="no rows"):
        jsonl.read_jsonl(spark, f"{tmp_path}/empty.jsonl", "id int")
    assert not jsonl.write_csv(rows.limit(0), f"{tmp_path}/none") and not (tmp_path / "none").exists()
    (tmp_path / "ids").write_text("a\n\nb\na\n")
    assert sorted(r["id"] for r in jsonl.read_ids(spark, f"{tmp_path}/ids").collect()) == ["a", "b"]
    assert jsonl.json_document(spark.createDataFrame([("train", 2), ("eval", 1)], "k string, n int"), "k", "n").first()[0] == '{"eval":1,"train":2}'
