import brute
import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from siltstone.llm import bpe


def test_stages_match_brute_force(spark):
    words = [f"w{i}" for i in range(300)]
    base = " ".join(words[:120])
    rows = [(1, base), (2, base), (3, base.replace("w5 ", "q5 ")), (4, " ".join(words[130:200])), (5, "leak " + " ".join(words[200:212])), (6, None), (7, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    bench = [(1, " ".join(words[200:212]))]
    kept = [(i, t) for i, t in rows if dict((r[0], r[3]) for r in brute.exact(rows))[i]]
    kept = [(i, t) for i, t in kept if dict((r[0], r[3]) for r in brute.near(kept))[i]]
    clean = {r[0] for r in brute.leaks(kept, bench) if not r[5]}
    got = corpus_pipeline.without_near_copies(spark, corpus_pipeline.without_copies(spark, docs, ""), "")
    got = __import__("siltstone.llm.decontaminate", fromlist=["x"]).drop_contaminated(got, spark.createDataFrame(bench, "item_id long, text string"))
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == clean
    with open(corpus_pipeline.VOCABULARY, "rb") as f:
        theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(f.read()), special_tokens={})
    text = dict(rows)
    for r in corpus_pipeline.tokens(spark, got, "").collect():
        assert r["n_tokens"] == len(theirs.encode_ordinary(text[r["doc_id"]] or ""))


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_run_matches_brute_force(spark):
    from siltstone.llm import quality

    sf = "/root/testdata/sf0.001"
    docs, labels, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    model = quality.fit_quality(docs, labels)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    good = [(i, t) for i, t in rows if model.score(np.array([quality.features(t or "")]))[0] >= quality.LEAST_SCORE]
    kept = {r[0] for r in brute.exact(good) if r[3]}
    one = [(i, t) for i, t in good if i in kept]
    kept = {r[0] for r in brute.near(one) if r[3]}
    two = [(i, t) for i, t in one if i in kept]
    clean = {r[0] for r in brute.leaks(two, [(r["item_id"], r["text"]) for r in bench.collect()]) if not r[5]}
    got = corpus_pipeline.run(spark, sf).collect()
    assert 0 < len(clean) < len(two) < len(rows) and len(two) <= len(one) <= len(good) < len(rows)
    assert sorted(r["doc_id"] for r in got) == sorted(clean)
    with open(corpus_pipeline.VOCABULARY, "rb") as f:
        theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(f.read()), special_tokens={})
    text = dict(rows)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == theirs.encode_ordinary(text[r["doc_id"]] or "") and r["ids_sha256"] == brute.sha(bytes(r["ids"])) and r["decoded_sha256"] == brute.sha((text[r["doc_id"]] or "").encode())


def test_run_on_empty_tables(spark, tmp_path):
    schemas = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for name, ddl in schemas.items():
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    for name, query in __spark_entry__.queries().items():
        if name.startswith(("op1_", "op2_", "op3_", "op4_", "op6_", "op7_", "op8_", "op9_", "op10_")):
            assert query(spark, str(tmp_path)).collect() == []


def test_tables_on_the_way_are_few_files(spark, monkeypatch):
    from siltstone.llm import components, decontaminate, exact_dedup, labelled, near_dedup

    files = {}

    def spy(df, label, real=exact_dedup.stored):
        out = real(df, label)
        files[label] = max(files.get(label, 0), len(out.inputFiles()))
        return out

    sf = "/root/testdata/sf0.001"
    plain = sorted(r["doc_id"] for r in corpus_pipeline.run(spark, sf).select("doc_id").collect())
    for module in (components, decontaminate, exact_dedup, labelled, near_dedup):
        monkeypatch.setattr(module, "stored", spy)
    many = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in many}
    try:
        for k, v in many.items():
            spark.conf.set(k, v)
        got = sorted(r["doc_id"] for r in corpus_pipeline.run(spark, sf).select("doc_id").collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == plain
    assert {"sample", "block-names", "block-ids", "groups", "gone", "windows", "rarity", "probe"} <= set(files)
    assert max(files.values()) <= 8, files


def test_documents_that_may_go_come_back_in_few_partitions(spark):
    from siltstone.llm import common

    docs = common.stored(spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")), "docs")
    gone = common.stored(spark.range(0, 3000, 2).select(F.col("id").alias("_gone"), (F.col("id") % 3).alias("_x")), "gone")
    many = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in many}
    try:
        for k, v in many.items():
            spark.conf.set(k, v)
        out = common.without(docs, gone, (docs["doc_id"] == gone["_gone"]) & (gone["_x"] > 0), 3000)
        got, files = sorted(r["doc_id"] for r in out.collect()), len(common.stored(out, "left").inputFiles())
        assert got == [i for i in range(3000) if i % 2 or i % 3 == 0]
        assert files <= docs.rdd.getNumPartitions() + 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_small_memo_gives_the_same_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(50)
    small = bpe.encode_documents(docs, corpus_pipeline.VOCABULARY, public_tokenizers.PATTERN, memo_entries=10)
    plain = bpe.encode_documents(docs, corpus_pipeline.VOCABULARY, public_tokenizers.PATTERN)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, plain.collect()))
    assert corpus_pipeline.MEMO_ENTRIES < bpe.MEMO_ENTRIES
