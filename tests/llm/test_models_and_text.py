import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from hand_pages import HAND_PAGES
from siltstone.llm import bpe, html_blocks, html_extract, quality, toxicity
from siltstone.llm.labelled import held_out

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(VOCABULARY, "rb") as f:
        return bpe.read_ranks(f.read())


def test_bpe_is_tiktokens(ranks):
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own, r = bpe.Encoder(ranks, public_tokenizers.PATTERN, memo_entries=50), random.Random(2)
    texts = ["", "a" * 5001, "ab" * 3000, " " * 999 + "x", "\x1c \x85 x ​", "é" * 300, "\U0001f600" * 99, "<|endoftext|>"]
    texts += ["".join(r.choice(["a", "b", " ", "\n", "é", "٣", "字", ".", "'s", "'ll", "the"]) for _ in range(150)) for _ in range(150)]
    for t in texts:
        ids = own.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(t)
        assert own.decode(ids) == t.encode()


def test_bpe_of_long_texts_and_rows(spark, ranks, monkeypatch):
    own = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    text = "some words, and 12 more. " * 2000
    whole = own.encode(text)
    monkeypatch.setattr(bpe, "LONG_TEXT", 10)
    assert own.encode(text) == whole
    rows = spark.createDataFrame([(1, "hello"), (None, None), (1, "")], "doc_id long, text string").withColumn("ids", F.lit(1))
    got = bpe.digests(bpe.encode_documents(rows, VOCABULARY, public_tokenizers.PATTERN)).collect()
    assert sorted(r["n_tokens"] for r in got) == [0, 0, len(own.encode("hello")) // 4]


def quality_tables(spark):
    r = random.Random(4)
    words = ["tion", "the", "ander", "of", "resting", "inou", "for", "ble"]
    good = lambda: " ".join(" ".join(r.choice(words) for _ in range(9)).capitalize() + "." for _ in range(r.randint(1, 9)))
    bad = lambda: r.choice([lambda: " ".join([r.choice(words)] * r.randint(40, 90)), lambda: good().upper().replace(" ", "!! "), lambda: good().replace(" ", "$$$ ")])()
    toxic = lambda: good() + " You are an idiot and a moron. " + good()
    rows = [(i, toxic() if i % 7 == 0 else bad() if i % 5 == 0 else good()) for i in range(900)]
    docs = spark.createDataFrame(rows + [(900, None), (901, ""), (None, "x")], "doc_id long, text string").withColumns({"score": F.lit(3), "y": F.lit(1)})
    labels = spark.createDataFrame([(i, int(i % 7 == 0 or i % 5 != 0), int(i % 7 == 0)) for i in range(0, 900, 2)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_quality_on_held_out_documents(spark):
    docs, labels = quality_tables(spark)
    got = quality.quality_report(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    right = [r["predicted"] == int(r["doc_id"] % 7 == 0 or r["doc_id"] % 5 != 0) for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert np.mean(right) > 0.95
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert {r["score"] for r in quality.quality_report(docs, labels.limit(0)).collect()} == {0.5}


def test_toxicity_on_held_out_documents(spark):
    docs, labels = quality_tables(spark)
    got = toxicity.toxicity_report(docs, labels).collect()
    right = [r["predicted"] == int(r["doc_id"] % 7 == 0) for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert len(got) == docs.count() and np.mean(right) > 0.97
    model = toxicity.fit_toxicity(docs, labels)
    text = "All is well. You are an idiot and a moron. Good day."
    spans = toxicity.offending_sentences(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()["spans"]
    assert [text[s["start"] : s["end"]].strip() for s in spans] == ["You are an idiot and a moron"]
    assert {(r["score"], r["sentences"]) for r in toxicity.toxicity_report(docs, labels.limit(0)).collect()} == {(0.0, "")}
    long = "It rests well. 12\n" * 10_000
    rows = spark.createDataFrame([(1, long), (1, long), (2, long + "You are an idiot and a moron."), (3, None), (4, ""), (None, "İ İ x. You are an idiot and a moron!")], "doc_id long, text string")
    got = [(r["doc_id"], r["score"], r["spans"]) for r in toxicity.judge_documents(rows, model).collect()]
    assert all((s < 0.2 and not spans) if d in (1, 3, 4) else (s > 0.7 and len(spans) == 1) for d, s, spans in got)
    assert {d: (x[0]["start"], x[0]["end"]) for d, _, x in got if x} == {2: (len(long), len(long) + 28), None: (6, 35)}


def test_models_without_documents(spark):
    _, labels = quality_tables(spark)
    none = spark.createDataFrame([], "doc_id long, text string")
    for report in (quality.quality_report, toxicity.toxicity_report):
        assert report(none, labels).collect() == []
    assert quality.keep_good(none, labels).collect() == []
    with pytest.raises(ValueError, match="at least 8"):
        quality.keep_good(spark.createDataFrame([(1, "x")], "doc_id long, text string"), labels)


def test_samples_are_whole_texts_of_distinct_ids(spark):
    from siltstone.llm.labelled import drawn

    docs = spark.createDataFrame([(i % 5, "x" * (30_000 + i)) for i in range(50)] + [(7, None)], "doc_id long, text string")
    ids = spark.createDataFrame([(i, 1) for i in range(9)] * 2, "doc_id long, y int")
    got = drawn(docs, ids, 9).collect()
    assert sorted((r["doc_id"], len(r["text"])) for r in got) == [(i, 30_000 + i) for i in range(5)] + [(7, 0)]
    assert drawn(docs, ids, 3).count() <= 3


def test_held_out_parts(spark):
    import zlib

    got = spark.range(300).select("id", held_out(F.col("id"), 4, 2).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in got)


def test_html_field_on_held_out_pages():
    field = html_extract.default_field()
    pages = html_extract.generated_pages(120, seed=99)
    right = [a == b for _, blocks, y in pages for a, b in zip(field.labels(blocks), y)]
    assert np.mean(right) > 0.98


@pytest.mark.parametrize("at", range(len(HAND_PAGES)))
def test_html_pages_of_other_systems(at):
    page, want = HAND_PAGES[at]
    assert html_extract.default_field().main_text(page) == want


@pytest.mark.parametrize(("page", "want"), [
    ("<p>a</p><svg class=x/><p>b</p>", ["a", "b"]), ("<p>a</p><svg><text>no</text></svg><p>b</p>", ["a", "b"]), ("<p>a</p><datalist><option value=x></datalist><p>b</p>", ["a", "b"]),
    ("<select><option>no<option>no</select>b", ["b"]), ("<option>no<p>b", ["b"]), ("<p>a<script>no<p>b", ["a", "b"]), ("<title>no</title><p>b", ["b"]), ("<textarea>no<p>no</p></textarea>b", ["b"]), ("<style>no", [])])
def test_raw_elements_leave_the_rest_of_the_page(page, want):
    assert [b.text for b in html_blocks.leaf_blocks(page)] == want


def test_html_of_no_pages(spark):
    assert html_extract.pages_report(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_html_pages(spark):
    page = """<html><head><title>T</title><script>var t="</p>";</script></head><body><nav><a href=/>Menu</a></nav><div class="ad">Buy now, it is cheap.</div>
      <article><h1>Head &amp; more</h1><p><b>First  part of a long enough sentence here.<br><p>Second &lt;part&gt; of the text, with <a href="x">a link</a> inside.</p></article>
      <div class="comments"><p>Nice words, I like them very much indeed.</p></div><footer>&copy; us</footer></body></html>"""
    rows = spark.createDataFrame([(1, "u", page), (2, None, None), (2, "v", ""), (None, "w", "<p")], "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in html_extract.pages_report(rows).collect()}
    want = "Head & more First part of a long enough sentence here. Second <part> of the text, with a link inside."
    assert got[(1, "u")] == (want, len(want)) and got[(2, None)] == ("", 0) and len(got) == 4


def test_blocks_survive_broken_markup():
    for page in ("<" * 5000, "<p title=\"" + "a" * 5000, "</div>" * 3000, "<svg>" * 20_000, "<option>" * 20_000, "<select>" * 20_000, "<b>" * 3000 + "x", "<!-- open", "<script>never closed"):
        html_blocks.leaf_blocks(page)


def test_batches_are_bounded_by_rows_and_bytes():
    import pyarrow as pa

    from siltstone.llm.common import bounded

    texts = ["a" * n for n in (3, 3, 3, 50, 1, 0, 9, 9, 1)] + [None, None, None, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["i", "t"])
    cut = list(bounded(iter([batch, batch.slice(0, 0)]), 1, 3, 10))
    assert [b.column(0).to_pylist() for b in cut] == [[0, 1, 2], [3], [4, 5, 6], [7, 8, 9], [10, 11, 12]]


def test_bpe_of_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(bpe.encode_documents(none, VOCABULARY, public_tokenizers.PATTERN)).collect() == []
