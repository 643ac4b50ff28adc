import random
from pathlib import Path

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.llm import near_dedup, recompression, setsketch, substring_dedup, words
from siltstone.llm.components import components

SCHEMA = "doc_id long, text string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def near_rows():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    rows, base = [(0, None), (1, ""), (2, " \t"), (3, "one"), (4, "ONE"), (5, "a b c d"), (6, "a b c d e")], [str(w) for w in rng.choice(words, 160)]
    for i in range(40):
        w = list(base)
        for _ in range(int(rng.integers(0, 9))):
            w[int(rng.integers(0, len(w)))] = f"x{rng.integers(0, 999)}"
        rows.append((10 + i, " ".join(w)))
    rows += [(100 + i, " ".join(map(str, rng.choice(words, 60)))) for i in range(30)]
    return rows + [(200, rows[12][1]), (201, rows[12][1].upper())]


def test_near_duplicates_match_brute_force(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(0) for c in ("node", "u", "band", "component", "rep")})
    got = near_dedup.near_duplicates(docs)
    assert rows_of(got.drop("class_id")) == sorted(brute.near(rows), key=repr)
    assert near_dedup.drop_near(docs).columns == docs.columns


def test_near_duplicates_in_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TASK_DOCUMENTS", 8)
    rows = near_rows()
    assert rows_of(near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).drop("class_id")) == sorted(brute.near(rows), key=repr)


def boilerplate_rows(seed, families=3):
    """Texts that share about half of their shingles, among them some copies with a few words changed."""
    r = random.Random(seed)
    word = lambda: f"w{r.randint(0, 10**6)}"
    rows = []
    for f in range(families):
        common = [word() for _ in range(120)]
        for _ in range(40):
            own = common + [word() for _ in range(r.randint(60, 120))]
            for _ in range(r.choice((1, 1, 1, 2, 5))):
                copy = list(own)
                for _ in range(r.randint(0, 4)):
                    copy[r.randrange(len(copy))] = word()
                rows.append((len(rows) + 1000 * f, " ".join(copy)))
    return rows


@pytest.mark.parametrize(("documents", "wide"), [(3000, 12), (20, 12), (20, 1), (6, 2)])
def test_near_duplicates_among_boilerplate(spark, monkeypatch, documents, wide):
    monkeypatch.setattr(near_dedup, "TASK_DOCUMENTS", documents)
    monkeypatch.setattr(near_dedup, "WIDE_ROWS", wide)
    rows = boilerplate_rows(documents + wide)
    assert rows_of(near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).drop("class_id")) == sorted(brute.near(rows), key=repr)


def test_large_clusters_lose_no_link_that_shares_no_wide_band(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TASK_DOCUMENTS", 20)
    monkeypatch.setattr(near_dedup, "WIDE_ROWS", 180)  # linked documents that differ share hardly any
    rows = boilerplate_rows(7) + [(5000 + i, t) for i, t in near_rows()]
    assert rows_of(near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).drop("class_id")) == sorted(brute.near(rows), key=repr)


def test_small_tables_of_many_tasks_go_to_few_files(spark, monkeypatch):
    files = {}

    def spy(df, label, real=near_dedup.stored):
        out = real(df, label)
        files[label] = out.inputFiles()
        return out

    monkeypatch.setattr(near_dedup, "stored", spy)
    r = random.Random(6)
    texts = [[f"w{r.randint(0, 10**6)}" for _ in range(60)] for _ in range(60)]
    rows = [(2 * i + j, " ".join(t + ["end"] * j)) for i, t in enumerate(texts) for j in (0, 1)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).drop("class_id")
    assert rows_of(got) == sorted(brute.near(rows), key=repr) and got.where("NOT kept").count() == 60
    assert len(files["forest"]) <= 8
    for path in files["forest"]:  # neither checksum files nor a marker
        assert {x.name[:5] for x in Path(path.removeprefix("file:")).parent.iterdir()} == {"part-"}


def test_prefixes_of_linked_sets_meet_in_any_order():
    rng = np.random.default_rng(4)
    linked = 0
    for n in range(1, 200):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        for least in (50, 85, 99):
            gone = int(rng.integers(0, (100 - least) * n // 100 + 1))
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**63, int(rng.integers(0, n // 20 + 1)), dtype=np.uint64)]))
            frequent = np.unique(rng.choice(np.union1d(a, b), n // 2 + 1))
            counts = rng.integers(1, 9, len(frequent))
            if near_dedup._linked(a, b, least):
                linked += 1
                assert len(np.intersect1d(near_dedup.prefix(a, least, frequent, counts), near_dedup.prefix(b, least, frequent, counts)))
    assert linked > 300


def test_bands_recall_links_of_the_least_similarity():
    rng = np.random.default_rng(3)
    narrow = wide = 0
    pairs = 400
    for _ in range(pairs):
        a = rng.integers(0, 2**63, 600, dtype=np.uint64)
        b = a.copy()
        b[:48] = rng.integers(0, 2**63, 48, dtype=np.uint64)  # 552 of 648 in common: 0.852
        x, y = setsketch.registers(a), setsketch.registers(b)
        narrow += bool((setsketch.bands(x) == setsketch.bands(y)).any())
        wide += bool((setsketch.wide_bands(x, near_dedup.WIDE_ROWS, near_dedup.WIDE_BANDS) == setsketch.wide_bands(y, near_dedup.WIDE_ROWS, near_dedup.WIDE_BANDS)).any())
    assert narrow == pairs and wide >= 0.99 * pairs


def test_near_duplicates_in_long_and_repeated_texts(spark):
    r = random.Random(8)
    long = [f"w{r.randint(0, 10**5)}" for _ in range(40_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:-100])), (3, " ".join(long[:20_000])), (4, "x " * 50_000), (5, "x " * 9), (5, " ".join(long)), (6, None), (6, "")]
    got = sorted((r["doc_id"], min(r["n_shingles"], 2), r["component_id"]) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(1, 2, 1), (2, 2, 1), (3, 2, 3), (4, 1, 4), (5, 1, 4), (5, 2, 1), (6, 0, 6), (6, 0, 6)]


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    got = near_dedup.near_duplicates(spark.createDataFrame([(None, "a b c"), (1, None)], SCHEMA)).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got if r["doc_id"]) == [(1, 1, True)] and len(got) == 2


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**63, 900, dtype=np.uint64) for _ in range(2))
    b[:700] = a[:700]
    ka, kb = setsketch.registers(a), setsketch.registers(b)
    assert (setsketch.merged(ka, kb) == setsketch.registers(np.union1d(a, b))).all()
    assert abs(setsketch.jaccard_many(ka, kb[None], 900, np.array([900]))[0] - 700 / 1100) < 0.15


def test_components(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (5, 4), (9, 3), (4, 4), (7, 9)], "u long, v long")
    assert sorted(tuple(r) for r in components(edges).collect()) == [(2, 1), (3, 1), (5, 4), (7, 1), (9, 1)]


def hashed(symbols):
    return np.array([0x9E3779B97F4A7C15 * (x + 1) % 2**64 for x in symbols], np.uint64)


words3 = st.lists(st.integers(0, 3), max_size=25)


@settings(max_examples=150, deadline=None)
@given(words3, words3, st.lists(st.integers(0, 5), min_size=8, max_size=16), words3, words3)
def test_low_symbols_stand_wherever_their_words_do(before, after, inner, other_before, other_after):
    def within(left, right):
        x = hashed(left + inner + right)
        s, at = recompression.low_symbols(x, np.zeros(len(x), int)), len(left)
        return {(int(n), int(a) - at, int(b) - at, int(lo) - at, int(hi) - at) for n, a, b, lo, hi in zip(s.name, s.start, s.end, s.left, s.right)}

    n = len(inner)
    one, two = within(before, after), within(other_before, other_after)
    assert {s for s in one if s[3] >= 0 and s[4] <= n} == {s for s in two if s[3] >= 0 and s[4] <= n}
    assert sorted(i for _, a, b, _, _ in one for i in range(a, b)) == list(range(-len(before), n + len(after)))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=70), min_size=1, max_size=6))
def test_long_symbols_are_equal_just_for_equal_words(docs):
    x, g = hashed([w for d in docs for w in d]), np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    flat = [w for d in docs for w in d]
    name, doc, start, end = recompression.long_symbols(recompression.low_symbols(x, g), 3, 4, 2)
    meaning = {}
    for n, d, a, b in zip(name.tolist(), doc.tolist(), start.tolist(), end.tolist()):
        assert (g[a:b] == d).all() and meaning.setdefault(n, flat[a:b]) == flat[a:b]
    contents = recompression.contents(x, start, end)
    assert len(set(zip(name.tolist(), contents.tolist()))) == len(set(name.tolist()))
    for i in range(len(docs)):
        for j in range(i):
            if docs[i] == docs[j] and len(docs[i]) >= 3:
                assert name[doc == i].tolist() == name[doc == j].tolist() and (end - start)[doc == i].max() == len(docs[i])


def test_repeats_match_brute_force(spark):
    w = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, w), (4, w), (4, w), (5, "x " * 16), (6, "y " + "x " * 14 + "z"), (7, "x " * 12), (8, "pre " + w[4:60] + " " + w[8:90] + "\x0b\tzz"), (9, "x " * 13), (-3, w[:50]), (10, "é " * 30)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(0) for c in ("part", "keys", "kind", "bucket")})
    assert rows_of(substring_dedup.repeats_report(docs)) == sorted(brute.repeats(rows), key=repr)
    assert substring_dedup.repeats_report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert substring_dedup.repeats_report(spark.createDataFrame([(None, w), (1, w)], SCHEMA)).agg(F.sum("n_removed")).first()[0] == 0




def repeating_rows(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(r.choice([1, 2, 3, 10, 200]))]
    base = [[r.choice(vocabulary) for _ in range(r.randint(0, 120))] for _ in range(4)]
    rows = []
    for _ in range(r.randint(1, 25)):
        words = []
        for x in r.choices(base, k=r.randint(0, 4)):
            a = r.randint(0, len(x))
            words += x[a : r.randint(a, len(x))] + [f"u{r.random()}" for _ in range(r.choice((0, 0, 1, 3)))]
        rows.append((r.randint(-3, 40), " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_repeats_of_random_rows(spark, seed):
    rows = [row for k in range(6) for row in repeating_rows(100 * seed + k)]
    assert rows_of(substring_dedup.repeats_report(spark.createDataFrame(rows, SCHEMA).repartition(5))) == sorted(brute.repeats(rows), key=repr)


def test_repeats_in_long_texts(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BATCH_BYTES", 50_000)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 40_000)
    r = random.Random(1)
    long = [f"w{r.randint(0, 5000)}" for _ in range(60_000)]
    rows = [(1, " ".join(long[:20_000])), (2, " ".join(long)), (3, " ".join(long[5_000:5_040])), (4, "For " * 30_000), (5, "For " * 20_000), (None, " ".join(long))]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.repeats_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (20_000, 0), 2: (60_000, 20_000), 3: (40, 40), 4: (30_000, 0), 5: (20_000, 20_000), None: (60_000, 0)}


def test_windows_of_one_document_are_not_sent():
    words = [f"v{i}" for i in range(400)]
    batch = substring_dedup.Batch([1], [7], [" ".join(words)])
    assert substring_dedup._sent_windows(batch, {}, 13, 4) == []
    _, short, name, check, _, _, _ = batch.symbols(13)
    shared = {1: {0: substring_dedup._low_names(short)}}
    assert sum(len(substring_dedup._owners_of(r[2], True)[2]) // 18 for r in substring_dedup._sent_windows(batch, shared, 13, 4)) == 388
    known = {1: {0: substring_dedup._low_names(short), 1: substring_dedup._entries(name, check)}}
    rows = substring_dedup._sent_windows(batch, known, 13, 4)
    assert [(r[0], np.frombuffer(substring_dedup._owners_of(r[2], True)[2], substring_dedup._SPAN).tolist()) for r in rows] == [(1, [(0, 400)])]
    wrong = {1: known[1] | {1: substring_dedup._entries(name, check ^ np.uint32(1))}}
    assert all(r[0] == 0 for r in substring_dedup._sent_windows(batch, wrong, 13, 4))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é", "\x1f", "字", " ", "\t", "\n", "\x0b", "\x85", " ", "A", "x" * 70]), max_size=60), st.integers(3, 40))
def test_word_hashes_are_those_of_the_words(parts, chunk):
    raw = "".join(parts).encode()
    words.CHUNK_BYTES, kept = chunk, words.CHUNK_BYTES
    try:
        place, one, two = words.hashed_words(raw)
    finally:
        words.CHUNK_BYTES = kept
    split = raw.split()
    assert [raw[i : i + len(w)] for i, w in zip(place.tolist(), split)] == split and len(one) == len(two) == len(split)
    for h in (one, two):
        assert [int(words.hashed_words(w)[1 if h is one else 2][0]) for w in split] == h.tolist() and len(set(h.tolist())) == len(set(split))
    assert words.hashed_words(raw, lower=True)[1].tolist() == words.hashed_words(raw.lower())[1].tolist()
