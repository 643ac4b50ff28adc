"""Near duplicates over five-word shingles: SetSketch registers find candidates, full sets confirm them.

1. Each document becomes a set of shingle hashes and a sketch. Documents with one set are one class, which its
   smallest doc_id stands for; only representatives go on, so copies cost nothing further.
2. Bands of register values bucket the representatives. Each bucket is a star round its least member, and the
   connected parts of these stars are loose clusters: no link can lie across two of them, except one whose
   documents share no band (under 3 in ten million at the least similarity).
3. Bands chain, so what many texts have in common can make one cluster of all of them. A cluster too large for one task is
   clustered anew by wider bands of the same registers, which linked documents mostly share (but for one in ten
   thousand at the least similarity) and others hardly. Links between these finer clusters are found by an exact prefix
   filter over full sets, so that wide bands lose none. Where a finer cluster is still large, it is of near copies: each member
   is confirmed against the one that it shares most bands with, and what is connected then needn't be compared again.
4. A cluster's texts meet in tasks of bounded size: whole if small, else as pairs of blocks, but no pair of blocks whose
   members are all connected. There the joint likelihood estimate drops pairs far from a link, and all others
   are confirmed on full sets unless both ends are already connected. Each task returns a spanning forest of its
   links, never all pairs.
5. Components of the forests are components of all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import setsketch
from siltstone.llm.common import bounded, dealt, filter_of, gathered, may_be_in, shuffle_width, stored, without
from siltstone.llm.components import components
from siltstone.llm.words import hashed_words, runs_of

SHINGLE, LEAST_SIMILARITY = 5, 85
#: Standard errors of an estimate below LEAST_SIMILARITY at which a pair is dropped unconfirmed.
MARGIN = 4.0
#: Documents and shingles of a task of step 3.
TASK_DOCUMENTS, TASK_SHINGLES = 2000, 2_000_000
#: Registers of a wide band and how many of them: at a similarity of 0.85 two documents share none of 64 in about one case of ten thousand.
WIDE_ROWS, WIDE_BANDS = 12, 64
#: Documents whose shingles are counted, and how many frequent shingles are kept, to order shingles for prefixes. Any order gives the same links.
COUNTED_DOCUMENTS, FREQUENT_SHINGLES = 20_000, 100_000
BATCH_ROWS = 512


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word runs of a text; of all its words if they are fewer."""
    h = hashed_words((text or "").encode(), lower=True)[1]
    return np.unique(runs_of(h, k if len(h) >= k else len(h))) if len(h) else h


def sketches(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, set_id (16 bytes that name the set; null when empty), registers (uint16, little-endian) and bands of each row."""
    kind = next(f.dataType.simpleString() for f in docs.schema if f.name == "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 1, BATCH_ROWS):
            sizes, ids, regs, keys = [], [], [], []
            for t in batch.column(1).to_pylist():
                s = shingle_set(t, k)
                sizes.append(len(s))
                ids.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                r = setsketch.registers(s)
                regs.append(r.astype("<u2").tobytes())
                keys.append(setsketch.bands(r) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(regs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "set_id", "registers", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, set_id binary, registers binary, bands array<long>")


def _forest(ids: np.ndarray, texts: list[str], side: np.ndarray, known: np.ndarray, k: int, least: int) -> list[tuple[int, int]]:
    """Spanning links among documents; with two sides only links across them. known: what is connected already has one value."""
    sets = [shingle_set(t, k) for t in texts]
    size = np.array([len(s) for s in sets])
    regs = np.array([setsketch.registers(s) for s in sets])
    up = np.unique(known, return_index=True)[1][np.unique(known, return_inverse=True)[1]] if len(sets) else np.arange(0)

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    split, out, bound = bool(side.any()), [], setsketch.lower_bound(least / 100, MARGIN)
    least_equal = setsketch.REGISTERS * setsketch.lower_bound(least / 100, 2 * MARGIN)  # far too few equal registers need no estimate
    for i in np.argsort(size, kind="stable")[::-1]:
        near = np.flatnonzero((size <= size[i]) & (100 * size >= least * size[i]) & (known != known[i]))
        near = near[(size[near] < size[i]) | (near < i)]
        if split:
            near = near[side[near] != side[i]]
        if not len(near):
            continue
        near = near[(regs[near] == regs[i]).sum(axis=1) >= least_equal]
        j = setsketch.jaccard_many(regs[i], regs[near], size[i], size[near])
        near, j = near[j >= bound], j[j >= bound]
        for o in near[np.argsort(-j, kind="stable")]:
            a, b = root(i), root(o)
            if a != b and _linked(sets[i], sets[o], least):
                up[max(a, b)] = min(a, b)
                out.append((int(ids[i]), int(ids[o])))
    return out


def _linked(a: np.ndarray, b: np.ndarray, least: int) -> bool:
    inter = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * inter >= least * (len(a) + len(b) - inter)


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, least: int = LEAST_SIMILARITY) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept, class_id (smallest doc_id with the same set).

    Links join sets with 100 * intersection >= least * union. A null or empty text, or one of white space, has no set
    and no link. Rows that repeat a doc_id go each with its own set; sets with one smallest doc_id are linked through it.
    Rows with a null doc_id take no part and get a null component, not kept. An empty table gives an empty result. doc_id must be an integer column.
    """
    sk = stored(sketches(docs, shingle), "sketches")
    n = sk.count()
    whole = sk.where("set_id IS NOT NULL AND doc_id IS NOT NULL")
    classes = whole.groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    # Sets of fewer than 6 shingles can't be both different and similar enough at 85 in 100.
    small = least // (100 - least) + 1
    reps = whole.where(F.col("n_shingles") >= small).groupBy("set_id").agg(F.min_by(F.struct("doc_id", "n_shingles", "bands"), "doc_id").alias("r"))
    reps = stored(gathered(reps.select("r.*"), 8 * n), "representatives")  # a row is as wide as several narrow ones
    banded = reps.select("doc_id", F.explode("bands").alias("band"))
    stars = banded.groupBy("band").agg(F.min("doc_id").alias("v"), F.count("*").alias("g")).where("g > 1").drop("g")
    loose = components(banded.join(stars, "band").select(F.col("doc_id").alias("u"), "v"), setsketch.REGISTERS // setsketch.ROWS * n)
    members = loose.unionByName(loose.select(F.col("component").alias("node"), "component").distinct())
    members = stored(gathered(members.join(reps.select(F.col("doc_id").alias("node"), "n_shingles"), "node"), n), "members")
    members, confirmed = _without_giants(docs, sk, members, shingle, least)
    n_members = members.count()
    forest = stored(dealt(_links(docs, members, n_members, shingle, least), n_members), "forest")
    linked = components(forest if confirmed is None else forest.unionByName(confirmed), 2 * n_members)
    # Written, so that adaptive execution can split the join that follows where a set has many rows; rows without a set stay out of it.
    answer = classes.join(linked, classes["rep"] == linked["node"], "left").select("set_id", "rep", F.coalesce("component", "rep").alias("root"))
    answer = stored(gathered(answer, n), "classes")
    flat = sk.select("doc_id", "n_shingles", "set_id")
    alone = flat.where("set_id IS NULL").select("set_id", "doc_id", "n_shingles", F.col("doc_id").alias("rep"), F.col("doc_id").alias("root"))
    out = flat.where("set_id IS NOT NULL").join(answer, "set_id", "left").unionByName(alone)
    root = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", root.alias("component_id"), (F.col("doc_id").isNotNull() & (F.col("doc_id") == root)).alias("kept"), F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("class_id"))


def _sizes(members: DataFrame) -> DataFrame:
    giant = (F.count("*") > TASK_DOCUMENTS) | (F.sum("n_shingles") > TASK_SHINGLES)
    return members.groupBy("component").agg(F.count("*").alias("g"), F.sum("n_shingles").alias("s"), giant.alias("giant"))


def _wide_bands(sk: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component, band): the wide bands of the stored registers of nodes (node, component)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [setsketch.wide_bands(np.frombuffer(r, "<u2"), WIDE_ROWS, WIDE_BANDS) for r in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64()))], ["node", "component", "bands"])

    some = may_be_in(sk.where("set_id IS NOT NULL").select(F.col("doc_id").alias("node"), "registers"), F.col("node"), filter_of(nodes, "node"))
    kind = nodes.schema["node"].dataType.simpleString()
    banded = some.join(nodes, "node").select("node", "component", "registers").mapInArrow(run, f"node {kind}, component {kind}, bands array<long>")
    return banded.select("node", "component", F.explode("bands").alias("band"))


def _frequent(texts: DataFrame, rows: int, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their counts in a sample of texts (doc_id, text) of about so many rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 0, BATCH_ROWS):
            for t in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t, shingle).view(np.int64))], ["token"])

    some = texts.where(F.pmod(F.xxhash64("doc_id", F.lit("count")), F.lit(-(-rows // COUNTED_DOCUMENTS))) == 0)
    counts = some.select("text").mapInArrow(run, "token long").groupBy("token").agg(F.count("*").alias("n")).where("n > 2")
    found = counts.orderBy(F.desc("n"), "token").limit(FREQUENT_SHINGLES).toArrow()
    token, n = (found.column(c).to_numpy() for c in ("token", "n"))
    order = np.argsort(token.view(np.uint64))
    return token.view(np.uint64)[order], n[order]


def prefix(s: np.ndarray, least: int, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set, rare ones first. Two sets that are linked have one of each other's prefixes in common, as a
    link needs least in 100 of the larger set."""
    if not len(s):
        return s
    n = np.zeros(len(s), np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        n = np.where(frequent[at] == s, counts[at], 0)
    return s[np.lexsort((s, n))][: len(s) - (least * len(s) + 99) // 100 + 1]


def _across(docs: DataFrame, parts: DataFrame, rows: int, shingle: int, least: int) -> DataFrame:
    """(u, v): all links between documents of different parts (node, part), by an exact prefix filter. Members of one part
    never meet, so a shingle that only one part has costs nothing beyond its rows."""
    texts = _texts_of(docs, parts)
    frequent, counts = _frequent(texts, rows, shingle)
    kind = parts.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 1, BATCH_ROWS):
            sets = [shingle_set(t, shingle) for t in batch.column(1).to_pylist()]
            first = [prefix(s, least, frequent, counts).view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(first, pa.list_(pa.int64()))], ["doc_id", "n", "first"])

    sets = texts.mapInArrow(run, f"doc_id {kind}, n long, first array<long>")
    index = sets.join(parts.hint("merge"), sets["doc_id"] == parts["node"]).select("node", "part", "n", F.posexplode("first").alias("i", "token"))
    index = stored(gathered(index, 32 * rows), "prefixes")
    held = stored(gathered(index.select("token", "part").distinct(), rows), "prefix-parts")
    shared = held.groupBy("token").agg(F.count("*").alias("g")).where("g > 1").select("token")
    held = stored(gathered(held.join(shared, "token", "left_semi"), rows), "shared-parts")
    x, y = (held.select("token", F.col("part").alias(f"part_{s}")) for s in "xy")
    meets = stored(gathered(x.join(y.hint("merge"), "token").where("part_x < part_y"), rows), "meeting-parts")
    x, y = (index.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("part", "node", "n", "i"))) for s in "xy")
    met = meets.join(x.hint("merge"), ["token", "part_x"])
    near = (100 * F.least("n_x", "n_y") >= least * F.greatest("n_x", "n_y")) & ((100 + least) * F.least(F.col("n_x") - F.col("i_x"), F.col("n_y") - F.col("i_y")) >= least * (F.col("n_x") + F.col("n_y")))
    met = met.join(y.hint("merge"), ["token", "part_y"]).where(near)
    pairs = met.select(F.greatest("node_x", "node_y").alias("node"), F.least("node_x", "node_y").alias("v")).distinct()
    pairs = stored(gathered(pairs, rows), "across-pairs")
    return _confirmed(docs, pairs, pairs.count(), shingle, least)


def _without_giants(docs: DataFrame, sk: DataFrame, members: DataFrame, shingle: int, least: int) -> tuple[DataFrame, DataFrame | None]:
    """members (node, component, n_shingles, known) with large clusters clustered anew, and the links confirmed on the way, if any were large:
    all that lie across the new clusters, and some within those that are still large.
    known: the least node that a node is connected with by these links, the node itself if there is none."""
    plain = members.withColumn("known", F.col("node"))
    giants = _sizes(members).where("giant").select("component")
    if giants.isEmpty():
        return plain, None
    rows = members.count()
    giants = stored(gathered(giants, rows), "giants")
    inside = stored(gathered(members.join(giants, "component", "left_semi"), rows), "giant-members")
    wide = stored(_wide_bands(sk, inside.select("node", "component")), "wide-bands")
    hubs = stored(gathered(wide.groupBy("component", "band").agg(F.min("node").alias("v"), F.count_distinct("node").alias("g")).where("g > 1").drop("g"), WIDE_BANDS * rows), "hubs")
    stars = stored(wide.join(hubs, ["component", "band"]).where("node <> v").groupBy("node", "v").agg(F.count("*").alias("n")).transform(gathered, WIDE_BANDS * rows), "wide-stars")
    fine = components(stars.select(F.col("node").alias("u"), "v"), WIDE_BANDS * rows)
    fine = fine.unionByName(fine.select(F.col("component").alias("node"), "component").distinct())
    fine = stored(gathered(fine.join(inside.select("node", "n_shingles"), "node"), rows), "fine-members")
    rest = members.join(giants, "component", "left_anti").unionByName(fine.select(members.columns))
    parts = inside.select("node").distinct().join(fine.select("node", F.col("component").alias("part")).distinct(), "node", "left")
    parts = stored(gathered(parts.select("node", F.coalesce("part", "node").alias("part")), rows), "parts")
    across = stored(dealt(_across(docs, parts, parts.count(), shingle, least), rows), "across")
    large = _sizes(fine).where("giant").select("component")
    if large.isEmpty():
        return stored(gathered(rest.withColumn("known", F.col("node")), rows), "all-members"), across
    nodes = stored(gathered(fine.join(large, "component", "left_semi").select("node"), rows), "large-nodes")
    best = stars.join(nodes, "node", "left_semi").groupBy("node").agg(F.max_by("v", F.struct("n", -F.col("v"))).alias("v"))
    confirmed = stored(dealt(_confirmed(docs, best, rows, shingle, least), rows), "confirmed")
    known = components(confirmed, rows).select("node", F.col("component").alias("_known"))
    out = rest.join(known, "node", "left").withColumn("known", F.coalesce("_known", "node")).drop("_known")
    return stored(gathered(out, rows), "all-members"), confirmed.unionByName(across)


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """doc_id and text of documents that may be among nodes (node): only these are shuffled."""
    return may_be_in(docs.select("doc_id", "text"), F.col("doc_id"), filter_of(nodes, "node"))


def _confirmed(docs: DataFrame, pairs: DataFrame, n: int, shingle: int, least: int) -> DataFrame:
    """(u, v) of those of pairs (node, v), at most n, that are links. A v with many partners is copied to tasks of bounded size."""
    sizes = pairs.groupBy("v").agg(F.ceil(F.count("*") * 2 / TASK_DOCUMENTS).cast("int").alias("k"))
    spread = pairs.join(sizes, "v").select("v", F.pmod(F.xxhash64("node"), F.col("k")).cast("int").alias("b"), "node")
    hubs = sizes.select("v", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("b"), F.col("v").alias("node"))
    wanted = stored(gathered(spread.unionByName(hubs), 2 * n), "confirm")
    d = _texts_of(docs, wanted)
    rows = d.join(wanted.hint("merge"), d["doc_id"] == wanted["node"]).select("v", "b", "doc_id", "text")

    def run(group: pa.Table) -> pa.Table:
        ids, hub = group.column("doc_id").to_pylist(), group.column("v")[0].as_py()
        sets = [shingle_set(t, shingle) for t in group.column("text").to_pylist()]
        own = [s for i, s in zip(ids, sets) if i == hub]
        found = sorted({i for i, s in zip(ids, sets) if i != hub and any(_linked(s, o, least) for o in own)})
        return pa.table({"u": pa.array(found, pa.int64()), "v": pa.array([hub] * len(found), pa.int64())})

    return rows.repartition(4 * shuffle_width(docs.sparkSession), "v", "b").groupBy("v", "b").applyInArrow(run, "u long, v long")


def _links(docs: DataFrame, members: DataFrame, n_members: int, shingle: int, least: int) -> DataFrame:
    """(u, v) of spanning links within clusters. A cluster too large for one task is dealt into blocks, and pairs of blocks are
    tasks: connected members that fill a block or more have blocks of their own, which are not compared with each other."""
    half = F.lit(TASK_DOCUMENTS / 2)
    sized = members.join(_sizes(members), "component")
    full = F.greatest(F.ceil(F.col("g") / half), F.ceil(F.col("s") * 2 / TASK_SHINGLES))
    own = members.groupBy("component", "known").agg(F.count("*").alias("own"))
    sized = sized.join(own, ["component", "known"]).withColumn("pure", F.col("giant") & (F.col("own") >= half))
    blocks = F.when(F.col("pure"), F.ceil(full * F.col("own") / F.col("g"))).otherwise(full).cast("int")
    spread = F.when(F.col("pure"), F.xxhash64("node")).otherwise(F.xxhash64("known"))
    kind = F.when(F.col("pure"), F.col("known"))
    m = sized.select("component", "node", "known", "giant", kind.alias("kind"), F.when(F.col("giant"), F.pmod(spread, blocks)).otherwise(0).cast("int").alias("b"))
    m = stored(gathered(m, n_members), "blocks")
    tasks = m.where("NOT giant").select("component", F.lit(0).cast("long").alias("task"), F.lit(0).alias("side"), "node", "known")
    if not m.where("giant").isEmpty():
        tasks = tasks.unionByName(_block_pairs(m.where("giant")))
    d = _texts_of(docs, m)
    rows = d.join(tasks.hint("merge"), d["doc_id"] == tasks["node"]).select("component", "task", "doc_id", "side", "known", "text")

    def run(group: pa.Table) -> pa.Table:
        ids, side, known = (group.column(c).to_numpy() for c in ("doc_id", "side", "known"))
        found = _forest(ids, group.column("text").to_pylist(), side, known, shingle, least)
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

    # As many tasks as are asked for: adaptive execution would put them together by bytes, but their work is of pairs.
    return rows.repartition(4 * shuffle_width(docs.sparkSession), "component", "task").groupBy("component", "task").applyInArrow(run, "u long, v long")


def _block_pairs(m: DataFrame) -> DataFrame:
    """(component, task, side, node, known): members once for each pair of blocks that theirs is in."""
    each = m.select("component", "kind", "b").distinct()
    x, y = (each.select("component", F.col("kind").alias(f"k{s}"), F.col("b").alias(s)) for s in "xy")
    order = F.struct(F.col("kx").isNotNull(), F.coalesce("kx", F.lit(0)), "x") <= F.struct(F.col("ky").isNotNull(), F.coalesce("ky", F.lit(0)), "y")
    pairs = x.join(y, "component").where(order & ~(F.col("kx").isNotNull() & F.col("ky").isNotNull() & (F.col("kx") == F.col("ky"))))
    pairs = pairs.withColumn("task", F.monotonically_increasing_id() + 1)
    sides = stored(pairs, "block-pairs")
    same = sides["kx"].eqNullSafe(sides["ky"]) & (F.col("x") == F.col("y"))
    sides = sides.select("component", "task", F.explode(F.when(same, F.array(F.struct(F.col("kx").alias("k"), F.col("x").alias("b"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(F.col("kx").alias("k"), F.col("x").alias("b"), F.lit(0).alias("side")), F.struct(F.col("ky").alias("k"), F.col("y").alias("b"), F.lit(1).alias("side"))))).alias("s"))
    sides = sides.select("component", "task", F.col("s.k").alias("_kind"), F.col("s.b").alias("_b"), F.col("s.side").alias("side"))
    large = m.join(sides.withColumnRenamed("component", "_c"), (F.col("component") == F.col("_c")) & F.col("kind").eqNullSafe(F.col("_kind")) & (F.col("b") == F.col("_b")))
    return large.select("component", "task", "side", "node", "known")


def drop_near(docs: DataFrame) -> DataFrame:
    """docs with one document of each component, the one with the smallest doc_id; rows with a null doc_id stay."""
    gone = near_duplicates(docs).where("doc_id IS NOT NULL AND NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    rows = docs.count()
    gone = stored(gathered(gone, rows), "gone")
    return without(docs, gone, docs["doc_id"] == gone["_gone"], rows)
