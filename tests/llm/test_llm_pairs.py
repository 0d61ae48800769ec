"""Near-duplicate texts and vectors, components, and the pipeline."""

from __future__ import annotations

import contextlib
import itertools
import os
import random
import re
import threading
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tieout.llm import components, cover_tree, embedding_dup, near_dup, queries, tokens
from tieout.llm import shingles as sh
from tieout.llm.common import scratch_of
from tieout.sources.lakehouse import FREES_SHUFFLES, Scratch

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def classes_of(nodes, pairs):
    """Least node of each component."""
    parent = {n: n for n in nodes}
    for a, b in pairs:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {n: find(parent, n) for n in nodes}


def test_components_against_union_find(spark, scratch):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(90)] + [(7, 7)]
    got = components.components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()
    nodes = {n for e in edges for n in e}
    wanted = {n: r for n, r in classes_of(nodes, edges).items() if n != r}
    assert {r["node"]: r["root"] for r in got} == wanted and len(got) == len(wanted)
    assert components.components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0


# --- texts ----------------------------------------------------------------------------


def shingle_counts(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def slow_similarity(a, b):
    union = a.keys() | b.keys()
    return sum(
        1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in union) for i in a.keys() & b.keys()
    )


def test_similarity_against_the_definition():
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdé", k=rng.randrange(12))) + rng.choice(["", "!", " X"]) for _ in range(120)]
    left, right = texts[:60], texts[60:]
    got = near_dup.similarities(*(pa.array([t.encode() for t in side]) for side in (left, right)))
    for a, b, value in zip(left, right, got):
        assert value == pytest.approx(slow_similarity(shingle_counts(a), shingle_counts(b)))


def test_pieces_do_not_change_shingles(monkeypatch):
    data = np.frombuffer(("word " * 50 + "é" * 300 + " end of it all now").encode(), np.uint8)
    offsets = np.array([0, 20, 20, 100, len(data)])
    whole = sh.weighted_shingles(data, offsets)
    monkeypatch.setattr(sh, "BYTES_AT_ONCE", 16)
    for a, b in zip(whole, sh.weighted_shingles(data, offsets)):
        assert (a == b).all()


def test_registers_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(6)
    element = rng.integers(0, 2**63, 60, dtype=np.uint64)
    a, wa = element[:45], rng.integers(1, 5, 45).astype(float)
    b, wb = element[10:], rng.integers(1, 5, 50).astype(float)
    m = 4096
    kept = near_dup.signatures(
        np.repeat([0, 1], [45, 50]), np.concatenate([a, b]), np.concatenate([wa, wb]), 2, m
    )
    order_a, order_b = np.argsort(a), np.argsort(b)
    exact = sh.probability_jaccard(a[order_a], wa[order_a], b[order_b], wb[order_b])
    assert (kept[0] == kept[1]).mean() == pytest.approx(exact, abs=4 * (exact * (1 - exact) / m) ** 0.5)


def near_copies(rng, n_words, copies, edits):
    words = [f"w{rng.randrange(10**6)}" for _ in range(n_words)]
    for _ in range(copies):
        own = list(words)
        for _ in range(edits):
            own[rng.randrange(n_words)] = f"e{rng.randrange(10**6)}"
        yield " ".join(own)


def brute_classes(rows):
    sets = [shingle_counts(t) for _, t in rows]
    pairs = [
        (i, j)
        for i, j in itertools.combinations(range(len(rows)), 2)
        if sets[i] and sets[j] and (rows[i][1] == rows[j][1] or slow_similarity(sets[i], sets[j]) >= 0.8)
    ]
    ids = {}
    for i, root in classes_of(range(len(rows)), pairs).items():
        ids.setdefault(root, []).append(rows[i][0])
    roots = classes_of(range(len(rows)), pairs)
    return [min(ids[roots[i]]) if sets[i] else rows[i][0] for i in range(len(rows))]


def test_classes_against_brute_force(spark):
    rng = random.Random(8)
    texts = [t for _ in range(6) for t in near_copies(rng, 60, 5, rng.randrange(3))]
    texts += list(near_copies(rng, 150, 40, 4)) + ["Short one", "short; ONE", "short two", "a b c d"]
    texts += [t for t in near_copies(rng, 30, 1, 0) for _ in range(4)] + ["", "", "...", "long " * 30_000]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, DOCS).withColumn("class_id", F.lit("mine")).withColumn("node", F.lit(0))
    got = near_dup.classes(docs).select("row.doc_id", "row.text", "class_id", "kept").collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["class_id"] for r in got} == dict(enumerate(brute_classes(rows)))
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)
    kept = near_dup.without_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len({r["class_id"] for r in got})


def test_repeated_ids_nulls_and_nothing(spark):
    text = " ".join(map(str, range(50)))
    rows = [(3, text), (3, text), (None, text), (3, "other " * 20), (None, None), (4, "")]
    docs = spark.createDataFrame(rows, DOCS)
    got = near_dup.classes(docs).select("row.doc_id", "row.text", "class_id", "kept").collect()
    assert Counter((r["class_id"], r["kept"]) for r in got if r["text"] == text) == {(3, True): 1, (3, False): 2}
    assert all(r["kept"] and r["class_id"] == r["doc_id"] for r in got if not r["text"])
    assert near_dup.classes(docs.limit(0)).count() == 0


def test_equal_texts_of_signs_are_one_class(spark):
    rows = [(1, "*** --- ***"), (2, "*** --- ***"), (3, "*** -- ***"), (4, " "), (5, " "), (6, "")]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: (r.class_id, r.kept) for r in near_dup.classes(docs).select("row.doc_id", "class_id", "kept").collect()}
    assert got == {
        1: (1, True), 2: (1, False), 3: (3, True), 4: (4, True), 5: (4, False), 6: (6, True),
    }


def test_a_link_that_misses_the_center_is_found(spark, scratch):
    """In one bucket, a chain whose far end is not like the least node."""
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[k : k + 140]) for k in (0, 12, 24, 36, 48)]
    rows = list(enumerate(texts))
    members = spark.createDataFrame([(1, i, 0) for i in range(5)], "bucket long, node long, center long")
    by_node = spark.createDataFrame([(i, t.encode()) for i, t in rows], "node long, text binary")
    roots = near_dup.links(members, by_node, 0.8, scratch).collect()
    assert {r["node"]: r["root"] for r in roots} == {1: 0, 2: 0, 3: 0, 4: 0}


@pytest.mark.parametrize("chunk", [7, 1024])
def test_borderline_bucket_in_chunks(spark, scratch, monkeypatch, chunk):
    """Copies about as similar as the threshold, some with repeated shingles."""
    monkeypatch.setattr(near_dup, "CHUNK", chunk)
    monkeypatch.setattr(near_dup, "COLUMNS_AT_ONCE", 64)
    rng = random.Random(chunk)
    texts = list(near_copies(rng, 90, 45, 1)) + list(near_copies(rng, 120, 10, 1)) + ["apart " * 9]
    texts = [t + " " + " ".join(t.split()[:12]) if i % 5 == 0 else t for i, t in enumerate(texts)]
    sets = [shingle_counts(t) for t in texts]
    pairs = [
        (i, j)
        for i, j in itertools.combinations(range(len(texts)), 2)
        if slow_similarity(sets[i], sets[j]) >= 0.8 - near_dup.ROUNDING
    ]
    members = spark.createDataFrame([(1, i, 0) for i in range(len(texts))], "bucket long, node long, center long")
    by_node = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "node long, text binary")
    got = {r["node"]: r["root"] for r in near_dup.links(members, by_node, 0.8, scratch).collect()}
    wanted = classes_of(range(len(texts)), pairs)
    assert {i: got.get(i, i) for i in range(len(texts))} == wanted
    assert 1 < len(set(wanted.values())) < len(texts)


def test_all_documents_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op10_near_duplicates"](spark, SF).collect()
    wanted = dict(zip([r["doc_id"] for r in rows], brute_classes([tuple(r) for r in rows])))
    assert {r["doc_id"]: r["class_id"] for r in got} == wanted


# --- vectors --------------------------------------------------------------------------


def brute_links(vectors, cosine=0.95):
    usable = {}
    for i, v in enumerate(vectors):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[i] = embedding_dup.unit(np.array([v], np.float64))[0]
    pairs = [
        (i, j)
        for i, j in itertools.combinations(usable, 2)
        if len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= cosine
    ]
    counts = Counter(n for p in pairs for n in p)
    return counts, classes_of(range(len(vectors)), pairs)


def clustered(rng, n, dim, noise):
    base = rng.normal(size=(6, dim))
    near = base[rng.integers(0, 6, n)] + noise * rng.normal(size=(n, dim))
    return np.concatenate([near, rng.normal(size=(20, dim))]).astype(np.float32)


@pytest.mark.parametrize("dim, noise, block", [(3, 0.1, 64), (16, 0.1, 40), (64, 0.02, 4096)])
def test_links_against_brute_force(spark, dim, noise, block):
    rng = np.random.default_rng(dim)
    vectors = [list(map(float, v)) for v in clustered(rng, 150, dim, noise)]
    vectors += [vectors[0]] * 5 + [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] * dim]
    vectors += [[float("inf")] * dim, vectors[3][:2], vectors[3][:2], [x * 1e-30 for x in vectors[4]]]
    vectors = [None if v is None else [None if x is None else float(np.float32(x)) for x in v] for v in vectors]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    got = embedding_dup.linked_vectors(df.withColumn("node", F.lit(1)), block=block).collect()
    counts, roots = brute_links(vectors)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {
        i: (counts[i], roots[i]) for i in range(len(vectors))
    }


def test_vectors_of_doubles_repeated_ids_and_none(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 1e-9]), (None, [1.0, 0.0]), (2, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, embedding_dup.linked_vectors(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (2, 0, 2)], key=str)
    assert embedding_dup.linked_vectors(df.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>")
    assert tuple(embedding_dup.linked_vectors(nothing).first()) == (1, 0, 1)


@pytest.mark.parametrize("block", [64, 512])
def test_blocks_far_apart_are_not_visited(spark, scratch, block):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 32))
    vectors = np.repeat(base, 20, axis=0) + 0.02 * rng.normal(size=(8000, 32))
    rows = [(i, 1, v.tolist(), "32") for i, v in enumerate(vectors[rng.permutation(8000)])]
    nodes = scratch.keep(spark.createDataFrame(rows, embedding_dup.NODE), "nodes")
    celled = embedding_dup.in_blocks(nodes, block, scratch)
    assert celled.count() == 8000
    assert celled.groupBy("cell").count().agg({"count": "max"}).first()[0] <= block
    trees = scratch.keep(embedding_dup.grown(celled, "f8"), "trees")
    cells = embedding_dup.upper_cells(trees.select("cell", "center", "reach"), scratch)
    pairs = embedding_dup.block_pairs(cells, 0.95, scratch)
    near = embedding_dup.with_near_spots(pairs, trees, 0.95).collect()
    n = trees.count()
    assert n >= 8000 / block and len({tuple(p) for p in near}) == len(near)
    assert len(near) - n < 0.1 * n * (n - 1) / 2
    assert {p.left for p in near if p.left == p.right} == {r.cell for r in trees.select("cell").collect()}


def test_many_lengths_take_the_jobs_of_one(spark):
    """Vectors of 60 lengths and one place only, which pivots cannot split."""
    rows = [(i, [1.0] * (1 + i % 60)) for i in range(240)] + [(1000 + i, [2.0 + i, 2.0 + i]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for own in (df.where("size(embedding) = 2"), df):
        spark.sparkContext.setJobGroup(f"lengths {len(jobs)}", "")
        got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dup.linked_vectors(own, block=50).collect()}
        jobs.append(len(tracker.getJobIdsForGroup(f"lengths {len(jobs)}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 10
    assert got[1000] == (303, 1) and got[0] == (3, 0) and got[59] == (3, 59)


def without_structure(rng, n, dim):
    """Unrelated directions, a few of them doubled nearly or exactly."""
    vectors = rng.normal(size=(n, dim))
    vectors[: n // 20] = vectors[n // 2 : n // 2 + n // 20] + 0.1 * rng.normal(size=(n // 20, dim))
    vectors[n // 20 : n // 10] = vectors[n // 20]
    return vectors[rng.permutation(n)].astype(np.float32)


class Disk(threading.Thread):
    """The most bytes of shuffle files and tables there were at a time, beyond those at its start."""

    def __init__(self, spark):
        super().__init__(daemon=True)
        local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        self.folders = [spark.conf.get("spark.checkpoint.dir"), *[f.getPath() for f in local]]
        self.start_bytes, self.most, self.ended = self.used(), 0, threading.Event()

    def used(self):
        total = 0
        for top in self.folders:
            for folder, _, names in os.walk(top):
                for name in names:
                    with contextlib.suppress(OSError):
                        total += os.path.getsize(f"{folder}/{name}")
        return total

    def run(self):
        while not self.ended.wait(0.05):
            self.most = max(self.most, self.used() - self.start_bytes)

    def __enter__(self):
        self.start()
        return self

    def __exit__(self, *_):
        self.ended.set()
        self.join()
        self.most = max(self.most, self.used() - self.start_bytes)


def test_disk_for_vectors_without_structure(spark, tmp_path):
    """Every block is near every other, but none is written once per partner."""
    vectors = without_structure(np.random.default_rng(3), 16_000, 64)
    rows = pa.table({"vec_id": np.arange(len(vectors)), "embedding": list(vectors)})
    pq.write_table(rows, tmp_path / "embeddings.parquet")
    df = spark.read.parquet(str(tmp_path / "embeddings.parquet"))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "256k")  # as for larger tables
    try:
        with Disk(spark) as disk:
            got = embedding_dup.linked_vectors(df, block=512).collect()
    finally:
        spark.conf.set(limit, before)
    assert disk.most <= 4 * os.path.getsize(tmp_path / "embeddings.parquet") + 6_000_000
    points = embedding_dup.unit(vectors)
    counts = [int((points[at] @ points.T >= 0.95).sum()) - 1 for at in range(len(points))]
    assert [r["n_links"] for r in sorted(got)] == counts
    assert max(counts) >= 799


def test_packs_of_several_lengths_against_brute_force(spark):
    rng = np.random.default_rng(8)
    vectors = [v.tolist() for dim in (16, 24, 40) for v in without_structure(rng, 300, dim)]
    vectors = [vectors[i] for i in rng.permutation(len(vectors))]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    got = embedding_dup.linked_vectors(df, block=16).collect()
    counts, roots = brute_links(vectors)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {
        i: (counts[i], roots[i]) for i in range(len(vectors))
    }


def test_packs_and_joins_find_the_same_links(spark, scratch):
    vectors = without_structure(np.random.default_rng(9), 600, 48)
    rows = [(i, 1 + i % 3, v.tolist(), "48") for i, v in enumerate(vectors)]
    nodes = scratch.keep(spark.createDataFrame(rows, embedding_dup.NODE), "nodes")
    trees = scratch.keep(embedding_dup.grown(embedding_dup.in_blocks(nodes, 64, scratch), "f4"), "trees")
    cells = embedding_dup.upper_cells(trees.select("cell", "center", "reach"), scratch)
    joined = embedding_dup.visited(embedding_dup.block_pairs(cells, 0.95, scratch), trees, 0.95)
    packs = scratch.keep(embedding_dup.in_packs(trees, 50_000, 4), "packs")
    assert packs.count() > 4
    sums = [
        sorted(map(tuple, edges.groupBy("node").agg({"links": "sum"}).collect()))
        for edges in (joined, embedding_dup.visited_in_packs(packs, 0.95))
    ]
    assert sums[0] == sums[1] and len(sums[0]) >= 60


@pytest.mark.parametrize("dim, n, noise", [(64, 1500, 0.1), (200, 900, 0.03), (8, 700, 0.4), (24, 1300, 0.02)])
def test_leaves_are_compared_exactly(dim, n, noise):
    """Leaves sorted along a direction, sketches of all kinds, tiles with many links and few."""
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(n // 3, dim))
    near = (base[rng.integers(0, len(base), n)] + noise * rng.normal(size=(n, dim))).astype(np.float32)
    points = embedding_dup.unit(near)
    a, b = cover_tree.build(points[: n // 2]), cover_tree.build(points[n // 2 :])
    weights = rng.integers(1, 4, n + 5).astype(float)
    links = cover_tree.Links(weights)
    cover_tree.close_pairs(a, b, False, 0.95, links, 5 + len(a.points), 5)
    close = a.points @ b.points.T >= 0.95
    own, others = weights[5 : 5 + len(a.points)], weights[5 + len(a.points) :]
    assert close.any()
    assert (links.linked == np.concatenate([np.zeros(5), close @ others, own @ close])).all()


def test_scratch_tables_and_shuffle_files_go(spark, tmp_path):
    scratch = Scratch(spark, str(tmp_path / "scratch"), frees_shuffles=True)
    with Disk(spark) as disk:
        drawn = spark.range(200_000).select((F.rand(1) * 1e6).cast("int").alias("k"))
        stored = scratch.keep(drawn.groupBy("k").count().repartition(4, "count"), "counts")
    assert disk.used() - disk.start_bytes < 100_000
    assert spark.conf.get(FREES_SHUFFLES, None) in (None, "false") and stored.count() > 1
    scratch.drop(stored)
    assert os.listdir(tmp_path / "scratch") == []


@pytest.mark.parametrize("dim, n, noise", [(2, 300, 0.01), (3, 400, 0.05), (8, 700, 0.1), (64, 900, 0.03)])
def test_trees_cover_and_traverse_exactly(dim, n, noise):
    rng = np.random.default_rng(n)
    points = embedding_dup.unit(clustered(rng, n, dim, noise))
    weights = rng.integers(1, 4, len(points)).astype(float)
    tree = cover_tree.build(points)
    for node, below in enumerate(tree.children):
        own = tree.points[tree.begin[node] : tree.end[node]]
        assert (cover_tree.distances(tree.center[node], own) <= tree.reach[node] + 1e-9).all()
        assert not below or [tree.begin[below[0]], tree.end[below[-1]]] == [tree.begin[node], tree.end[node]]
    links = cover_tree.Links(weights[tree.order])
    cover_tree.close_pairs(tree, tree, True, 0.95, links, 0)
    close = tree.points @ tree.points.T >= 0.95
    np.fill_diagonal(close, False)
    assert (links.linked == close @ weights[tree.order]).all()
    pairs = [(i, j) for i, j in zip(*np.nonzero(close)) if i < j]
    assert links.settle().tolist() == [r for _, r in sorted(classes_of(range(len(points)), pairs).items())]


# --- pipeline -------------------------------------------------------------------------


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    scratch = scratch_of(spark)
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.keep(stage(spark, docs, SF), name)
        counts.append(docs.count())
        if name != "token_output":
            assert docs.columns == columns
    assert before >= counts[0] >= counts[1] >= counts[2] > 0 and counts[3] == counts[4]
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert got == sorted(map(tuple, docs.collect()))


def test_stages_of_nothing(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_registered_queries_cover_the_ten_operators():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 11)) and tokens.tokenizer_file()
