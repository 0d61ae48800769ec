"""Near-duplicate documents by ProbMinHash, banding and exact verification.

Every text is a weighted set of five-word shingles. An element of weight w
arrives again and again after exponential waiting times of rate w, each time at
a register picked by hash; a register keeps its earliest arrival. Elements are
followed only until their next arrival comes after the latest register, so a
large set costs little more than one arrival per element. Two texts agree in a
register with probability equal to their probability Jaccard similarity.

Registers are hashed in BANDS bands of ROWS. At 0.8 a pair shares no band with
probability (1 - 0.8**5)**24 = 7e-5, at 0.85 with 8e-7.

Equal texts are one node of the graph. Pairs are not enumerated in a bucket:

1. Every node is compared with the least node of one of its buckets.
2. Where the least node of another of its buckets is in another class, with that.
3. Buckets whose members then are still of several classes are gone through in
   chunks: every two chunks of a bucket meet in one group, which compares their
   texts by products of matrices and returns only links that join classes.

After that every pair of different texts that shares a bucket is verified or in
one class already, so classes are the components of all verified links. Buckets
settled in a step take no part in the next. Comparisons are exact, over whole
texts. Classes are joined as components of stored edges.

Defined cases: a NULL or empty text is a class of its own. Equal texts are one class,
those of signs alone, which have no shingles, by their digest. Rows that share an id need not share a class. The
class id is the least id in the class, NULL ids coming last; one row of a class,
the first by (id, row), is kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm import shingles as sh
from tieout.llm.common import scratch_of, table
from tieout.llm.components import components
from tieout.sources.lakehouse import Scratch

BANDS = 24
ROWS = 5
THRESHOLD = 0.8
ROUNDING = 1e-9  # of sums that are the threshold exactly
CHUNK = 1024
COLUMNS_AT_ONCE = 4096
U = np.uint64

# --- signatures -----------------------------------------------------------------------


def signatures(
    text: np.ndarray, element: np.ndarray, weight: np.ndarray, n_texts: int, m: int
) -> np.ndarray:
    """ProbMinHash of each text: the elements that arrive first at m registers."""
    best = np.full(n_texts * m, np.inf)
    kept = np.zeros(n_texts * m, U)
    alive, arrival = np.arange(len(element)), np.zeros(len(element))
    latest = np.full(n_texts, np.inf)
    turn = 0
    while len(alive):
        turn += 1
        drawn = sh.mix(element[alive] + U(turn * int(sh.GOLDEN) % (1 << 64)))
        uniform = ((drawn >> U(11)).astype(np.float64) + 0.5) * 2.0**-53
        arrival = arrival - np.log(uniform) / weight[alive]
        register = (sh.mix(drawn ^ sh.GOLDEN) % U(m)).astype(np.int64)
        place = text[alive] * m + register
        earlier = np.flatnonzero(arrival < best[place])
        # Of several arrivals at one register, the last written, the earliest, stays.
        earlier = earlier[np.argsort(-arrival[earlier], kind="stable")]
        best[place[earlier]] = arrival[earlier]
        kept[place[earlier]] = element[alive[earlier]]
        touched = np.unique(text[alive])
        latest[touched] = best.reshape(n_texts, m)[touched].max(axis=1)
        going = arrival < latest[text[alive]]
        alive, arrival = alive[going], arrival[going]
    return kept.reshape(n_texts, m)


def band_hashes(kept: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One number per text and band; different bands give different numbers."""
    parts = kept.reshape(len(kept), bands, rows) * (np.arange(rows, dtype=U) * U(2) + sh.GOLDEN | U(1))
    salted = parts.sum(axis=2, dtype=U) + (np.arange(bands, dtype=U) + U(1)) * U(0xC2B2AE3D27D4EB4F)
    return sh.mix(salted).view(np.int64)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of binaries; NULL is empty."""
    texts = texts.fill_null(b"").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[at[0] : at[-1]], at - at[0]


def banded(texts: pa.Array, bands: int, rows: int) -> pa.Array:
    """A list of band hashes per text, NULL for a text without words."""
    data, offsets = raw(texts)
    out = np.zeros((len(texts), bands), np.int64)
    has_words = np.zeros(len(texts), bool)
    for begin, end in sh.batches(offsets):
        at = offsets[begin : end + 1]
        text, element, weight = sh.weighted_shingles(data[at[0] : at[-1]], at - at[0])
        if len(text):
            there, number = np.unique(text, return_inverse=True)
            kept = signatures(number, element, weight, len(there), bands * rows)
            out[begin + there] = band_hashes(kept, bands, rows)
            has_words[begin + there] = True
    ends = np.arange(0, (len(texts) + 1) * bands, bands, dtype=np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(out.reshape(-1)))
    return pa.compute.if_else(pa.array(has_words), lists, pa.scalar(None, lists.type))


# --- verification ---------------------------------------------------------------------


def shingle_sets(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its shingles, sorted, and their weights."""
    data, offsets = raw(texts)
    found = []
    for begin, end in sh.batches(offsets):
        at = offsets[begin : end + 1]
        text, element, weight = sh.weighted_shingles(data[at[0] : at[-1]], at - at[0])
        cut = np.searchsorted(text, np.arange(end - begin + 1))
        found += [(element[s:e], weight[s:e]) for s, e in zip(cut, cut[1:])]
    return found


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Probability Jaccard of each pair of texts."""
    sets = zip(shingle_sets(left), shingle_sets(right))
    return np.array([sh.probability_jaccard(*a, *b) for a, b in sets])


def linked(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are at least as similar as the threshold."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Long texts make large batches; a few pairs at a time are enough.
            for at in range(0, len(batch), 256):
                a, b, left, right = batch.slice(at, 256).columns
                close = similarities(left, right) >= threshold - ROUNDING
                yield pa.RecordBatch.from_arrays(
                    [a.filter(pa.array(close)), b.filter(pa.array(close))], ["a", "b"]
                )

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.mapInArrow(verify, "a bigint, b bigint")


def links_between(texts: pa.Array, roots: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links (i, j) that join the classes of some texts, as few as do so.

    The similarity of i and j is at most the share of i's weight on shingles that
    j has, and the other way round. Products of matrices give these shares, and,
    where no shingle occurs twice in a text, the similarity itself.
    """
    sets = shingle_sets(texts)
    n = len(sets)
    sizes = np.array([len(e) for e, _ in sets])
    text = np.repeat(np.arange(n), sizes)
    element = np.concatenate([e for e, _ in sets])
    share = np.concatenate([w / w.sum() if len(w) else w for _, w in sets])
    single = np.array([(w == 1).all() for _, w in sets])
    _, column, times = np.unique(element, return_inverse=True, return_counts=True)
    # A shingle of one text alone is in no intersection.
    common = np.flatnonzero(times[column] > 1)
    order = common[np.argsort(column[common], kind="stable")]
    _, place = np.unique(column[order], return_inverse=True)
    both, covered = np.zeros((n, n), np.float32), np.zeros((n, n), np.float32)
    for first in range(0, int(place.max(initial=-1)) + 1, COLUMNS_AT_ONCE):
        part = slice(*np.searchsorted(place, [first, first + COLUMNS_AT_ONCE]))
        has = np.zeros((n, COLUMNS_AT_ONCE), np.float32)
        has[text[order[part]], place[part] - first] = 1
        both += has @ has.T
        weight = np.zeros_like(has)
        weight[text[order[part]], place[part] - first] = share[order[part]]
        covered += weight @ has.T
    i, j = np.nonzero(np.minimum(covered, covered.T) >= threshold - 1e-3)
    apart = (i < j) & (roots[i] != roots[j])
    i, j = i[apart], j[apart]
    sure = both[i, j] / (sizes[i] + sizes[j] - both[i, j]) >= threshold - ROUNDING
    plain = single[i] & single[j]
    parent = {r: r for r in roots.tolist()}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y, exact, close in zip(i.tolist(), j.tolist(), plain.tolist(), sure.tolist()):
        a, b = top(int(roots[x])), top(int(roots[y]))
        if a != b and (
            close
            if exact
            else sh.probability_jaccard(*sets[x], *sets[y]) >= threshold - ROUNDING
        ):
            parent[max(a, b)] = min(a, b)
            out.append((x, y))
    return out


def linked_inside(inside: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between classes of (bucket, node, root), all pairs of a bucket considered.

    Members are dealt to chunks by hash, and every two chunks of a bucket meet in
    one group of at most about two chunks, so no group holds a whole bucket. Pairs
    are compared inside the group; only links that join classes leave it.
    """
    sizes = inside.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(CHUNK)).alias("chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    dealt = (
        inside.join(sizes, "bucket")
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
        .select(
            "bucket",
            F.least("chunk", "other").alias("i"),
            F.greatest("chunk", "other").alias("j"),
            "node",
            "root",
        )
        .join(texts, "node")
    )

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        nodes = group["node"].to_numpy()
        roots = group["root"].to_numpy()
        found = links_between(group["text"].combine_chunks(), roots, threshold)
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": nodes[b], "b": nodes[a]})

    return dealt.groupBy("bucket", "i", "j").applyInArrow(compare, "a bigint, b bigint")


# --- on Spark -------------------------------------------------------------------------


def ordered(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def with_roots(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Add the classes of node and center; what has no link is its own class."""
    of_node = roots.select("node", F.col("root").alias("_r"))
    of_center = roots.select(F.col("node").alias("center"), F.col("root").alias("_c"))
    return (
        members.join(of_node, "node", "left")
        .join(of_center, "center", "left")
        .select(
            "bucket",
            "node",
            "center",
            F.coalesce("_r", "node").alias("root"),
            F.coalesce("_c", "center").alias("center_root"),
        )
    )


def links(members: DataFrame, texts: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Components (node, root) of all links between nodes that share a bucket."""
    others = members.where("node <> center")
    first = others.groupBy("node").agg(F.min("center").alias("center"))
    compared = scratch.keep(first.select(*ordered("node", "center")), "compared")
    edges = scratch.keep(linked(compared, texts, threshold), "linked")
    roots = components(edges, scratch)

    def stars() -> DataFrame:
        return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))

    # Step 2: other centers, of classes that are still apart.
    apart = with_roots(members, roots).where("root <> center_root")
    more = apart.select(*ordered("node", "center")).distinct()
    more = scratch.keep(more.join(compared, ["a", "b"], "left_anti"), "compared")
    if not more.isEmpty():
        compared = compared.unionByName(more)
        edges = scratch.keep(linked(more, texts, threshold), "linked")
        roots = components(stars().unionByName(edges), scratch)

    # Step 3: buckets whose members are still of several classes.
    known = with_roots(members, roots)
    unsettled = scratch.keep(
        known.where("root <> center_root").select("bucket").distinct(), "unsettled"
    )
    if unsettled.isEmpty():
        return roots
    inside = scratch.keep(known.join(unsettled, "bucket").select("bucket", "node", "root"), "inside")
    edges = scratch.keep(linked_inside(inside, texts, threshold), "linked")
    return components(stars().unionByName(edges), scratch)


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Every row of `docs` as `row`, with class_id and whether it is the one kept."""
    scratch = scratch_of(docs.sparkSession)

    def sign(texts: pa.Array) -> pa.Array:
        return banded(texts, bands, rows)

    text = F.col(text_col).cast("binary")
    signed = scratch.keep(
        docs.select(
            F.monotonically_increasing_id().alias("node"),
            F.struct("*").alias("row"),
            F.when(F.octet_length(text) > 0, F.md5(text)).alias("same"),
            F.arrow_udf(sign, "array<bigint>")(text).alias("bands"),
        ),
        "signed",
    )
    worded = signed.where("bands IS NOT NULL")
    # Of equal texts the first row stands for all.
    doc_id = F.col(f"row.{id_col}")
    order = F.struct(doc_id.isNull().alias("last"), doc_id.alias("id"), F.col("node"))
    texts = scratch.keep(
        signed.where("same IS NOT NULL").groupBy("same").agg(F.min("node").alias("node"), F.min(order).alias("first")), "texts"
    )
    nodes = worded.select("node", "bands").join(texts.select("node"), "node")
    in_bands = scratch.keep(nodes.select("node", F.explode("bands").alias("bucket")), "bands")
    buckets = (
        in_bands.groupBy("bucket")
        .agg(F.min("node").alias("center"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    members = scratch.keep(in_bands.join(buckets, "bucket"), "members")
    by_node = signed.select("node", F.col(f"row.{text_col}").cast("binary").alias("text"))
    roots = links(members, by_node, threshold, scratch)

    rooted = texts.join(roots, "node", "left").select(
        "same", "first", F.coalesce("root", "node").alias("root")
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("class_first"))
    by_text = scratch.keep(
        rooted.join(firsts, "root").select(
            "same",
            F.col("class_first.id").alias("class_id"),
            F.col("class_first.node").alias("kept_node"),
        ),
        "classes",
    )
    found = signed.select("node", "row", "same")
    return found.join(by_text, "same", "left").select(
        "row",
        F.when(F.col("kept_node").isNull(), doc_id).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("kept_node") == F.col("node"), F.lit(True)).alias("kept"),
    )


def without_copies(docs: DataFrame, **settings) -> DataFrame:
    """One document of each class."""
    return classes(docs, **settings).where("kept").select("row.*")


def op10_near_duplicates(spark, sf_dir):
    """The class of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classes(docs).select(F.col("row.doc_id").alias("doc_id"), "class_id", "kept")
