"""Ranked lexical search: the highest-scoring documents of every query, by norm buckets.

A document is the vector of its impacts, whole numbers that depend on how often a term
occurs and how long the document is; a query is the vector of its terms' weights, each as
often as it occurs. Their inner product is the score. As in LEMP, vectors are ordered
by length and cut into buckets, and a query goes through the buckets from long to short:

1. By Cauchy and Schwarz no vector of a bucket scores above |query| * longest. If that is
   below the query's tenth-best score so far, the bucket is skipped.
2. Inside, coordinates are read by descending weight of the query until what is left of it
   cannot lift a vector not met yet to that score. Of those met, one stays
   if the part read, plus the least bound for the rest, reaches it: lengths without the
   coordinates read, or the largest impact of each coordinate left.
3. Survivors are scored over all coordinates, in 64-bit integers.

Lengths count only terms that some query has: other terms add nothing to a score. Buckets
go by blocks of queries in groups of buckets (see `grid`); each query's best of every
group are merged by one ranking, of which Spark keeps K rows a task.

Texts are cut into terms where they are read. A bit map of 2**BITS places, which does not
grow with the queries, drops most terms that no query has; the join with the queries'
terms, which decides, moves what is left. Documents, not their texts, are shuffled then.

Defined cases: a NULL or empty text has no terms, so such a document is not returned and
such a query has no result; both count in no statistic. Rows that share an id stay apart,
queries and documents alike, and NULL ids of documents come last among equal scores, then
the order of rows decides. Document ids are cast to BIGINT; query ids may be of any
type. A very long text is a longer vector, and one query or document is one row. Other
columns are not read, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieout.llm import grid
from tieout.llm.common import one_row, scratch_of, table

K = 10
BUCKET = 4096
QUERIES = 4096
BITS = 20
TEXTS_AT_ONCE = 512
WORD_BITS = 6
ROUNDING = 1e-9
# Fixed values of the score.
WEIGHT, SCALE, PER_TF, PER_LENGTH = 1000, 1_000_000_000, 1000, 8
LEAST_LENGTH, LENGTH_SHARE = 25, 75
# On UTF-8 bytes: ASCII letters and digits, and all code points from U+0080.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms_of(text: bytes | None) -> list[bytes]:
    # bytes.lower() changes A-Z and nothing else.
    return TERM.findall(text.lower()) if text else []


def counted(rows: DataFrame, keys: list[str], known: np.ndarray | None) -> DataFrame:
    """keys, n (number of terms) and the different terms with their counts.

    Of the terms, those whose place in the bit map `known` is empty are left out.
    """
    shared = rows.sparkSession.sparkContext.broadcast(known) if known is not None else None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value.tobytes() if shared is not None else None
        mask = len(places) - 1 if places is not None else 0
        # Some texts at a time: their terms are many Python objects.
        for batch in (b.slice(at, TEXTS_AT_ONCE) for b in batches for at in range(0, len(b), TEXTS_AT_ONCE)):
            sizes, ends, terms, tfs = [], [0], [], []
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                sizes.append(len(words))
                found = Counter(words).items()
                if places is not None:
                    found = [(t, n) for t, n in found if places[zlib.crc32(t) & mask]]
                terms += [t for t, _ in found]
                tfs += [n for _, n in found]
                ends.append(len(terms))
            pairs = pa.StructArray.from_arrays(
                [pa.array(terms, pa.binary()), pa.array(tfs, pa.int64())],
                ["term", "tf"],
            )
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keys], pa.array(sizes, pa.int64()), lists],
                [*keys, "n", "terms"],
            )

    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    declared = ", ".join(f"{k} {types[k]}" for k in keys)
    return rows.select(*keys, "text").mapInArrow(
        count, f"{declared}, n bigint, terms array<struct<term: binary, tf: bigint>>"
    )


def places_of(vocabulary: DataFrame, bits: int = BITS) -> np.ndarray:
    """A byte per place, 1 where a term of the vocabulary falls. Its size is 2**bits."""
    place = F.crc32("term").bitwiseAND((1 << bits) - 1)
    word, bit = F.shiftright(place, WORD_BITS), place.bitwiseAND((1 << WORD_BITS) - 1).cast("int")
    # At most 2**(bits - WORD_BITS) rows, however large the vocabulary.
    words = (
        vocabulary.select(word.alias("word"), bit.alias("bit"))
        .groupBy("word")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
        .collect()
    )
    held = np.zeros(1 << (bits - WORD_BITS), np.int64)
    for row in words:
        held[row["word"]] = row["bits"]
    return np.unpackbits(held.view(np.uint8), bitorder="little")


def length(documents: int, words: int) -> Column:
    """m of a document of n terms, in a corpus of so many documents with so many terms."""
    share = F.expr(f"({LENGTH_SHARE} * n * {documents}L) div {max(words, 1)}L")
    return F.lit(LEAST_LENGTH) + share


def impact() -> Column:
    """Of a term that occurs tf times in a document of length m."""
    return F.expr(f"({SCALE}L * tf) div ({PER_TF} * tf + {PER_LENGTH} * m)")


# --- a block of queries and a bucket of documents --------------------------------------


def query_block(rows: pa.Table) -> pa.Table:
    """Queries of (item, terms, weights, part): their coordinates by descending weight."""
    items = rows["item"].to_numpy()
    terms, weights, ends = [], [], [0]
    for term, weight in zip(rows["terms"].to_pylist(), rows["weights"].to_pylist()):
        term, weight = np.array(term, np.int64), np.array(weight, np.int64)
        order = np.lexsort((term, -weight))
        terms.append(term[order])
        weights.append(weight[order])
        ends.append(ends[-1] + len(term))
    blob = grid.packed(
        items=items, ends=np.array(ends), terms=np.concatenate(terms), weights=np.concatenate(weights)
    )
    return pa.table({"part": rows["part"].slice(0, 1), "blob": pa.array([blob], pa.binary())})


def bucket(rows: pa.Table) -> tuple[bytes, float, dict]:
    """Documents of (row, doc_id, norm, terms, impacts), laid out by coordinate."""
    lists = rows["terms"].combine_chunks()
    terms = lists.flatten().to_numpy(zero_copy_only=False)
    impacts = rows["impacts"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    document = np.repeat(np.arange(len(rows), dtype=np.int32), lengths)
    order = np.argsort(terms, kind="stable")
    coordinates, starts = np.unique(terms[order], return_index=True)
    largest = np.maximum.reduceat(impacts[order], starts) if len(starts) else impacts
    norms = rows["norm"].to_numpy()
    ids = rows["doc_id"]
    blob = grid.packed(
        rows=rows["row"].to_numpy(),
        doc_ids=ids.fill_null(0).to_numpy(),
        no_id=ids.is_null().to_numpy(),
        norms=norms,
        coordinates=coordinates,
        ends=np.append(starts, len(terms)),
        largest=largest,
        documents=document[order],
        impacts=impacts[order].astype(np.int32),
    )
    return blob, -float(norms.max()), {}


class Searching:
    """A block of queries and the best documents that each has met."""

    def __init__(self, content: dict, k: int):
        self.k = k
        self.items, self.ends = content["items"], content["ends"]
        self.terms, self.weights = content["terms"], content["weights"]
        # Per query (-score, no id, id, row), the best first.
        self.best: list[list[tuple]] = [[] for _ in self.items]

    def go_by(self, bucket: dict) -> None:
        if len(bucket["coordinates"]):
            for query in range(len(self.items)):
                self.search(query, bucket)

    def search(self, query: int, bucket: dict) -> None:
        own = slice(self.ends[query], self.ends[query + 1])
        place = np.searchsorted(bucket["coordinates"], self.terms[own])
        place = np.minimum(place, len(bucket["coordinates"]) - 1)
        there = bucket["coordinates"][place] == self.terms[own]
        place, weights = place[there], self.weights[own][there]
        if not len(place):
            return
        best = self.best[query]
        least = -best[-1][0] if len(best) == self.k else 1
        norms = bucket["norms"]
        # Of the coordinates from each one on: length, and what the largest impacts give.
        squares = np.square(weights.astype(np.float64))
        tail = np.sqrt(np.append(np.cumsum(squares[::-1])[::-1], 0.0)) * (1 + ROUNDING)
        most = np.append(np.cumsum((weights * bucket["largest"][place])[::-1])[::-1], 0)
        reach = np.minimum(tail * norms.max(), most)
        if reach[0] < least:
            return
        # Coordinates to read until an unmet vector is out of reach.
        read = int(np.count_nonzero(reach >= least))
        score = np.zeros(len(norms), np.int64)
        whole = read >= len(place)
        covered = None if whole else np.zeros(len(norms))
        ends, documents, impacts = bucket["ends"], bucket["documents"], bucket["impacts"]
        for p, weight in zip(place[:read].tolist(), weights[:read].tolist()):
            at = slice(ends[p], ends[p + 1])
            met, values = documents[at], impacts[at].astype(np.int64)
            score[met] += weight * values
            if not whole:
                covered[met] += np.square(values.astype(np.float64))
        met = np.flatnonzero(score)
        if not whole:
            rest = np.sqrt(np.maximum(np.square(norms[met]) * (1 + ROUNDING) - covered[met], 0.0))
            bound = score[met] + np.minimum(tail[read] * rest, most[read])
            met = met[bound >= least]
            for p, weight in zip(place[read:].tolist(), weights[read:].tolist()):
                at = slice(ends[p], ends[p + 1])
                found = np.searchsorted(documents[at], met)
                found = np.minimum(found, ends[p + 1] - ends[p] - 1)
                has = documents[at][found] == met
                score[met[has]] += weight * impacts[at][found[has]].astype(np.int64)
        met = met[score[met] >= least]
        if len(met):
            keys = (bucket["rows"][met], bucket["doc_ids"][met], bucket["no_id"][met], -score[met])
            first = np.lexsort(keys)[: self.k]
            new = zip(*(key[first].tolist() for key in reversed(keys)))
            self.best[query] = sorted([*best, *new])[: self.k]

    def found(self) -> pa.RecordBatch | None:
        rows = [
            (item, None if no_id else doc_id, row, -minus)
            for item, best in zip(self.items.tolist(), self.best)
            for minus, no_id, doc_id, row in best
        ]
        if not rows:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*rows)], ["item", "doc_id", "row", "score"]
        )


# --- on Spark -------------------------------------------------------------------------


def best_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = K,
    bucket_size: int = BUCKET,
    queries: int = QUERIES,
    group: int = grid.GROUP,
    bits: int = BITS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each row of `items`."""
    scratch = scratch_of(docs.sparkSession)
    asked = scratch.keep(
        items.select(
            F.monotonically_increasing_id().alias("item"),
            F.col(item_col).alias("item_id"),
            F.col(item_text_col).cast("binary").alias("text"),
        ),
        "items",
    )
    pairs = counted(asked, ["item"], None).select("item", F.inline("terms"))
    pairs = scratch.keep(pairs.withColumnRenamed("tf", "times"), "item-terms")
    vocabulary = scratch.keep(
        pairs.select("term").distinct().select("term", F.monotonically_increasing_id().alias("number")),
        "vocabulary",
    )
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).cast("binary").alias("text"),
    )
    read = scratch.keep(counted(texts, ["row", "doc_id"], places_of(vocabulary, bits)), "counts")
    totals = one_row(
        read.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words"))
    )
    m = length(totals["docs"], totals["words"])
    vectors = (
        read.select("row", "doc_id", m.alias("m"), F.inline("terms"))
        .join(vocabulary, "term")
        .select("row", "doc_id", F.struct("number", impact().alias("impact")).alias("at"))
        .groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), F.collect_list("at").alias("at"))
        .select(
            "row",
            "doc_id",
            F.sqrt(
                F.aggregate(
                    "at", F.lit(0.0), lambda s, a: s + F.pow(a["impact"].cast("double"), F.lit(2))
                )
            ).alias("norm"),
            F.col("at.number").alias("terms"),
            F.col("at.impact").alias("impacts"),
        )
    )
    vectors = scratch.keep(
        vectors.repartitionByRange(F.desc("norm"), "row").sortWithinPartitions(F.desc("norm"), "row"),
        "vectors",
    )
    frequency = vectors.select(F.explode("terms").alias("number")).groupBy("number").count()
    weight = F.floor(
        WEIGHT * F.log((2.0 * totals["docs"] + 2) / (2.0 * F.col("count") + 1))
    ).cast("bigint")
    weights = scratch.keep(
        vocabulary.join(frequency, "number").select("term", "number", weight.alias("weight")), "weights"
    )
    coordinates = (
        pairs.join(weights, "term")
        .where("weight > 0")
        .groupBy("item")
        .agg(F.collect_list(F.struct("number", F.expr("times * weight").alias("w"))).alias("at"))
        .select("item", F.col("at.number").alias("terms"), F.col("at.w").alias("weights"))
    )
    # Queries are dealt to parts by hash, so a part has about `queries` of them.
    n_items = one_row(asked.agg(F.count("*").alias("n")))["n"]
    parts = max(1, -(-n_items // queries))
    held = scratch.keep(
        coordinates.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)))
        .groupBy("part")
        .applyInArrow(query_block, "part bigint, blob binary"),
        "queries",
    )
    buckets = grid.grouped(scratch.keep(grid.in_blocks(vectors, bucket_size, bucket), "buckets"), group)
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))
    passing = buckets.select(F.explode(every).alias("part"), "group", "rank", "blob")
    found = grid.meet(
        held,
        passing,
        lambda content: Searching(content, k),
        lambda searching, content: searching.go_by(content),
        lambda searching: searching.found(),
        "item bigint, doc_id bigint, row bigint, score bigint",
    )
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return (
        ranked.where(F.col("rank") <= k)
        .join(asked.select("item", "item_id"), "item")
        .select("item_id", "rank", "doc_id", "score")
    )


def op12_ranked_search(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return best_documents(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


_TERMS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)
ORACLE_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS_SQL} AS words FROM documents
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(len(words)) AS BIGINT) AS ll
  FROM docs WHERE len(words) > 0
), tf AS (
  SELECT r, term, count(*) AS tf
  FROM (SELECT r, unnest(words) AS term FROM docs) GROUP BY r, term
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nn + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM df, totals
), lengths AS (
  SELECT r, doc_id, 25 + (75 * CAST(len(words) AS BIGINT) * nn) // ll AS m FROM docs, totals
), items AS (
  SELECT i, item_id, term, count(*) AS c FROM (
    SELECT i, item_id, unnest(words) AS term FROM (
      SELECT row_number() OVER () AS i, item_id, {_TERMS_SQL} AS words FROM benchmark))
  GROUP BY i, item_id, term
), scores AS (
  SELECT i, item_id, doc_id, r,
         sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS score
  FROM items JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (r)
  GROUP BY i, item_id, doc_id, r
), ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= {K}
"""
