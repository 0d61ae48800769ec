"""Hard negatives of anchors by BOND: inner products column by column, bounded from both sides.

Vectors are made whole numbers and stored in blocks by column, with the least and the
largest value of each column. For an anchor, columns are read in descending order of
its own components' size, some at a time. What the columns not read can still add lies
between sums of least and largest contributions, so every row's score does, too, and
rows leave the bitmap of candidates as soon as no score they may have is of use:

* positives, the anchor's best rows of its own label: rows that cannot reach the worst of
  the best met so far, or the worst of as many lower bounds in this block;
* negatives, per positive the best rows of other labels in a window of scores: rows that
  cannot reach any window, or only with a score above it, or not the worst of the best
  that are surely inside.

Columns are read until none is left, so every score that stays is exact; scores are 64-bit
integers (sums are kept in doubles where none can pass 2**53).

Anchors are a stated set of queries; blocks of them are held while blocks of all rows go
by (see `grid`). Rows are sorted by length of vector and label first: positives then only
visit blocks that share a label with the anchors, and any number of rows of one label, or
of labels with few rows, gives full blocks. Each group of blocks gives at most the rows
asked for per window; these are ranked once more over all groups, K rows a task.

Defined cases: rows with a NULL label, a NULL vector, or any NULL or non-finite component
take no part; vectors of different length do not meet; empty vectors score 0. Rows that
share an id stay apart: others of the same id are other rows, and anchors of the same id
each have their rows. NULL ids come last among equal scores and are no anchors; then the
order of rows decides. A positive score of 0 or less has the window that the bounds give:
only 0 at 0, and nothing below. Components beyond 2**62 / 256 and scores beyond 64 bits
raise. Very long vectors make blocks of fewer rows. Other columns are not read, whatever
their names. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieout.llm import grid
from tieout.llm.common import scratch_of, table

POSITIVES, NEGATIVES = 5, 10
LEAST_PERCENT, MOST_PERCENT = 30, 90  # of the positive's score
SCALE = 256
BLOCK = 8192
ANCHORS = 4096
WIDTH = 256  # of the longest vectors of which blocks are full
STEPS = 8  # columns are read in about so many portions
EXACT = 1 << 53
NO_SCORE = np.iinfo(np.int64).min

# --- blocks ---------------------------------------------------------------------------


def matrix(rows: pa.Table) -> np.ndarray:
    lists = rows["vector"].combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def narrow(values: np.ndarray) -> np.ndarray:
    """In the smallest signed integers that hold them."""
    most = max(abs(int(values.min(initial=0))), abs(int(values.max(initial=0))))
    for kind in (np.int16, np.int32):
        if most <= np.iinfo(kind).max:
            return values.astype(kind)
    return values


def described(rows: pa.Table, **more: np.ndarray) -> tuple[bytes, float, dict]:
    labels = rows["label"].to_numpy()
    ids = rows["vec_id"]
    blob = grid.packed(
        nodes=rows["node"].to_numpy(),
        ids=ids.fill_null(0).to_numpy(),
        no_id=ids.is_null().to_numpy(zero_copy_only=False),
        labels=labels,
        **more,
    )
    kind = {"length": rows["length"][0].as_py(), "low": int(labels[0]), "high": int(labels[-1])}
    return blob, 0.0, kind


def fitting(most: int):
    """Rows of a block by the length of its vectors: at most `most`, fewer of long ones."""
    return lambda length: max(1, min(most, most * WIDTH // max(length, 1)))


def row_block(rows: pa.Table) -> tuple[bytes, float, dict]:
    """Rows of one length in order of label, stored by column."""
    values = matrix(rows)
    least, largest = values.min(axis=0), values.max(axis=0)
    return described(rows, columns=narrow(np.ascontiguousarray(values.T)), least=least, largest=largest)


def anchor_block(rows: pa.Table) -> tuple[bytes, float, dict]:
    more = {}
    if "positives" in rows.column_names:
        lists = rows["positives"].combine_chunks()
        parts = lists.flatten()
        more = {
            "ends": np.append(0, np.cumsum(pa.compute.list_value_length(lists).to_numpy())),
            "scores": parts.field("score").to_numpy(),
        }
    return described(rows, vectors=narrow(matrix(rows)), **more)


# --- one anchor and one block -----------------------------------------------------------


@dataclass
class Rows:
    """A block of rows, with columns in the type that sums are kept in."""

    nodes: np.ndarray
    ids: np.ndarray
    no_id: np.ndarray
    labels: np.ndarray
    columns: np.ndarray
    least: np.ndarray
    largest: np.ndarray

    def exact_in(self, vectors: np.ndarray) -> type:
        """The type in which no score of these vectors is rounded."""
        largest = [max(abs(int(a)), abs(int(b))) for a, b in zip(self.least, self.largest)]
        own = np.abs(vectors.astype(np.float64)).max(axis=0, initial=0.0)
        bound = sum(a * int(b) for a, b in zip(largest, own))
        if bound < EXACT:
            return np.float64
        if bound < 1 << 62:
            return np.int64
        raise OverflowError("inner products of these vectors pass 64 bits")


def scan(rows: Rows, columns: np.ndarray, anchor: np.ndarray, alive: np.ndarray, keep) -> tuple:
    """(places, scores) of the rows that `keep` lets through to the last column.

    `alive` are the places to start with. `keep(low, high, places)` gives a mask from the
    bounds of the scores; on the last call both bounds are the score.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    a = anchor[order].astype(columns.dtype)
    ends = rows.least[order].astype(columns.dtype) * a, rows.largest[order].astype(columns.dtype) * a
    low = np.append(np.cumsum(np.minimum(*ends)[::-1])[::-1], 0)
    high = np.append(np.cumsum(np.maximum(*ends)[::-1])[::-1], 0)
    sums = np.zeros(len(alive), columns.dtype)
    step = max(1, -(-len(order) // STEPS))
    # Nothing is read before the bounds of all columns were looked at.
    going = keep(sums + low[0], sums + high[0], alive)
    alive, sums = alive[going], sums[going]
    for at in range(0, len(order), step):
        if not len(alive):
            break
        part = columns[order[at : at + step]]
        if len(alive) < part.shape[1]:
            part = part[:, alive]
        sums = sums + a[at : at + step] @ part
        to = min(at + step, len(order))
        going = keep(sums + low[to], sums + high[to], alive)
        alive, sums = alive[going], sums[going]
    return alive, sums.astype(np.int64)


def kth_best(scores: np.ndarray, k: int) -> int | None:
    if len(scores) < k:
        return None
    return int(np.partition(scores, len(scores) - k)[len(scores) - k])


def merged(best: list[tuple], rows: Rows, places: np.ndarray, scores: np.ndarray, k: int) -> list:
    """The k best of (-score, no id, id, node)."""
    keys = (rows.nodes[places], rows.ids[places], rows.no_id[places], -scores)
    first = np.lexsort(keys)[:k]
    return sorted([*best, *zip(*(key[first].tolist() for key in reversed(keys)))])[:k]


class Anchors:
    """A block of anchors. Their vectors meet blocks of rows of the same length."""

    def __init__(self, content: dict, k: int):
        self.k = k
        self.nodes, self.labels = content["nodes"], content["labels"]
        self.vectors = content["vectors"].astype(np.int64)

    def go_by(self, content: dict) -> None:
        rows = Rows(**content)
        columns = rows.columns.astype(rows.exact_in(self.vectors))
        for anchor in range(len(self.nodes)):
            self.meet(anchor, rows, columns)


class Positives(Anchors):
    """The best rows of each anchor's own label."""

    def __init__(self, content: dict, k: int):
        super().__init__(content, k)
        self.best: list[list[tuple]] = [[] for _ in self.nodes]

    def meet(self, anchor: int, rows: Rows, columns: np.ndarray) -> None:
        label = self.labels[anchor]
        same = slice(*np.searchsorted(rows.labels, [label, label + 1]))
        alive = np.arange(same.start, same.stop)
        alive = alive[rows.nodes[same] != self.nodes[anchor]]
        best = self.best[anchor]
        least = -best[-1][0] if len(best) == self.k else NO_SCORE

        def keep(low: np.ndarray, high: np.ndarray, places: np.ndarray) -> np.ndarray:
            nonlocal least
            sure = kth_best(low, self.k)
            if sure is not None:
                least = max(least, sure)
            return high >= least

        places, scores = scan(rows, columns, self.vectors[anchor], alive, keep)
        if len(places):
            self.best[anchor] = merged(best, rows, places, scores, self.k)

    def found(self) -> pa.RecordBatch | None:
        rows = [
            (node, other, None if no_id else vec_id, -minus)
            for node, best in zip(self.nodes.tolist(), self.best)
            for minus, no_id, vec_id, other in best
        ]
        return batch(rows, ["anchor", "node", "vec_id", "score"])


class Negatives(Anchors):
    """Per positive of each anchor, the best rows of other labels in its window."""

    def __init__(self, content: dict, k: int, least_percent: int, most_percent: int):
        super().__init__(content, k)
        ends, scores = content["ends"], content["scores"].tolist()
        # Windows in whole numbers: 100 * score between the percentages of the positive's.
        self.windows = [
            [(-(-least_percent * s // 100), most_percent * s // 100) for s in scores[a:b]]
            for a, b in zip(ends, ends[1:])
        ]
        self.best: list[list[list[tuple]]] = [[[] for _ in own] for own in self.windows]

    def meet(self, anchor: int, rows: Rows, columns: np.ndarray) -> None:
        windows, best = self.windows[anchor], self.best[anchor]
        alive = np.flatnonzero(rows.labels != self.labels[anchor])
        least = [
            max(low, -found[-1][0]) if len(found) == self.k else low
            for (low, _), found in zip(windows, best)
        ]

        def keep(low: np.ndarray, high: np.ndarray, places: np.ndarray) -> np.ndarray:
            wanted = np.zeros(len(places), bool)
            for w, (_, top) in enumerate(windows):
                below = high <= top
                sure = kth_best(low[below & (low >= least[w])], self.k)
                if sure is not None:
                    least[w] = max(least[w], sure)
                wanted |= (high >= least[w]) & (low <= top)
            return wanted

        places, scores = scan(rows, columns, self.vectors[anchor], alive, keep)
        for w, (_, top) in enumerate(windows):
            inside = (scores >= least[w]) & (scores <= top)
            if inside.any():
                best[w] = merged(best[w], rows, places[inside], scores[inside], self.k)

    def found(self) -> pa.RecordBatch | None:
        rows = [
            (node, w, other, None if no_id else vec_id, -minus)
            for node, windows in zip(self.nodes.tolist(), self.best)
            for w, best in enumerate(windows)
            for minus, no_id, vec_id, other in best
        ]
        return batch(rows, ["anchor", "place", "node", "vec_id", "score"])


def batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch | None:
    if not rows:
        return None
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)


# --- on Spark -------------------------------------------------------------------------


def whole_numbers(vector: Column) -> Column:
    """floor(256 * x) of each component, x as double; too large ones raise."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("bigint"))


def usable(vector: Column) -> Column:
    infinity = F.lit(float("inf"))
    return F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < infinity)
    )


def best_of(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("node")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
    most_percent: int = MOST_PERCENT,
    block: int = BLOCK,
    anchors: int = ANCHORS,
    group: int = grid.GROUP,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `is_anchor` and `label` are expressions over `embeddings`.
    """
    scratch = scratch_of(embeddings.sparkSession)
    vector = F.col(vector_col)
    named = embeddings.select(
        F.monotonically_increasing_id().alias("node"),
        F.col(id_col).cast("bigint").alias("vec_id"),
        label.cast("bigint").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        F.when(usable(vector), whole_numbers(vector)).alias("vector"),
    )
    taking_part = named.where("label IS NOT NULL AND vector IS NOT NULL")
    order = ["length", "label", "node"]
    # By length and label, ties apart: no label, however many rows it has, is one task's.
    rows = scratch.keep(
        taking_part.withColumn("length", F.size("vector"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order),
        "rows",
    )
    kind = "length bigint, low bigint, high bigint"
    blocks = scratch.keep(grid.in_blocks(rows, fitting(block), row_block, kind, "length"), "blocks")
    blocks = grid.grouped(blocks, group)
    asking = rows.where("asks")

    def in_parts(of: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Blocks of anchors as parts, and per block of rows of their length the parts."""
        made = scratch.keep(grid.in_blocks(of, fitting(anchors), anchor_block, kind, "length"), name)
        parts = made.select(F.col("block").alias("part"), "length", "low", "high")
        rows_of = blocks.withColumnsRenamed({"low": "_low", "high": "_high"}).drop("block")
        return made.select(F.col("block").alias("part"), "blob"), rows_of.join(parts, "length")

    held, near = in_parts(asking, "anchors")
    first = grid.meet(
        held,
        near.where("_low <= high AND low <= _high"),
        lambda content: Positives(content, positives),
        lambda state, content: state.go_by(content),
        lambda state: state.found(),
        "anchor bigint, node bigint, vec_id bigint, score bigint",
    )
    best = scratch.keep(best_of(first, ["anchor"], positives), "positives")
    with_positives = asking.join(
        best.groupBy(F.col("anchor").alias("node")).agg(
            F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("positives")
        ),
        "node",
    )
    with_positives = with_positives.repartitionByRange(*order).sortWithinPartitions(*order)
    held, near = in_parts(with_positives, "anchors-with-positives")
    # A block of the anchors' own label alone has no negative.
    others = near.where("NOT (low = high AND _low = _high AND low = _low)")
    second = grid.meet(
        held,
        others,
        lambda content: Negatives(content, negatives, least_percent, most_percent),
        lambda state, content: state.go_by(content),
        lambda state: state.found(),
        "anchor bigint, place bigint, node bigint, vec_id bigint, score bigint",
    )
    ranked = best_of(second, ["anchor", "place"], negatives)
    chosen = best.select(
        "anchor",
        (F.col("rank") - 1).cast("bigint").alias("place"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    ids = asking.select(F.col("node").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        ranked.join(chosen, ["anchor", "place"])
        .join(ids, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )


def op11_hard_negatives(spark, sf_dir):
    """Negatives of every hundredth vector, a seventh of all labels being moved on by one."""
    found = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(found, F.col("vec_id") % 100 == 0, moved)


ORACLE_SQL = f"""
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r AS other, b.vec_id AS other_id,
         a.label = b.label AS same,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)
), positives AS (
  SELECT *, row_number() OVER (
    PARTITION BY anchor ORDER BY score DESC, other_id NULLS LAST, other) AS place
  FROM pairs WHERE same
), windows AS (
  SELECT p.anchor_id, p.anchor, p.place, p.other_id AS positive_id, p.score AS positive_score,
         n.other_id AS negative_id, n.score AS negative_score,
         row_number() OVER (
           PARTITION BY p.anchor, p.place
           ORDER BY n.score DESC, n.other_id NULLS LAST, n.other) AS rank
  FROM positives p JOIN pairs n
    ON p.anchor = n.anchor AND NOT n.same AND p.place <= {POSITIVES}
   AND {LEAST_PERCENT} * p.score <= 100 * n.score AND 100 * n.score <= {MOST_PERCENT} * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id,
       CAST(positive_score AS BIGINT) AS positive_score,
       CAST(negative_score AS BIGINT) AS negative_score
FROM windows WHERE rank <= {NEGATIVES}
"""
