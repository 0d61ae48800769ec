"""Hard negatives and ranked search against plain loops, small blocks and odd rows."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tieout.llm import grid, hard_negatives, lexical

VECTORS = "vec_id long, embedding array<double>, label int"
DOCS = "doc_id long, text string"
ITEMS = "item_id string, text string"
LAST = float("inf")


def first(ranked, k):
    """Of (score, id, ...), the best; NULL ids last."""
    return sorted(ranked, key=lambda r: (-r[0], LAST if r[1] is None else r[1]))[:k]


# --- hard negatives --------------------------------------------------------------------


def negatives_by_loop(rows, positives=5, negatives=10):
    fit = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (i, label, v) in enumerate(fit):
        if i is None or i % 3:
            continue
        others = [
            (sum(a * b for a, b in zip(v, w)), j, m == label)
            for place, (j, m, w) in enumerate(fit)
            if place != at and len(w) == len(v)
        ]
        for score, j, _ in first([o for o in others if o[2]], positives):
            inside = [o for o in others if not o[2] and 30 * score <= 100 * o[0] <= 90 * score]
            for rank, (other, k, _) in enumerate(first(inside, negatives), 1):
                out.append((i, j, rank, k, score, other))
    return sorted(out, key=repr)


def mined(spark, rows, **settings):
    df = spark.createDataFrame(rows, VECTORS)
    for name in ("node", "part", "group", "blob", "rank", "length", "score", "positives"):
        df = df.withColumn(name, F.lit("clash"))
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 3 == 0, F.col("label"), **settings)
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("settings", [{}, {"block": 7, "anchors": 3, "group": 2}])
def test_negatives_equal_a_plain_loop(spark, settings):
    drawn = np.random.default_rng(3)
    centers = drawn.normal(size=(4, 6))
    rows = []
    for i in range(90):
        vector = centers[i % 4] + drawn.normal(size=6) * 0.8
        # A hot label, labels of one row, repeated vectors and so ties.
        label = 1 if i % 3 else (i if i % 2 else 2)
        rows.append((i, (rows[i - 1][1] if i % 5 == 4 else vector.tolist()), label))
    assert mined(spark, rows, **settings) == negatives_by_loop(rows)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0], 1),
        (0, [1.0, 2.0], 1),  # of the same id
        (3, [2.0, 1.0], None),
        (6, None, 1),
        (9, [1.0, None], 1),
        (12, [1.0, float("nan")], 1),
        (15, [float("inf"), 1.0], 1),
        (None, [1.0, 1.5], 1),
        (None, [0.5, 1.0], 2),
        (18, [1.0, 1.0], 2),
        (19, [0.9, 0.9], 2),
        (20, [0.4, 0.9], 1),
        (21, [0.0, 0.0], 1),
        (22, [-1.0, -2.0], 1),
        (24, [1.0, 2.0, 3.0], 1),  # of a length of its own
        (25, [1.0, 2.0, 3.5], 1),
        (26, [1.0, 1.0, 1.5], 3),
        (27, [], 1),
        (28, [], 1),
        (29, [], 2),
        (30, [1e6, 1.0], 4),  # sums beyond 2**53 are kept in whole numbers
        (31, [1e6, 2.0], 4),
        (32, [0.5e6, 2.0], 5),
    ]
    assert mined(spark, rows) == negatives_by_loop(rows)
    assert mined(spark, rows, block=2, anchors=2, group=1) == negatives_by_loop(rows)
    assert mined(spark, []) == []


def test_scores_beyond_64_bits_raise(spark):
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(0, [1e15], 1), (1, [1e15], 1), (2, [1e15], 2)])


def test_bounds_drop_rows_before_all_columns_are_read():
    drawn = np.random.default_rng(1)
    values = (drawn.normal(size=(2000, 64)) * 20).astype(np.int64)
    values[:, 8:] //= 20  # most of a score lies in few columns
    rows = hard_negatives.Rows(
        np.arange(2000), np.arange(2000), np.zeros(2000, bool), np.zeros(2000, np.int64),
        values.T.copy(), values.min(axis=0), values.max(axis=0),
    )
    direct = values @ values[0]
    least = int(0.7 * direct[0])
    read = []

    def keep(low, high, places):
        read.append(len(places))
        return high >= least

    places, scores = hard_negatives.scan(
        rows, rows.columns.astype(np.float64), values[0], np.arange(2000), keep
    )
    assert (np.flatnonzero(direct >= least) == places).all() and (direct[places] == scores).all()
    assert len(places) and read[2] < 500


# --- ranked search ---------------------------------------------------------------------


def search_by_loop(docs, items, k=10):
    terms = [Counter(lexical.terms_of((t or "").encode())) for _, t in docs]
    n_docs = sum(bool(t) for t in terms)
    n_words = sum(sum(t.values()) for t in terms)
    df = Counter(w for t in terms for w in t)
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for w, n in df.items()}
    out = []
    for item_id, text in items:
        asked = Counter(lexical.terms_of((text or "").encode()))
        scored = []
        for (doc_id, _), found in zip(docs, terms):
            n = sum(found.values())
            m = 25 + 75 * n * n_docs // max(n_words, 1)
            score = sum(
                c * weight[w] * (10**9 * found[w] // (1000 * found[w] + 8 * m))
                for w, c in asked.items()
                if w in found
            )
            if score > 0:
                scored.append((score, doc_id))
        out += [(item_id, r, d, s) for r, (s, d) in enumerate(first(scored, k), 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, **settings):
    docs = spark.createDataFrame(docs, DOCS)
    for name in ("row", "n", "terms", "item", "number", "score", "m"):
        docs = docs.withColumn(name, F.lit("clash"))
    found = lexical.best_documents(docs, spark.createDataFrame(items, ITEMS), **settings)
    return sorted(map(tuple, found.collect()), key=repr)


def words(drawn, n, most):
    return " ".join(f"w{int(x)}" for x in np.minimum(drawn.zipf(1.3, n), most))


@pytest.mark.parametrize(
    "settings", [{}, {"bucket_size": 9, "queries": 4, "group": 2, "bits": 6}, {"k": 3, "bucket_size": 16}]
)
def test_search_equals_a_plain_loop(spark, settings):
    drawn = np.random.default_rng(11)
    docs = [(i, words(drawn, int(drawn.integers(1, 200)), 400)) for i in range(150)]
    docs += [(200 + i, docs[i % 3][1]) for i in range(40)]  # many copies, so ties
    docs += [(5, "w1 w2 w399"), (5, "w1 w2 w399")]
    items = [(str(i), words(drawn, 12, 400)) for i in range(14)] + [("0", "w3 W3 w3 w7")]
    expected = search_by_loop(docs, items, settings.get("k", 10))
    assert searched(spark, docs, items, **settings) == expected


def test_odd_texts(spark):
    docs = [
        (1, None),
        (2, ""),
        (3, "... --- ..."),
        (None, "été Été straße x"),
        (4, "Été ÉTÉ été"),
        (5, "long " * 50_000 + "x1 y-z"),
        (6, "x"),
        (7, "all"),
    ]
    items = [("a", None), ("b", ""), ("c", "--"), (None, "été x"), ("d", "LONG y z"), ("d", "unseen")]
    assert searched(spark, docs, items) == search_by_loop(docs, items)
    assert searched(spark, [], items) == []
    assert searched(spark, docs, []) == []


def test_buckets_out_of_reach_are_skipped():
    met = []

    class Counting(lexical.Searching):
        def search(self, query, bucket):
            before = list(self.best[query])
            super().search(query, bucket)
            met.append(before != self.best[query])

    content = {
        "items": np.array([1]), "ends": np.array([0, 2]),
        "terms": np.array([7, 9]), "weights": np.array([50, 3]),
    }
    state = Counting(content, 1)

    def bucket(impacts):
        return {
            "rows": np.array([1]), "doc_ids": np.array([1]), "no_id": np.array([False]),
            "norms": np.array([math.hypot(*impacts)]), "coordinates": np.array([7, 9]),
            "ends": np.array([0, 1, 2]), "largest": np.array(impacts),
            "documents": np.array([0, 0]), "impacts": np.array(impacts),
        }

    for impacts in ([10, 1], [10, 2], [1, 90], [11, 1]):
        state.go_by(bucket(impacts))
    assert met == [True, True, False, True] and state.best[0][0][0] == -553


def test_blocks_and_groups(spark):
    rows = spark.range(50).repartition(3)
    made = grid.in_blocks(rows, 8, lambda t: (grid.packed(ids=t["id"].to_numpy()), 1.0, {}))
    found = [grid.unpacked(r.blob)["ids"] for r in made.collect()]
    assert sorted(np.concatenate(found).tolist()) == list(range(50))
    assert max(map(len, found)) == 8
