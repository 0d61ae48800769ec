"""Mixing, sharding and license scans."""

from __future__ import annotations

import hashlib
import math
import os
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tieout.llm import common, licenses, mixing, queries, sharding

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string"


def connection():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels"):
        path = f"{SF}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*' * os.path.isdir(path)}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    rows = [r.asDict() for r in queries.QUERIES[name](spark, SF).collect()]
    expected = connection().sql(queries.ORACLE_SQL[name])
    columns = sorted(expected.columns)
    wanted = [dict(zip(expected.columns, r)) for r in expected.fetchall()]

    def key(row):
        return tuple((row[c] is None, row[c]) for c in columns)

    assert sorted(map(key, rows)) == sorted(map(key, wanted))


def fill(sizes: list[int], weights: list[int], share: float, most: float) -> list[float]:
    """Share by weight, cut at the limits, share the excess again until none is above."""
    targets, budget, free = [0.0] * len(sizes), share * sum(sizes), set(range(len(sizes)))
    while free:
        unit = budget / sum(weights[i] for i in free)
        above = {i for i in free if unit * weights[i] > most * sizes[i]}
        if not above:
            for i in free:
                targets[i] = unit * weights[i]
            break
        for i in above:
            targets[i] = most * sizes[i]
            budget -= targets[i]
        free -= above
    return targets


def test_targets_are_filled_up_to_their_limits(spark):
    sizes = {"a": 10, "b": 2_000, "c": 5, "d": 300, "e": 0, "f": 40, None: 700}
    rows = [(1, "w " * n, s) for s, n in sizes.items()]
    df = mixing.planned(spark.createDataFrame(rows, DOCS))
    got = {r["source"]: r["target"] for r in df.select("row.source", "target").collect()}
    order = sorted(s for s in sizes if s is not None) + [None]
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(order))]
    wanted = fill([sizes[s] for s in order], weights, mixing.SHARE, mixing.MOST)
    assert [got[s] for s in order] == pytest.approx(wanted)


def test_mix_copies_rows_as_planned_and_again_the_same(spark):
    rows = [(i, "x y z " * (i % 7), f"s{i % 3}") for i in range(200)]
    rows += [(None, "lone", "s0"), (None, "lone", "s0"), (7, None, None), (8, "", "s1")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit(9)).withColumn("copies", F.lit(1))
    planned = mixing.planned(docs)
    counts = Counter()
    for r in planned.select("row.doc_id", "row.text", "copies").collect():
        counts[r["doc_id"], r["text"]] += r["copies"]
        assert 0 <= r["copies"] <= 2
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in mixed.collect()) == +counts
    assert Counter(mixing.mix(docs).collect()) == Counter(mixed.collect())


def test_taken_words_come_near_the_target(spark):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 4}") for i in range(4_000)]
    df = mixing.planned(spark.createDataFrame(rows, DOCS))
    taken = df.groupBy("row.source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("target").alias("target")
    )
    for r in taken.collect():
        assert r["taken"] == pytest.approx(r["target"], rel=0.08)


def test_empty_mix(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


def test_copies_beyond_one_array(spark, monkeypatch):
    monkeypatch.setattr(common, "ROWS_AT_ONCE", 4)
    df = spark.createDataFrame([("a", 11), ("b", 1), ("c", 0)], "k string, n long")
    rows = common.with_copies(df, "n", "i", 11).collect()
    assert sorted((r["k"], r["i"]) for r in rows) == [("a", i) for i in sorted(range(11))] + [("b", 0)]


# --- shards ---------------------------------------------------------------------------


def by_hand(key, weights):
    def arrival(shard):
        text = f"{'null' if key is None else key}:{shard}"
        bits = int(hashlib.md5(text.encode()).hexdigest()[:13], 16)
        return -math.log((bits + 0.5) / 2**52) / weights[shard]

    return min(range(len(weights)), key=lambda s: (arrival(s), s))


def test_shards_against_brute_force(spark):
    rows = [(i, f"text {i % 50} é") for i in range(600)] + [(None, None), (5, ""), (5, "")]
    rows += [(77, f"same key {i}") for i in range(300)] + [(78, "same row")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shards(docs).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    for r in got:
        assert r["shard"] == by_hand(r["doc_id"], [1.0] * 16)
        assert r["grown_shard"] == by_hand(r["doc_id"], [1.0] * 17)
        assert r["grown_shard"] in (r["shard"], 16) and r["law"] == "key"
    for shard in range(16):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_weighted_shards_hold_their_share(spark):
    weights = (1.0, 3.0, 0.5)
    rows = sharding.assign(spark.range(6_000), "id", weights).groupBy("shard").count().collect()
    for r in rows:
        assert r["count"] / 6_000 == pytest.approx(weights[r["shard"]] / 4.5, rel=0.12)


def test_no_shards_of_nothing(spark):
    assert sharding.shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# --- licenses -------------------------------------------------------------------------


def test_license_texts_in_disguise(spark):
    mit, isc = licenses.KNOWN[0][1], licenses.KNOWN[5][1]
    rows = [
        (1, "// Copyright (c) 2024 Somebody\n\n" + mit.upper().replace(",", " ;")),
        (2, mit.replace("sublicense", "sub-\nlicence") + "\n(c) 2001 Else\nAll rights reserved."),
        (3, isc.replace(" ", "\t\t")),
        (4, mit + " And more."),
        (5, "Some words.\nReleased under the MIT licence\nLicensed under CC BY-NC 4.0"),
        (6, None),
        (7, ""),
        (8, "Copyright 2020"),
        (9, "long " * 200_000),
        (3, isc.replace(" ", "\t\t")),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit("x"))
    got = [(r["doc_id"], r["license"], r["line_licenses"]) for r in licenses.license_scan(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, "MIT", ""),
            (2, "MIT", ""),
            (3, "ISC", ""),
            (3, "ISC", ""),
            (4, None, ""),
            (5, None, "CC-BY-NC-4.0,MIT"),
            (6, None, ""),
            (7, None, ""),
            (8, None, ""),
            (9, None, ""),
        ],
        key=str,
    )


def test_own_licenses_and_empty_tables(spark):
    known = spark.createDataFrame(
        [("B", "Do what you like."), ("A", "do what you LIKE"), ("C", None)], "license string, text string"
    )
    docs = spark.createDataFrame([(1, "Do  what; you like")], "doc_id long, text string")
    assert licenses.license_scan(docs, known=known).first()["license"] == "A"
    assert licenses.license_scan(docs.limit(0), known=known).count() == 0
    assert licenses.license_scan(docs, known=known.limit(0)).first()["license"] is None
