"""Connected components by alternating stars, as joins over stored edges.

Large stars hang every neighbour that is greater than a node on the least node
around; small stars do so with the smaller ones. Alternating them ends in one
star per component, around its least node, after a number of rounds that grows
with the logarithm of its diameter. A node with many neighbours is a key with
many rows in an inner join, which adaptive execution splits; minima are combined
before they are shuffled. Every round is stored, so no lineage is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import one_row
from tieout.sources.lakehouse import Scratch


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """For edges with a > b, as large_star gives them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    inner = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return inner.unionByName(least.select("a", F.col("m").alias("b")))


def fingerprint(edges: DataFrame) -> tuple:
    pair = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(one_row(edges.agg(F.count("*").alias("n"), F.sum(pair).alias("s"))).values())


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of all nodes that have an edge (a, b); roots are least nodes.

    A root itself is left out: it is its own.
    """
    distinct = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    stars = scratch.keep(distinct.distinct(), "edges")
    seen = fingerprint(stars)
    while seen[0]:
        stars = scratch.keep(small_star(large_star(stars)).distinct(), "stars")
        now = fingerprint(stars)
        if now == seen:
            break
        seen = now
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
