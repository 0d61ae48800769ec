"""Sharding by weighted rendezvous hashing of record keys.

Every key draws one number per shard; the shard with the smallest exponential
arrival time -ln(draw) / weight holds it. Adding a shard leaves the other draws
as they are, so keys move only into the new shard. The choice needs no shuffle.

Places inside a shard are counted in parallel: equal records are counted first,
records are ordered by a hash and cut into ranges of that hash, each range is
numbered alone and shifted by the sizes of the ranges before it.

Defined cases: a NULL text has 0 bytes and the checksum of no bytes; a NULL key
hashes as 'null'. Equal records get neighbouring places, in no stated order
among themselves. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieout.llm.common import DRAW_BITS, hashed_bits, one_row, scratch_of, table, with_copies

SHARDS = 16
RANGES_PER_PARTITION = 4


def arrival(key: Column, shard: Column, weight: Column) -> Column:
    drawn = (hashed_bits(key, shard) + F.lit(0.5)) / F.lit(float(1 << DRAW_BITS))
    return -F.log(drawn) / weight


def first_arrival(key: Column, weights: Sequence[float]) -> Column:
    """(arrival, shard) of the shard that holds the key; ties go to the lower number."""
    return F.array_min(
        F.transform(
            F.array(*[F.lit(float(w)) for w in weights]),
            lambda weight, shard: F.struct(
                arrival(key, shard, weight).alias("arrival"), shard.alias("shard")
            ),
        )
    )


def assign(
    records: DataFrame,
    key: str,
    weights: Sequence[float] = (1.0,) * SHARDS,
    grown_by: float | None = 1.0,
) -> DataFrame:
    """Add `shard`, and `grown_shard` as if a shard of weight `grown_by` were added."""
    best = records.withColumn("_best", first_arrival(F.col(key), weights))
    placed = best.withColumn("shard", F.col("_best.shard"))
    if grown_by is not None:
        new = arrival(F.col(key), F.lit(len(weights)), F.lit(float(grown_by)))
        moves = new < F.col("_best.arrival")
        placed = placed.withColumn(
            "grown_shard", F.when(moves, F.lit(len(weights))).otherwise(F.col("shard"))
        )
    return placed.drop("_best")


def shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    weights: Sequence[float] = (1.0,) * SHARDS,
) -> DataFrame:
    """Every record with size, checksum, shard, place in the shard and shard after growth."""
    spark = docs.sparkSession
    scratch = scratch_of(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    records = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    counted = records.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("_n"))
    placed = assign(counted, "doc_id", weights).withColumn(
        "_hash", hashed_bits(F.col("doc_id"), F.col("text_crc32"), F.col("size"))
    )
    kept = scratch.keep(placed, "placed")
    most = one_row(kept.agg(F.coalesce(F.max("_n"), F.lit(0)).alias("n")))["n"]

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, RANGES_PER_PARTITION * partitions // len(weights))
    width = -(-(1 << DRAW_BITS) // ranges)
    kept = kept.withColumn("_range", F.floor(F.col("_hash") / F.lit(width)).cast("int"))
    # One row per shard and range: RANGES_PER_PARTITION per shuffle partition.
    before = (
        Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        kept.groupBy("shard", "_range")
        .agg(F.sum("_n").alias("_n"))
        .select("shard", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = (
        Window.partitionBy("shard", "_range")
        .orderBy("_hash", "doc_id", "text_crc32", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = kept.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    joined = numbered.join(scratch.keep(offsets, "offsets"), ["shard", "_range"])
    first = joined.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("_before") + F.col("_inside")).alias("_first"),
        F.col("grown_shard").cast("int").alias("grown_shard"),
        "_n",
    )
    return with_copies(first, "_n", "_copy", most).select(
        "doc_id",
        "size",
        "text_crc32",
        "law",
        "shard",
        (F.col("_first") + F.col("_copy")).alias("slot"),
        "grown_shard",
    )


def op4_rendezvous_shards(spark, sf_dir):
    """All documents in 16 shards of equal weight, by key."""
    return shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
