"""A global row number computed in parallel.

row_number() over an unpartitioned window sorts everything in one task. Here
rows are range-partitioned by the sort order, numbered inside their range, and
shifted by the number of rows in the ranges before. Ranges are cut on the whole
sort order, so ties in its first column do not gather in one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieout.sources.lakehouse import Scratch

# monotonically_increasing_id() is partition << 33 | row in partition.
_ROW_BITS = 33


def global_rank(
    df: DataFrame, order: Sequence[Column], name: str, scratch: Scratch
) -> DataFrame:
    """Add `name`, 1 for the first row in `order`, which must be total."""
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_position", _ROW_BITS))
        .withColumn("_row", F.col("_position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_position")
    )
    # Range bounds are sampled, so they must be drawn once: counts and rows
    # have to come from the same cut.
    kept = scratch.keep(numbered, f"ranges-{name}")
    # One row per range: as many as there are shuffle partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        kept.groupBy("_range")
        .agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        kept.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_before") + F.col("_row") + 1)
        .drop("_range", "_row", "_before")
    )
