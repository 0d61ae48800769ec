"""What several operators share: intermediate tables, keyed draws, copies of rows."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout.session import run_folder
from tieout.sources.lakehouse import Scratch

DRAW_BITS = 52
ROWS_AT_ONCE = 1 << 16


def scratch_of(spark: SparkSession) -> Scratch:
    """Intermediate tables of one call, in the shared folder the cluster names."""
    return Scratch(spark, run_folder(spark))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept_in_worker(key: str, make: Callable[[], object]):
    """Something that a Python worker makes once and keeps for its later tasks.

    Functions travel by value, so their globals are new in every task.
    """
    kept = sys.modules.setdefault("_tieout_kept", types.ModuleType("_tieout_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def one_row(df: DataFrame) -> dict:
    """The single row of an ungrouped aggregate."""
    return df.first().asDict()


def hashed_bits(*parts: Column) -> Column:
    """52 bits of the MD5 of the parts, joined by colons; NULL counts as 'null'.

    MD5, unlike Spark's own hashes, is the same in every engine and release.
    """
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("bigint")


def draw(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return hashed_bits(*parts) / F.lit(float(1 << DRAW_BITS))


def with_copies(df: DataFrame, copies: str, number: str, most: int) -> DataFrame:
    """Repeat each row `copies` times, `number` counting from 0.

    `most` is the largest count. A count beyond ROWS_AT_ONCE is dealt out in
    pieces first, so that no task and no array holds all copies of a row.
    """
    step = F.lit(ROWS_AT_ONCE).cast("bigint")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    if most > ROWS_AT_ONCE:
        starts = F.sequence(zero, F.col(copies) - one, step)
        df = df.where(F.col(copies) > 0).withColumn(number, F.explode(starts))
        df = df.repartition(*df.columns)
        last = F.least(F.col(number) + step, F.col(copies)) - one
        return df.withColumn(number, F.explode(F.sequence(F.col(number), last, one)))
    counted = F.sequence(zero, F.col(copies) - one, one)
    return df.where(F.col(copies) > 0).withColumn(number, F.explode(counted))
