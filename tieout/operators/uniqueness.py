"""Uniqueness of a column without gathering rows that share a value.

A window partitioned by the column would put every row of a hot value, and all
blank ones, into one task. Instead values are counted, which combines on the
map side, and only those that repeat are kept, in a table written once.

While that table has few rows it is broadcast. Beyond that only rows whose value
may repeat are joined with it: a filter of the repeated values is broadcast, and rows
that it does not let through go past the join and are never shuffled. It misses none
and lets through less than 1% of the others, however many values repeat:

* The filter (see `membership`) grows with the number of repeated values.
* It has at most 2**MOST_BITS places, 256 MB for 134 million repeated values. Beyond that
  values are dealt to slices by hash, each with a filter of its own, and the rows of a
  slice meet that one alone. The input is then read twice per slice.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.contract import Rule
from tieout.functions.predicates import blank, copies_column, name
from tieout.operators.membership import (
    BITS_PER_VALUE,
    MOST_BITS,
    MOST_BROADCAST,
    filter_rows,
    parted,
    words_for,
)
from tieout.sources.lakehouse import Scratch

def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Non-blank values held by more than one row, with their number of rows."""
    return (
        df.where(f"NOT {blank(column)}")
        .groupBy(name(column))
        .agg(F.count("*").alias(copies_column(column)))
        .where(F.col(copies_column(column)) > 1)
    )


def attach_copies(
    df: DataFrame,
    rules: Iterable[Rule],
    scratch: Scratch,
    most_broadcast: int = MOST_BROADCAST,
    bits: int = MOST_BITS,
) -> DataFrame:
    """Add the copies column of every column under a unique rule, NULL where unrepeated.

    A filter has at most 2**bits places.
    """
    for column in sorted({r.column for r in rules if r.check == "unique"}):
        repeated = scratch.keep(repeated_values(df, column), f"repeated-{column}")
        values = repeated.count()
        if values <= most_broadcast:
            df = df.join(F.broadcast(repeated), column, "left")
        else:
            df = joined_where_possible(df, repeated, values, column, scratch, bits)
    return df


def joined_where_possible(
    df: DataFrame, repeated: DataFrame, values: int, column: str, scratch: Scratch, bits: int
) -> DataFrame:
    """df left-joined with repeated, shuffling only rows that may have a match."""
    slices = max(1, -(-values * BITS_PER_VALUE // (1 << bits)))
    words = words_for(-(-values // slices), bits)
    part = F.pmod(F.xxhash64(name(column), F.lit("slice")), F.lit(slices))
    found = []
    for number in range(slices):
        rows, values_of = df, repeated
        if slices > 1:
            # A NULL belongs to a slice, too: its hash is that of the rest.
            rows, values_of = df.where(part == number), repeated.where(part == number)
        words_of = scratch.keep(filter_rows(values_of, [column], words), f"filter-{column}")
        found += passed_and_joined(rows, values_of, words_of, column, words)
    return reduce(DataFrame.unionByName, found)


def passed_and_joined(
    df: DataFrame, repeated: DataFrame, filter_: DataFrame, column: str, words: int
) -> list[DataFrame]:
    """The rows that the filter lets through, joined, and all others as they are."""
    candidates, others = parted(df, filter_, [column], words)
    none = F.lit(None).cast("bigint").alias(copies_column(column))
    return [candidates.join(repeated, column, "left"), others.select("*", none)]
