"""A filter of values, to broadcast: rows it stops surely hold none of them.

A value sets and looks up BITS_SET bits of one 64-bit word, both picked by hash. With
BITS_PER_VALUE places for each value less than 1% of other rows pass, and words are kept
1,024 to a row, so the filter takes 2 bytes a value. Values are those of one column or of
several together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.functions.predicates import name

MOST_BROADCAST = 200_000  # rows of a table of values that is broadcast itself
BITS_PER_VALUE = 16
BITS_SET = 4
MOST_BITS = 31  # 2**MOST_BITS places are 256 MB
WORD_BITS = 6
ROW_BITS = 10  # words of a row of the filter


def words_for(values: int, bits: int = MOST_BITS) -> int:
    """Words of a filter of so many values, with at most 2**bits places."""
    return max(1, -(-min(values * BITS_PER_VALUE, 1 << bits) >> WORD_BITS))


def hashed(columns: Sequence[str], *salt: str) -> Column:
    return F.xxhash64(*map(name, columns), *map(F.lit, salt))


def word_of(columns: Sequence[str], words: int) -> Column:
    return F.pmod(hashed(columns), F.lit(words))


def mask_of(columns: Sequence[str]) -> Column:
    """The bits of a value in its word."""
    picked = hashed(columns, "bits")
    places = [
        F.pmod(F.shiftright(picked, WORD_BITS * i), F.lit(1 << WORD_BITS)).cast("int")
        for i in range(BITS_SET)
    ]
    one = F.lit(1).cast("bigint")
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", one, p) for p in places])


def filter_rows(values: DataFrame, columns: Sequence[str], words: int) -> DataFrame:
    """(_row, _words): 2**ROW_BITS words to a row, none left out."""
    set_words = values.select(word_of(columns, words).alias("_word"), mask_of(columns).alias("_bits"))
    every = values.sparkSession.range(words + (-words) % (1 << ROW_BITS))
    empty = every.select(F.col("id").alias("_word"), F.lit(0).cast("bigint").alias("_bits"))
    merged = set_words.unionByName(empty).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    in_order = F.array_sort(F.collect_list(F.struct("_word", "_bits")))
    return (
        merged.groupBy(F.shiftright("_word", ROW_BITS).alias("_row"))
        .agg(in_order.alias("_words"))
        .select("_row", F.col("_words._bits").alias("_words"))
    )


def parted(
    df: DataFrame, filter_: DataFrame, columns: Sequence[str], words: int
) -> tuple[DataFrame, DataFrame]:
    """The rows that pass the filter, and all others. None is shuffled."""
    word = word_of(columns, words)
    held = F.get("_words", F.pmod(word, F.lit(1 << ROW_BITS)).cast("int"))
    marked = df.withColumn("_row", F.shiftright(word, ROW_BITS)).join(F.broadcast(filter_), "_row", "left")
    passes = held.bitwiseAND(mask_of(columns)) == mask_of(columns)
    own = [name(c) for c in df.columns]
    return marked.where(passes).select(*own), marked.where(~passes).select(*own)
