"""Physical lines of text files: where they lie, and which of them end a CSV record.

Nothing here uses the CSV reader, so what it counts can be held against what the reader
returned. Files are read as splittable text. Lines come with the split they are read in and
a number that rises by one within it; what needs the lines before is summed up per split
first and carried over the splits of a file, a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPLIT = ["file", "split"]


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, number, line); a carriage return stays part of its line."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("number"),
            F.col("value").alias("line"),
        )
    )


def before(column: str) -> Column:
    """The sum of a column over the splits of the file before this one."""
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0))


def blank(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, "\r$", "")) == ""


def records(spark: SparkSession, path: str, escape: str = "\\") -> DataFrame:
    """(file, records): lines that end outside quotes, the header being one.

    A quote begins or ends a quoted stretch; one that the escape character precedes, or
    doubled quotes, change nothing. Only lines with an odd number of quotes turn what
    follows: they alone are put in order, and lines between them are counted by their
    numbers. A bare quote in an unquoted cell is taken for a beginning, so the count is
    then wrong. Stretches that never end give one record.
    """
    lines = numbered_lines(spark, path)
    text = F.col("line") if escape == '"' else F.regexp_replace("line", r"(?s)\\.", "")
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    turning = lines.select(*SPLIT, "number", (quotes % 2 == 1).alias("turns"))
    splits = turning.groupBy(*SPLIT).agg(
        F.min("number").alias("first"),
        F.max("number").alias("last"),
        F.count_if("turns").alias("turns"),
    )
    in_order = Window.partitionBy(*SPLIT).orderBy("number")
    # Turn k to turn k + 1, for even k: the lines that end outside, if the split begins so.
    runs = turning.where("turns").select(
        *SPLIT,
        "number",
        F.row_number().over(in_order).alias("k"),
        F.lead("number").over(in_order).alias("next"),
    )
    inner = runs.where("k % 2 = 0").groupBy(*SPLIT).agg(
        F.sum(F.col("next") - F.col("number")).alias("between"),
        F.max(F.when(F.col("next").isNull(), F.col("number"))).alias("open"),
    )
    first_turn = turning.where("turns").groupBy(*SPLIT).agg(F.min("number").alias("turn"))
    after = F.col("last") + 1
    outside = (
        F.coalesce("turn", after)
        - F.col("first")
        + F.coalesce("between", F.lit(0))
        + F.coalesce(after - F.col("open"), F.lit(0))
    )
    counted = (
        splits.join(first_turn, SPLIT, "left")
        .join(inner, SPLIT, "left")
        .select(
            *SPLIT,
            "turns",
            (after - F.col("first")).alias("lines"),
            outside.alias("outside"),
            (before("turns") % 2 == 1).alias("begins_inside"),
        )
    )
    ended = F.when(F.col("begins_inside"), F.col("lines") - F.col("outside")).otherwise(F.col("outside"))
    return counted.groupBy("file").agg((F.sum(ended) + F.sum("turns") % 2).alias("records"))


def placed(lines: DataFrame, wanted: Column) -> DataFrame:
    """(file, offset, line) of the wanted lines, offset in bytes from the file's start.

    Only splits with such lines are gone through in order, each by itself.
    """
    size = F.octet_length("line") + 1
    hits = lines.where(wanted).select(*SPLIT).distinct()
    starts = (
        lines.groupBy(*SPLIT).agg(F.sum(size).alias("size")).select(*SPLIT, before("size").alias("start"))
    )
    so_far = Window.partitionBy(*SPLIT).orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    inside = lines.join(hits, SPLIT, "left_semi").select(
        *SPLIT,
        F.when(wanted, F.col("line")).alias("line"),
        F.coalesce(F.sum(size).over(so_far), F.lit(0)).alias("offset"),
    )
    return (
        inside.where("line IS NOT NULL")
        .join(starts, SPLIT)
        .select("file", (F.col("start") + F.col("offset")).alias("offset"), "line")
    )
