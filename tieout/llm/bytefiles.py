"""Raw byte files, written and read by Spark on whatever storage the path names.

Spark has no sink for bytes. Its text sink writes a value's bytes as they are,
and after each value a line separator of choice; with one row per file, the
separator is a fixed end mark of the file. Reading uses the binaryFile source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_files(rows: DataFrame, path: str, end_mark: bytes) -> None:
    """Every row of a frame with one column of bytes as a file of its own."""
    (
        rows.select(F.col(rows.columns[0]).cast("string").alias("value"))
        .write.option("lineSep", end_mark.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(part, file, content), in the order of writing by part, then file."""
    numbers = r"part-(\d+)-.*-c(\d+)[^/]*$"
    return (
        spark.read.format("binaryFile")
        .load(path)
        .where(F.col("length") > 0)
        .select(
            F.regexp_extract("path", numbers, 1).cast("int").alias("part"),
            F.regexp_extract("path", numbers, 2).cast("int").alias("file"),
            "content",
        )
    )
