"""Annotated rows to the typed table and the quarantine."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieout import schemas
from tieout.functions.casts import typed
from tieout.functions.predicates import COUNT, IDS, blank
from tieout.functions.scores import dq_score

LINEAGE = schemas.LINEAGE.fieldNames()


def typed_fields(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if f.name not in LINEAGE and f.dataType != schemas.STRING]


def with_types(clean: DataFrame, schema: T.StructType) -> DataFrame:
    """The silver columns, followed by the text that the typed ones were read from."""
    return clean.select(
        *[
            F.col(f.name) if f.name in LINEAGE else typed(f.name, f.dataType).alias(f.name)
            for f in schema.fields
        ],
        *[F.col(f.name).alias(f"_text_{f.name}") for f in typed_fields(schema)],
    )


def to_silver(clean: DataFrame, schema: T.StructType) -> DataFrame:
    return with_types(clean, schema).select(*schema.fieldNames())


def to_quarantine(rejected: DataFrame, dataset: str, schema: T.StructType) -> DataFrame:
    """Rows as received, with the reasons for rejecting them."""
    stamped = rejected.withColumns(
        {"_quarantined_at": F.current_timestamp(), "_dataset": F.lit(dataset)}
    )
    return stamped.select(*schema.fieldNames())


def losses(schema: T.StructType) -> list[Column]:
    """Over `with_types`: values present in the text but NULL once typed, per column.

    Rules do not cover every typed column, and a well-formed date need not
    exist. Zero everywhere means that nothing was lost on the way to silver.
    """
    return [
        F.count_if(F.col(f.name).isNull() & ~F.expr(blank(f"_text_{f.name}"))).alias(f.name)
        for f in typed_fields(schema)
    ]


def cast_losses(clean: DataFrame, schema: T.StructType) -> DataFrame:
    """(column_name, lost) in a pass of its own; `pipeline.refine` counts while writing."""
    pairs = [
        F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("lost"))
        for f in typed_fields(schema)
    ]
    counted = with_types(clean, schema).agg(*losses(schema))
    return counted.select(F.inline(F.array(*pairs)))


def conservation(
    bronze: Mapping[str, DataFrame],
    silver: Mapping[str, DataFrame],
    quarantine: Mapping[str, DataFrame],
) -> DataFrame:
    """Per dataset: rows landed, typed and rejected, and whether they add up."""
    counts = tagged_counts(bronze, "bronze")
    counts = counts.unionByName(tagged_counts(silver, "silver"))
    counts = counts.unionByName(tagged_counts(quarantine, "quarantine"))
    per_dataset = counts.groupBy("dataset").agg(
        *[
            F.sum(F.when(F.col("layer") == layer, F.col("n")).otherwise(0)).alias(f"{layer}_rows")
            for layer in ("bronze", "silver", "quarantine")
        ]
    )
    return per_dataset.withColumn(
        "conserved", F.expr("silver_rows + quarantine_rows = bronze_rows")
    )


def tagged_counts(frames: Mapping[str, DataFrame], layer: str) -> DataFrame:
    """(dataset, layer, n), each frame counted on its own."""
    counts = [
        frame.agg(F.count("*").alias("n")).select(
            F.lit(dataset).alias("dataset"), F.lit(layer).alias("layer"), "n"
        )
        for dataset, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def overall_score(per_dataset: DataFrame) -> DataFrame:
    """Score over all datasets: sums divided, never scores averaged."""
    totals = per_dataset.agg(
        F.coalesce(F.sum("rows_received"), F.lit(0)).alias("rows_received"),
        F.coalesce(F.sum("rows_passed"), F.lit(0)).alias("rows_passed"),
    )
    return totals.withColumn("dq_score_pct", dq_score(F.col("rows_passed"), F.col("rows_received")))


def rejections(quarantine: Mapping[str, DataFrame]) -> DataFrame:
    """The reasons of all quarantined rows, whatever their source columns."""
    reasons = [frame.select("_dataset", IDS, COUNT) for frame in quarantine.values()]
    return reduce(DataFrame.unionByName, reasons)
