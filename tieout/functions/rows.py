"""One-row aggregates put next to each other, or laid out as rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def side_by_side(*rows: DataFrame) -> DataFrame:
    """The columns of several one-row frames in one row, without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def control_rows(measured: DataFrame, controls: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Turn one row of measurements into (control, expected, actual) rows."""
    rows = [
        F.struct(
            F.lit(name).alias("control"),
            expected.cast("bigint").alias("expected"),
            actual.cast("bigint").alias("actual"),
        )
        for name, (expected, actual) in controls.items()
    ]
    return measured.select(F.inline(F.array(*rows)))
