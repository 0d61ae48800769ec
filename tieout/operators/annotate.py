"""Evaluating a contract on every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.contract import Rule
from tieout.functions.predicates import (
    COUNT,
    IDS,
    breached,
    failed_count,
    failed_ids,
)
from tieout.operators.uniqueness import attach_copies
from tieout.sources.lakehouse import Scratch


def annotate(
    df: DataFrame, rules: Sequence[Rule], scratch: Scratch, **lookup: int
) -> DataFrame:
    """Every row with the ids of the rules it breached; '' and 0 when clean.

    The ids come out of a generator of one row. A filter on a projected
    column would be pushed below it, and its copy of all rules makes a method
    too large for the JIT; nothing is pushed below a generator's output, so the
    rules are evaluated once per row. They are projected below the generator, where
    what rules share (is the column blank, its number) is evaluated once for all.
    `lookup` goes to `attach_copies`.
    """
    rules = active(rules)
    columns = df.columns
    found = attach_copies(df, rules, scratch, **lookup).select(*columns, failed_ids(rules).alias("_found"))
    checked = found.select(*columns, F.stack(F.lit(1), "_found").alias(IDS))
    return checked.withColumn(COUNT, failed_count())


def clean(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col(IDS) == "")


def rejected(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col(IDS) != "")


def flags(
    df: DataFrame, rules: Sequence[Rule], scratch: Scratch, keep: Sequence[str] = ()
) -> DataFrame:
    """One boolean per rule, after the columns to keep."""
    rules = active(rules)
    checked = attach_copies(df, rules, scratch)
    return checked.select(*keep, *[breached(r).alias(f"flag_{r.id}") for r in rules])


def violation_counts(df: DataFrame, rules: Sequence[Rule], scratch: Scratch) -> DataFrame:
    """(rule_id, violations) for every rule, silent ones with 0, in one pass."""
    rules = active(rules)
    counted = flags(df, rules, scratch).agg(
        *[F.count_if(F.col(f"flag_{r.id}")).alias(r.id) for r in rules]
    )
    pairs = [
        F.struct(F.lit(r.id).alias("rule_id"), F.col(r.id).alias("violations")) for r in rules
    ]
    return counted.select(F.inline(F.array(*pairs)))


def breaches(
    df: DataFrame, rules: Sequence[Rule], check: str, primary_key: str, scratch: Scratch
) -> DataFrame:
    """(rule_id, row_id, value) of every row breaching a rule of one check type."""
    rules = [r for r in active(rules) if r.check == check]
    hits = [
        F.when(
            breached(r),
            F.struct(
                F.lit(r.id).alias("rule_id"),
                F.col(primary_key).alias("row_id"),
                F.col(r.column).alias("value"),
            ),
        )
        for r in rules
    ]
    checked = attach_copies(df, rules, scratch)
    return checked.select(F.inline(F.array_compact(F.array(*hits))))


def active(rules: Sequence[Rule]) -> list[Rule]:
    return sorted((r for r in rules if r.severity == "reject"), key=lambda r: r.id)


