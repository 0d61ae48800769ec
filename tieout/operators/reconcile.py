"""Two ledgers to one classified row per business key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout import schemas
from tieout.contract import (
    AMOUNT_MISMATCH,
    BUSINESS_KEY,
    DUPLICATE_IN_SUBLEDGER,
    MATCHED,
    MISSING_FROM_GL,
    MISSING_FROM_SUBLEDGER,
    PRECEDENCE,
    STATUSES,
    TIMING_DIFFERENCE,
    TOLERANCE,
    check_precedence,
)
from tieout.functions import periods
from tieout.functions.rows import control_rows
from tieout.operators.membership import MOST_BROADCAST, filter_rows, parted, words_for
from tieout.sources.lakehouse import Scratch


def aggregate_side(
    df: DataFrame, key: Sequence[str], side: str, checked_periods: bool = False
) -> DataFrame:
    """One row per key: total, earliest period, number of rows.

    Aggregating before matching keeps repeated rows from multiplying, and the
    row count is the only evidence that they existed. `checked_periods` says
    that all periods are written yyyy-mm, which spares a sort.
    """
    period, restored = _period(checked_periods)
    grouped = df.groupBy(*key).agg(
        F.sum("amount").cast(schemas.TOTAL).alias(f"{side}_amount"),
        F.min(period).alias("_period"),
        F.count("*").alias(f"{side}_row_count"),
    )
    return grouped.select(
        *key,
        f"{side}_amount",
        restored(F.col("_period")).alias(f"{side}_fiscal_period"),
        f"{side}_row_count",
    )


def match_sides(gl: DataFrame, ap: DataFrame, key: Sequence[str]) -> DataFrame:
    """Full outer join of aggregated sides: a key on one side only is a finding.

    Both are already hash-partitioned by the key, so the join adds no exchange.
    """
    return gl.join(ap, list(key), "full_outer")


def tie_sides(
    gl: DataFrame, ap: DataFrame, key: Sequence[str], checked_periods: bool = False
) -> DataFrame:
    """What `match_sides` gives for the two aggregated sides, in one aggregation.

    The rows of both ledgers are stacked with their values in columns of their
    own side and grouped once: one shuffle, combined on the map side, and no
    sort or join. It differs from the join in one point, that NULL keys of the
    two sides meet; contracts require keys, and `recon_controls` counts NULLs.
    """
    period, restored = _period(checked_periods)

    def stacked(df: DataFrame, from_gl: bool) -> DataFrame:
        return df.select(*key, "amount", period.alias("_period"), F.lit(from_gl).alias("_gl"))

    is_gl = F.col("_gl")
    values = {"gl": is_gl, "ap": ~is_gl}
    grouped = (
        stacked(gl, True)
        .unionByName(stacked(ap, False))
        .groupBy(*key)
        .agg(
            *[
                measure
                for side, own in values.items()
                for measure in (
                    F.sum(F.when(own, F.col("amount"))).cast(schemas.TOTAL).alias(f"{side}_amount"),
                    F.min(F.when(own, F.col("_period"))).alias(f"_{side}_period"),
                    F.count_if(own).alias(f"{side}_row_count"),
                )
            ]
        )
    )
    return grouped.select(
        *key,
        *[
            column
            for side in values
            for column in (
                f"{side}_amount",
                restored(F.col(f"_{side}_period")).alias(f"{side}_fiscal_period"),
                f"{side}_row_count",
            )
        ],
    )


def _period(checked: bool) -> tuple[Column, Callable[[Column], Column]]:
    """How to compare periods, and how to get the text back."""
    text = F.col("fiscal_period")
    if checked:
        return periods.to_number(text), periods.to_text
    return text, lambda period: period


def with_differences(matched: DataFrame) -> DataFrame:
    """Row counts of absent sides become 0; their amounts stay NULL."""
    zero = F.lit(Decimal("0.00"))
    difference = F.coalesce("gl_amount", zero) - F.coalesce("ap_amount", zero)
    return matched.withColumns(
        {
            "gl_row_count": F.coalesce("gl_row_count", F.lit(0)),
            "ap_row_count": F.coalesce("ap_row_count", F.lit(0)),
            "amount_difference": difference.cast(schemas.TOTAL),
            "abs_amount_difference": F.abs(difference).cast(schemas.TOTAL),
        }
    )


def break_status(tolerance: Decimal = TOLERANCE) -> Column:
    """The ladder; each rung may assume that those above it did not apply.

    The period rung needs no NULL handling because one-sided keys are gone by
    then. The tolerance is a decimal and inclusive.
    """
    gl_rows, ap_rows = F.col("gl_row_count"), F.col("ap_row_count")
    allowed = F.lit(Decimal(tolerance)).cast(schemas.MONEY)
    applies = {
        DUPLICATE_IN_SUBLEDGER: ap_rows > 1,
        MISSING_FROM_SUBLEDGER: (gl_rows > 0) & (ap_rows == 0),
        MISSING_FROM_GL: (ap_rows > 0) & (gl_rows == 0),
        AMOUNT_MISMATCH: F.col("abs_amount_difference") > allowed,
        TIMING_DIFFERENCE: F.col("gl_fiscal_period") != F.col("ap_fiscal_period"),
    }
    # The declared order is the order of evaluation; what is left over is matched.
    rungs = [F.when(applies[s], F.lit(s)) for s in PRECEDENCE if s in applies]
    return F.coalesce(*rungs, F.lit(MATCHED))


def reconcile(
    gl: DataFrame,
    ap: DataFrame,
    key: Sequence[str] = BUSINESS_KEY,
    tolerance: Decimal = TOLERANCE,
    precedence: Sequence[str] = PRECEDENCE,
    checked_periods: bool = False,
) -> DataFrame:
    check_precedence(precedence)
    matched = tie_sides(gl, ap, key, checked_periods)
    return with_differences(matched).withColumn("break_status", break_status(tolerance))


def status_domain(spark: SparkSession) -> DataFrame:
    listed = F.array(*[F.lit(s) for s in STATUSES])
    return spark.range(1).select(F.explode(listed).alias("break_status"))


def status_counts(recon: DataFrame) -> DataFrame:
    """(break_status, key_count), all six listed; a foreign status raises.

    Grouped first, so the join is between two handfuls of rows.
    """
    observed = recon.groupBy("break_status").agg(F.count("*").alias("observed"))
    known = F.col("known").isNotNull()
    domain = status_domain(recon.sparkSession).withColumn("known", F.lit(True))
    foreign = F.raise_error(F.concat(F.lit("unknown break status: "), "break_status"))
    return domain.join(observed, "break_status", "full_outer").select(
        F.when(known, F.col("break_status")).otherwise(foreign).alias("break_status"),
        F.coalesce("observed", F.lit(0)).alias("key_count"),
    )


def recon_measures(
    key: Sequence[str] = BUSINESS_KEY, tolerance: Decimal = TOLERANCE
) -> list[Column]:
    """Aggregates over the detail that its controls compare."""
    status = F.col("break_status")
    key_lost = F.lit(False)
    for column in key:
        key_lost = key_lost | F.col(column).isNull()
    beyond = F.col("abs_amount_difference") > F.lit(Decimal(tolerance)).cast(schemas.MONEY)
    return [
        F.count("*").alias("n"),
        F.count_if(key_lost).alias("key_lost"),
        *[F.count_if(status == s).alias(s) for s in STATUSES],
        F.count_if(status != MATCHED).alias("unmatched"),
        F.count_if((status == MATCHED) & beyond).alias("beyond"),
    ]


def measured_controls(measured: DataFrame) -> DataFrame:
    """(control, expected, actual) of one row of `recon_measures`."""
    classified = sum((F.col(s) for s in STATUSES), F.lit(0))
    return control_rows(
        measured,
        {
            "keys with a null part": (F.lit(0), F.col("key_lost")),
            "statuses form a partition": (F.col("n"), classified),
            "exceptions are keys less matched": (F.col("n") - F.col(MATCHED), F.col("unmatched")),
            "matched beyond tolerance": (F.lit(0), F.col("beyond")),
        },
    )


def recon_controls(
    recon: DataFrame, key: Sequence[str] = BUSINESS_KEY, tolerance: Decimal = TOLERANCE
) -> DataFrame:
    """(control, expected, actual): whole keys, one status each, tolerance kept."""
    return measured_controls(recon.agg(*recon_measures(key, tolerance)))


def edge_measures() -> list[Column]:
    """Sizes of populations that only a right ladder puts in the right place."""
    status = F.col("break_status")
    shifted = F.col("gl_fiscal_period") != F.col("ap_fiscal_period")
    honest = F.col("ap_amount") == F.col("gl_amount") * F.col("ap_row_count")
    duplicate = status == DUPLICATE_IN_SUBLEDGER
    difference = F.col("abs_amount_difference")
    counted = {
        "matched_within_tolerance": (status == MATCHED) & (difference > 0),
        "mismatch_with_period_shift": (status == AMOUNT_MISMATCH) & shifted,
        "duplicate_triplets": duplicate & (F.col("ap_row_count") == 3),
        "duplicate_unequal_amounts": duplicate & ~honest,
        "matched_beyond_tolerance": (status == MATCHED) & (difference > TOLERANCE),
    }
    return [F.count_if(held).alias(population) for population, held in counted.items()]


def edge_cases(detail: DataFrame) -> DataFrame:
    return detail.agg(*edge_measures())


def opposite_side_rejections(
    rejected: DataFrame,
    opposite: DataFrame,
    scratch: Scratch,
    key: Sequence[str] = BUSINESS_KEY,
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """One row: rejected rows in all, and those whose key the other side holds.

    Rejected rows are counted per key first, so a key with very many of them is
    one row. That lookup is written: while small it is broadcast to the scan of
    the other side, which then is not shuffled at all. Beyond that rows of the
    other side first go through a filter of the rejected keys, so that few are.
    """
    key = list(key)
    counted = rejected.groupBy(*key).agg(F.count("*").alias("n"))
    per_key = scratch.keep(counted, "rejected-keys")
    candidates, how, n_keys = opposite.select(*key), "left_semi", per_key.count()
    if n_keys > most_broadcast:
        words = words_for(n_keys)
        filter_ = scratch.keep(filter_rows(per_key, key, words), "filter-rejected-keys")
        candidates, _ = parted(candidates, filter_, key, words)
        # A semi join would be pushed below the filter. Keys are unique, so this is the same.
        how = "inner"
    held = candidates.join(per_key.select(*key), key, how).distinct()
    return per_key.join(held.withColumn("held", F.lit(True)), key, "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rejected_rows"),
        F.coalesce(F.sum(F.when(F.col("held"), F.col("n"))), F.lit(0)).alias(
            "rows_on_opposite_side"
        ),
    )


def repeated_keys(df: DataFrame, key: Sequence[str] = BUSINESS_KEY) -> DataFrame:
    """Business keys held by more than one row of one side."""
    return df.groupBy(*key).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)
