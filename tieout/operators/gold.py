"""Published reconciliation tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout import schemas
from tieout.contract import BUSINESS_KEY, MATCHED, STATUSES, TOLERANCE
from tieout.functions.casts import conform
from tieout.functions.rows import control_rows, side_by_side
from tieout.operators.rank import global_rank
from tieout.operators.reconcile import recon_measures
from tieout.session import together
from tieout.sources.lakehouse import Scratch

UNLABELLED = "(unlabelled)"
CELL = ("key_count", "gl_amount", "ap_amount", "net_amount_difference", "abs_amount_difference")


def detail(recon: DataFrame) -> DataFrame:
    """One row per key, reported in the GL's period, else in AP's."""
    dated = recon.withColumn("fiscal_period", F.coalesce("gl_fiscal_period", "ap_fiscal_period"))
    return conform(dated, schemas.RECON_DETAIL, "recon_detail")


def summary(detail: DataFrame) -> DataFrame:
    """Every period by all six statuses, empty cells as zeros.

    The cells of a period are pivoted next to each other and laid out again,
    so that the grid is filled from one scan without a join.
    """
    zero = F.lit(0)
    cells = (
        detail.groupBy("fiscal_period")
        .pivot("break_status", list(STATUSES))
        .agg(
            F.count(F.lit(1)).alias("key_count"),
            F.sum(F.coalesce("gl_amount", zero)).alias("gl_amount"),
            F.sum(F.coalesce("ap_amount", zero)).alias("ap_amount"),
            F.sum("amount_difference").alias("net_amount_difference"),
            F.sum("abs_amount_difference").alias("abs_amount_difference"),
        )
    )
    rows = [
        F.struct(
            F.lit(status).alias("break_status"),
            *[
                F.coalesce(F.col(f"{status}_{c}"), zero)
                .cast(schemas.RECON_SUMMARY[c].dataType)
                .alias(c)
                for c in CELL
            ],
        )
        for status in STATUSES
    ]
    grid = cells.select("fiscal_period", F.inline(F.array(*rows)))
    return conform(grid, schemas.RECON_SUMMARY, "recon_summary")


def labels(df: DataFrame, code: str, label: str) -> DataFrame:
    """One label per code. min() is arbitrary, but the same on every run.

    Distinct pairs first: that combines by hashing, where min() of a string
    would sort all rows.
    """
    return df.select(code, label).distinct().groupBy(code).agg(F.min(label).alias(label))


def exposure_order() -> list:
    """Largest exposure first; the business key makes the order total."""
    return [
        F.desc("abs_amount_difference"),
        F.asc("account_code"),
        F.asc("vendor_code"),
        F.asc("invoice_number"),
    ]


def ranked_exceptions(detail: DataFrame, scratch: Scratch) -> DataFrame:
    unmatched = detail.where(F.col("break_status") != MATCHED)
    return global_rank(unmatched, exposure_order(), "exception_rank", scratch)


def exceptions(detail: DataFrame, gl: DataFrame, ap: DataFrame, scratch: Scratch) -> DataFrame:
    """Unmatched keys, ranked and labelled.

    Labels come from all silver rows, since a key missing from the GL has no GL
    row to take one from. A missing label never drops the key. Rows are ranked
    before they are labelled: cutting the ranges samples its input, which is
    then the bare scan of the detail. Rows leave in ranges of the rank, sorted, so
    that stored files hold disjoint ranges and a filter on the rank skips the rest.
    """
    accounts, vendors, ranked = together(
        lambda: scratch.keep(labels(gl, "account_code", "account_name"), "account-labels"),
        lambda: scratch.keep(labels(ap, "vendor_code", "vendor_name"), "vendor-labels"),
        lambda: ranked_exceptions(detail, scratch),
    )
    labelled = (
        ranked.join(accounts, "account_code", "left")
        .join(vendors, "vendor_code", "left")
        .withColumns(
            {
                "account_name": F.coalesce("account_name", F.lit(UNLABELLED)),
                "vendor_name": F.coalesce("vendor_name", F.lit(UNLABELLED)),
            }
        )
    )
    by_rank = labelled.repartitionByRange("exception_rank").sortWithinPartitions("exception_rank")
    return conform(by_rank, schemas.RECON_EXCEPTIONS, "recon_exceptions")


def gold_controls(detail: DataFrame, summary: DataFrame, exceptions: DataFrame) -> DataFrame:
    """(control, expected, actual) over the three tables as stored."""
    from_detail = detail.agg(
        F.count("*").alias("keys"), F.count_if(F.col("break_status") == MATCHED).alias("matched")
    )
    from_summary = summary.agg(F.coalesce(F.sum("key_count"), F.lit(0)).alias("summary_keys"))
    from_exceptions = exceptions.agg(
        F.count("*").alias("exception_rows"),
        F.coalesce(F.max("exception_rank"), F.lit(0)).alias("last_rank"),
    )
    measured = side_by_side(from_detail, from_summary, from_exceptions)
    unmatched = F.col("keys") - F.col("matched")
    return control_rows(
        measured,
        {
            "summary keys equal detail keys": (F.col("keys"), F.col("summary_keys")),
            "exceptions are keys less matched": (unmatched, F.col("exception_rows")),
            "ranks run to the number of exceptions": (
                F.col("exception_rows"),
                F.col("last_rank"),
            ),
        },
    )


CENTS = 100
TOTALS = ("gl_amount", "ap_amount", "abs_amount_difference")


def measures(key: Sequence[str] = BUSINESS_KEY, tolerance: Decimal = TOLERANCE) -> list[Column]:
    """Aggregates over the detail, observed while it is written and compared later."""
    zero = F.lit(0)
    sums = [F.sum(F.coalesce(c, zero)).alias(f"total_{c}") for c in TOTALS]
    return [*recon_measures(key, tolerance), *sums]


def measured(detail: DataFrame) -> DataFrame:
    """The same in a pass of its own; `pipeline.publish` observes them."""
    return detail.agg(*measures())


def as_row(spark: SparkSession, observed: Mapping[str, object]) -> DataFrame:
    """Observed aggregates as a frame of one row; NULL totals of an empty table are zeros."""
    types = ", ".join(
        f"`{name}` {schemas.TOTAL.simpleString() if name.startswith('total_') else 'bigint'}"
        for name in observed
    )
    values = [Decimal(v or 0) if n.startswith("total_") else v or 0 for n, v in observed.items()]
    return spark.createDataFrame([tuple(values)], types)


def stored_control(measured: DataFrame, detail: DataFrame) -> DataFrame:
    """(control, expected, actual): keys observed in writing the detail, keys it holds."""
    rows = side_by_side(measured.select("n"), detail.agg(F.count("*").alias("stored")))
    return control_rows(rows, {"keys stored are keys written": (F.col("n"), F.col("stored"))})


def published_controls(measured: DataFrame, summary: DataFrame, exceptions: DataFrame) -> DataFrame:
    """(control, expected, actual): what was written to the detail against what was made of it.

    The summary is an aggregate of the stored detail, so a detail that lost or changed
    rows on the way to storage gives other counts or totals than were observed. The two
    other tables are read as stored, one column of the exceptions.
    """
    status = F.col("break_status")
    from_summary = summary.agg(
        *[
            F.coalesce(F.sum(F.when(status == s, F.col("key_count"))), F.lit(0)).alias(f"summary_{s}")
            for s in STATUSES
        ],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"summary_{c}") for c in TOTALS],
    )
    from_exceptions = exceptions.agg(
        F.count("*").alias("exception_rows"),
        F.coalesce(F.max("exception_rank"), F.lit(0)).alias("last_rank"),
    )
    rows = side_by_side(measured, from_summary, from_exceptions)
    summary_keys = sum((F.col(f"summary_{s}") for s in STATUSES), F.lit(0))
    return control_rows(
        rows,
        {
            "summary keys equal detail keys": (F.col("n"), summary_keys),
            **{f"summary keys of {s}": (F.col(s), F.col(f"summary_{s}")) for s in STATUSES},
            **{
                f"summary total of {c}": (F.col(f"total_{c}") * CENTS, F.col(f"summary_{c}") * CENTS)
                for c in TOTALS
            },
            "exceptions are keys less matched": (F.col("unmatched"), F.col("exception_rows")),
            "ranks run to the number of exceptions": (F.col("exception_rows"), F.col("last_rank")),
        },
    )
