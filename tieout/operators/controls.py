"""Expected against observed counts, and failing loudly."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout.contract import DEFAULT, STATUSES, Contract
from tieout.functions.scores import dq_score
from tieout.operators.reconcile import edge_measures

VALUE = "decimal(24,4)"


class ControlFailure(RuntimeError):
    """A control did not hold; the tables must not be used."""


def require(controls: DataFrame, what: str, shown: int = 20) -> None:
    """Raise if a row of (control, expected, actual) fails; `metric` may name the control.

    The message has the number of all that failed, and details of `shown` of them.
    """
    name = "control" if "control" in controls.columns else "metric"
    failed = controls.where(~F.col("expected").eqNullSafe(F.col("actual")))
    first = failed.orderBy(name).take(shown)
    if first:
        total = len(first) if len(first) < shown else failed.count()
        notes = [f"{r[name]}: expected {r.expected}, found {r.actual}" for r in first]
        raise ControlFailure(f"{what}: {total} failed: " + "; ".join(notes))


def compare(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(metric, expected, actual, passed); a metric on one side only fails."""
    return expected.join(actual, "metric", "full_outer").select(
        "metric", "expected", "actual", F.col("expected").eqNullSafe(F.col("actual")).alias("passed")
    )


def failures(checks: DataFrame) -> DataFrame:
    return checks.where(~F.col("passed"))


def melt(row: DataFrame, metrics: dict[str, Column], value: str) -> DataFrame:
    """One row of numbers to (metric, value) rows."""
    pairs = [
        F.struct(F.lit(m).alias("metric"), c.cast(VALUE).alias(value)) for m, c in metrics.items()
    ]
    return row.select(F.inline(F.array(*pairs)))


# Where a control manifest keeps the expectation of a metric. The rest
# of its metrics are named by its own fields: rules, statuses.
MANIFEST = {
    "gl raw rows": "row_counts.gl_raw",
    "ap raw rows": "row_counts.ap_raw",
    "gl rows quarantined": "expected_quarantine.gl_rows",
    "ap rows quarantined": "expected_quarantine.ap_rows",
    "total rows quarantined": "expected_quarantine.total_rows",
    "total rule violations": "expected_quarantine.total_violations",
    "gl rows in silver": "row_counts.gl_after_quarantine",
    "ap rows in silver": "row_counts.ap_after_quarantine",
    "business keys": "expected_key_total",
    "keys with a known status": "expected_key_total",
    "dq score": "expected_dq_score_pct",
    "edge matched_within_tolerance": "expected_edge_cases.matched_within_tolerance",
    "edge mismatch_with_period_shift": "expected_edge_cases.amount_mismatch_with_period_shift",
    "edge duplicate_triplets": "expected_edge_cases.duplicate_triplets",
    "edge duplicate_unequal_amounts": "expected_edge_cases.duplicate_with_unequal_amounts",
}
NEVER = ("unknown statuses", "quarantined rows without a rule", "edge matched_beyond_tolerance")


def manifest_metrics(spark: SparkSession, path: str, contract: Contract = DEFAULT) -> DataFrame:
    """(metric, expected) of a load, from the JSON manifest delivered with it.

    A rule or status that the manifest does not list is expected never to occur.
    A total that it does not have is not expected, so its metric fails.
    """
    manifest = spark.read.option("multiLine", True).json(path)

    def fields(*parents: str) -> set[str]:
        schema = manifest.schema
        for parent in parents:
            if parent not in schema.fieldNames():
                return set()
            schema = schema[parent].dataType
        return set(schema.fieldNames())

    def listed(name: str, *parents: str) -> Column:
        return F.col(".".join([*parents, name])) if name in fields(*parents) else F.lit(0)

    totals = {m: at.split(".") for m, at in MANIFEST.items()}
    metrics = {
        **{m: F.col(".".join(at)) for m, at in totals.items() if at[-1] in fields(*at[:-1])},
        **{
            f"rule {r.id}": listed(r.id, "expected_quarantine", "by_rule", name)
            for name, d in contract.datasets.items()
            for r in d.active_rules
        },
        **{f"break {s}": listed(s, "expected_breaks") for s in STATUSES},
        **{m: F.lit(0) for m in NEVER},
    }
    return melt(manifest, metrics, "expected")


def observed_metrics(
    scorecard: DataFrame, rules: DataFrame, detail: DataFrame, rejections: DataFrame
) -> DataFrame:
    """The same metrics from the tables as published."""

    def of(dataset: str, column: str) -> Column:
        return F.sum(F.when(F.col("dataset") == dataset, F.col(column)).otherwise(0))

    counts = scorecard.agg(
        *[
            of(d, c).alias(f"{d}_{c}")
            for d in ("gl", "ap")
            for c in ("rows_received", "rows_passed", "rows_quarantined")
        ],
        F.sum("rows_received").alias("received"),
        F.sum("rows_passed").alias("passed"),
        F.sum("rows_quarantined").alias("quarantined"),
        F.sum("rule_violations").alias("violations"),
    )
    metrics = melt(
        counts,
        {
            "gl raw rows": F.col("gl_rows_received"),
            "ap raw rows": F.col("ap_rows_received"),
            "gl rows quarantined": F.col("gl_rows_quarantined"),
            "ap rows quarantined": F.col("ap_rows_quarantined"),
            "total rows quarantined": F.col("quarantined"),
            "total rule violations": F.col("violations"),
            "gl rows in silver": F.col("gl_rows_passed"),
            "ap rows in silver": F.col("ap_rows_passed"),
            "dq score": dq_score(F.col("passed"), F.col("received")),
        },
        "actual",
    )
    per_rule = rules.select(
        F.concat(F.lit("rule "), "rule_id").alias("metric"),
        F.col("rows_rejected").cast(VALUE).alias("actual"),
    )
    status = F.col("break_status")
    # All of the detail's metrics are one aggregate over one scan.
    keys = detail.agg(
        F.count("*").alias("keys"),
        F.count_if(~status.isin(*STATUSES)).alias("unknown"),
        *[F.count_if(status == s).alias(s) for s in STATUSES],
        *edge_measures(),
    )
    others = {"keys", "unknown", *STATUSES}
    per_status = melt(
        keys,
        {
            **{f"break {s}": F.col(s) for s in STATUSES},
            "business keys": F.col("keys"),
            "keys with a known status": sum((F.col(s) for s in STATUSES), F.lit(0)),
            "unknown statuses": F.col("unknown"),
            **{f"edge {c}": F.col(c) for c in keys.columns if c not in others},
        },
        "actual",
    )
    unexplained = melt(
        rejections.agg(F.count_if(F.col("_failed_rule_ids") == "").alias("n")),
        {"quarantined rows without a rule": F.col("n")},
        "actual",
    )
    parts = (per_rule, per_status, unexplained)
    return reduce(DataFrame.unionByName, parts, metrics)


def fate_vs_status(invoices: DataFrame, detail: DataFrame) -> DataFrame:
    """Planted fate against assigned status; `REJECTED` where no key arrived.

    Invoices are counted per key and fate before the join, so a key that many
    invoices share is one row of it.
    """
    planted = invoices.groupBy(
        F.col("account").alias("account_code"),
        F.col("vendor").alias("vendor_code"),
        F.col("invoice").alias("invoice_number"),
        F.col("f").alias("fate"),
    ).agg(F.count("*").alias("n"))
    key = ["account_code", "vendor_code", "invoice_number"]
    hashed = F.xxhash64(*key).alias("_hash")
    statuses = detail.select(hashed, *key, "break_status")
    return (
        planted.select(hashed, "*")
        .join(statuses, ["_hash", *key], "left")
        .groupBy("fate", F.coalesce("break_status", F.lit("REJECTED")).alias("break_status"))
        .agg(F.sum("n").alias("invoices"))
    )
