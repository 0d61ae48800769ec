"""Report queries over the published tables.

They filter, sort and total what the tables define and decide nothing new.
Listings are sorted down to a row's own identifiers: rows that tie cannot be
split between tasks, and most rejected rows share their reasons.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout import schemas
from tieout.contract import DUPLICATE_IN_SUBLEDGER, FISCAL_PERIOD, MATCHED, MISSING_FROM_GL
from tieout.functions.predicates import COUNT, IDS, whole_value
from tieout.functions.rows import side_by_side
from tieout.operators.refine import overall_score, rejections

WIDE = "decimal(38,2)"


def _sum(column: str):
    return F.sum(column).cast(WIDE)


# --- landed and rejected rows -------------------------------------------------


def peek(bronze: DataFrame, primary_key: str, rows: int = 10) -> DataFrame:
    return bronze.orderBy(primary_key).limit(rows)


def defect_scan(bronze_ap: DataFrame) -> DataFrame:
    """AP rows whose defects are visible to the eye, as received."""
    odd = (
        F.col("amount").isin("", "N/A")
        | (F.col("currency") != "USD")
        | ~F.col("fiscal_period").rlike(whole_value(FISCAL_PERIOD))
    )
    return (
        bronze_ap.where(odd)
        .select(
            "ap_line_id", "invoice_number", "amount", "currency", "fiscal_period", "payment_status"
        )
        .orderBy("ap_line_id", "invoice_number", "amount", "payment_status")
    )


def quarantine_listing(quarantine_ap: DataFrame) -> DataFrame:
    return quarantine_ap.select(
        IDS,
        COUNT,
        "ap_line_id",
        "invoice_number",
        "amount",
        "currency",
        "fiscal_period",
        "vendor_code",
        "payment_status",
    ).orderBy(F.desc(COUNT), IDS, "ap_line_id", "invoice_number", "vendor_code")


def rule_combinations(quarantine: Mapping[str, DataFrame]) -> DataFrame:
    return (
        rejections(quarantine)
        .groupBy(F.col(IDS).alias("rule_combination"))
        .agg(F.count("*").alias("rows_rejected"))
        .orderBy(F.desc("rows_rejected"))
    )


def multi_rule_rows(quarantine: Mapping[str, DataFrame]) -> DataFrame:
    return (
        rejections(quarantine)
        .groupBy(
            F.col("_dataset").alias("dataset"),
            F.col(IDS).alias("rules_breached"),
            F.col(COUNT).alias("rules_count"),
        )
        .agg(F.count("*").alias("rows"))
        .orderBy(F.desc("rules_count"), F.desc("rows"))
    )


# --- reconciliation -------------------------------------------------------------


def headline(detail: DataFrame, exceptions: DataFrame, scorecard: DataFrame) -> DataFrame:
    keys = detail.agg(F.count("*").alias("business_keys"))
    broken = exceptions.agg(
        F.count("*").alias("exceptions"), _sum("abs_amount_difference").alias("gross_exposure")
    )
    score = overall_score(scorecard).select("dq_score_pct")
    return side_by_side(keys, broken, score)


def break_mix(summary: DataFrame) -> DataFrame:
    return (
        summary.groupBy("break_status")
        .agg(F.sum("key_count").alias("keys"), _sum("abs_amount_difference").alias("gross_exposure"))
        .orderBy(F.desc("keys"))
    )


def break_mix_exceptions(summary: DataFrame) -> DataFrame:
    return break_mix(summary.where(F.col("break_status") != MATCHED))


def breaks_by_period(summary: DataFrame) -> DataFrame:
    return (
        summary.where(F.col("break_status") != MATCHED)
        .select(
            "fiscal_period",
            "break_status",
            "key_count",
            F.col("abs_amount_difference").alias("gross_exposure"),
        )
        .orderBy("fiscal_period", "break_status")
    )


def net_and_gross(summary: DataFrame, net: str) -> DataFrame:
    return summary.groupBy("break_status").agg(
        F.sum("key_count").alias("keys"),
        _sum("net_amount_difference").alias(net),
        _sum("abs_amount_difference").alias("gross_exposure"),
    )


def net_vs_gross(summary: DataFrame) -> DataFrame:
    broken = summary.where(F.col("break_status") != MATCHED)
    return net_and_gross(broken, "net_effect_on_books").orderBy(F.desc("gross_exposure"))


def break_mix_value(summary: DataFrame) -> DataFrame:
    return net_and_gross(summary, "net_difference").orderBy(F.desc("keys"))


def period_status_grid(summary: DataFrame) -> DataFrame:
    return summary.select(
        "fiscal_period", "break_status", "key_count", "abs_amount_difference"
    ).orderBy("fiscal_period", "break_status")


def unrecorded_by_period(summary: DataFrame) -> DataFrame:
    """Invoices in AP that the books do not show."""
    return (
        summary.where(F.col("break_status") == MISSING_FROM_GL)
        .select(
            "fiscal_period",
            F.col("key_count").alias("unrecorded_invoices"),
            F.col("abs_amount_difference").alias("unrecorded_liability"),
        )
        .orderBy("fiscal_period")
    )


def unrecorded_liability(summary: DataFrame) -> DataFrame:
    return unrecorded_by_period(summary).withColumn(
        "unrecorded_liability", F.round("unrecorded_liability", 2).cast(schemas.TOTAL)
    )


def period_filter(summary: DataFrame) -> DataFrame:
    return summary.select("fiscal_period").distinct().orderBy("fiscal_period")


def top_exceptions(exceptions: DataFrame, last_rank: int = 25) -> DataFrame:
    """The worklist; the rank is stored, so this is a pushed filter."""
    return (
        exceptions.where(F.col("exception_rank") <= last_rank)
        .select(
            "exception_rank",
            "break_status",
            "fiscal_period",
            "vendor_name",
            "account_name",
            "invoice_number",
            "gl_amount",
            "ap_amount",
            F.col("abs_amount_difference").alias("exposure"),
        )
        .orderBy("exception_rank")
    )


def duplicates(detail: DataFrame, with_gl_rows: bool = False) -> DataFrame:
    """Keys booked more than once in AP, and whether the copies agree.

    The comparison is NULL when there is no GL amount to compare with.
    """
    keys = ["invoice_number", "vendor_code", "account_code"]
    found = detail.where(F.col("break_status") == DUPLICATE_IN_SUBLEDGER)
    identical = F.col("ap_amount") == F.col("gl_amount") * F.col("ap_row_count")
    evidence = found.withColumn("copies_were_identical", identical).orderBy(
        F.desc("ap_row_count"), "copies_were_identical", F.desc("abs_amount_difference"), *keys
    )
    if with_gl_rows:
        return evidence.select(
            *keys,
            "gl_row_count",
            "ap_row_count",
            "gl_amount",
            "ap_amount",
            "amount_difference",
            "copies_were_identical",
        )
    return evidence.select(
        *keys,
        F.col("ap_row_count").alias("subledger_rows"),
        "gl_amount",
        "ap_amount",
        "copies_were_identical",
    )


def unrecorded_detail(exceptions: DataFrame) -> DataFrame:
    return (
        exceptions.where(F.col("break_status") == MISSING_FROM_GL)
        .orderBy(F.desc("ap_amount"), "invoice_number", "vendor_code", "account_code")
        .select("fiscal_period", "vendor_name", "invoice_number", "ap_amount", "gl_amount")
    )


# --- data quality ---------------------------------------------------------------


def dq_by_dataset(scorecard: DataFrame) -> DataFrame:
    return scorecard.select(*schemas.DQ_SCORECARD.fieldNames()).orderBy("dataset")


def most_violated(rules: DataFrame) -> DataFrame:
    return (
        rules.where(F.col("rows_rejected") > 0)
        .select("rule_id", "dataset", "column_name", "check_type", "rows_rejected")
        .orderBy(F.desc("rows_rejected"), "rule_id")
    )


def top_rules_with_predicate(rules: DataFrame) -> DataFrame:
    return (
        rules.where(F.col("rows_rejected") > 0)
        .select("rule_id", "dataset", "column_name", "check_type", "rows_rejected", "predicate_sql")
        .orderBy(F.desc("rows_rejected"), "rule_id")
    )


def rule_listing(rules: DataFrame) -> DataFrame:
    return rules.select(
        "rule_id",
        "dataset",
        "column_name",
        "check_type",
        "severity",
        "rows_rejected",
        "description",
        "predicate_sql",
    ).orderBy(F.desc("rows_rejected"), "dataset", "rule_id")


def silent_rules(rules: DataFrame) -> DataFrame:
    return rules.agg(F.count_if(F.col("rows_rejected") == 0).alias("rules_that_fired_zero_times"))
