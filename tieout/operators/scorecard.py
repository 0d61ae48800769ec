"""Data-quality scorecards, per dataset and per rule."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout import schemas
from tieout.contract import Contract
from tieout.functions.casts import conform
from tieout.functions.predicates import COUNT, predicate, split_ids
from tieout.functions.rows import control_rows
from tieout.functions.scores import dq_score
from tieout.operators.refine import rejections, tagged_counts


def rule_catalogue(spark: SparkSession, contract: Contract) -> DataFrame:
    """Every evaluated rule with the expression evaluated, silent ones too."""
    rows = [
        (r.id, name, r.column, r.check, r.severity, r.description, predicate(r))
        for name in sorted(contract.datasets)
        for r in contract.datasets[name].active_rules
    ]
    return spark.createDataFrame(rows, schemas.RULE_CATALOGUE)


def rule_violations(quarantine: Mapping[str, DataFrame]) -> DataFrame:
    """(rule_id, rows_rejected) from the ids recorded on the rejected rows."""
    ids = rejections(quarantine).select(F.explode(split_ids()).alias("rule_id"))
    return ids.groupBy("rule_id").agg(F.count("*").alias("rows_rejected"))


def rule_scorecard(catalogue: DataFrame, violations: DataFrame) -> DataFrame:
    """The catalogue with its counts, 0 for rules that never fired.

    Both sides have at most one row per declared rule.
    """
    scored = catalogue.join(violations, "rule_id", "left").withColumn(
        "rows_rejected", F.coalesce("rows_rejected", F.lit(0))
    )
    return conform(scored, schemas.DQ_RULE_SCORECARD, "dq_rule_scorecard")


def scorecard(
    contract: Contract,
    bronze: Mapping[str, DataFrame],
    silver: Mapping[str, DataFrame],
    quarantine: Mapping[str, DataFrame],
) -> DataFrame:
    """Per dataset, counted from the tables as stored."""
    counts = tagged_counts(bronze, "bronze").unionByName(tagged_counts(silver, "silver"))
    for dataset, frame in quarantine.items():
        measured = frame.agg(
            F.count("*").alias("quarantine"),
            F.coalesce(F.sum(COUNT), F.lit(0)).alias("violations"),
        ).select(
            F.lit(dataset).alias("dataset"),
            F.inline(
                F.array(
                    F.struct(F.lit("quarantine").alias("layer"), F.col("quarantine").alias("n")),
                    F.struct(F.lit("violations").alias("layer"), F.col("violations").alias("n")),
                )
            ),
        )
        counts = counts.unionByName(measured)
    columns = {
        "bronze": "rows_received",
        "silver": "rows_passed",
        "quarantine": "rows_quarantined",
        "violations": "rule_violations",
    }
    per_dataset = counts.groupBy("dataset").agg(
        *[
            F.sum(F.when(F.col("layer") == layer, F.col("n")).otherwise(0)).alias(column)
            for layer, column in columns.items()
        ]
    )
    names = F.create_map(
        *[F.lit(x) for d in contract.datasets.values() for x in (d.name, d.label)]
    )
    scored = per_dataset.withColumns(
        {
            "label": names[F.col("dataset")],
            "dq_score_pct": dq_score(F.col("rows_passed"), F.col("rows_received")),
        }
    )
    return conform(scored, schemas.DQ_SCORECARD, "dq_scorecard")


def conservation_control(scorecard: DataFrame) -> DataFrame:
    """(control, expected, actual): passed and quarantined make up received."""
    totals = scorecard.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("rows_received", "rows_passed", "rows_quarantined")
        ]
    )
    return control_rows(
        totals,
        {
            "passed and quarantined make up received": (
                F.col("rows_received"),
                F.col("rows_passed") + F.col("rows_quarantined"),
            )
        },
    )
