"""The jobs: land, refine, publish, score. Each reads and writes whole tables.

Tables are replaced only after the controls of a job held.

Counts that decide whether a job succeeded are read back from storage, or observed in
the tasks that write and held against what is read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tieout import schemas
from tieout.contract import DEFAULT, Contract
from tieout.operators import gold, scorecard
from tieout.operators.annotate import annotate, clean, rejected
from tieout.operators.controls import ControlFailure, require
from tieout.operators.reconcile import measured_controls, reconcile
from tieout.operators.refine import conservation, losses, to_quarantine, with_types
from tieout.session import together
from tieout.sources.extracts import (
    MALFORMED,
    completeness,
    read_extract,
    rejected_lines,
    to_bronze,
    with_lineage,
)
from tieout.sources.lakehouse import Lakehouse


def tables(lake: Lakehouse, layer: str, contract: Contract = DEFAULT) -> dict[str, DataFrame]:
    return {name: lake.read(layer, d.table) for name, d in contract.datasets.items()}


def land_extracts(
    lake: Lakehouse,
    paths: Mapping[str, str],
    contract: Contract = DEFAULT,
    batch_id: str | None = None,
    multi_line: bool = False,
    escape: str = "\\",
    most_rejected: int = 0,
) -> str:
    """CSV files to bronze, losing no row.

    Up to `most_rejected` lines of a dataset that are no rows are stored as rejected
    lines, with file, offset and reason; landing stops if there are more. In any case
    rows and rejected lines together are the lines of the files.
    """
    contract.validate()
    batch_id = batch_id or uuid.uuid4().hex
    lake.create_layers()
    with lake.staged() as stage:

        def land(dataset: str, path: str) -> None:
            source, table = schemas.SOURCES[dataset], contract.datasets[dataset].table
            extract = read_extract(stage.spark, path, source, dataset, multi_line, escape)
            malformed = Observation(f"{dataset}-malformed-lines")
            counted = extract.observe(malformed, F.count_if(F.col(MALFORMED).isNotNull()).alias("lines"))
            if most_rejected:
                # Not pushed below the count.
                counted = counted.where(F.col(MALFORMED).isNull())
            landed = stage.write(to_bronze(with_lineage(counted, batch_id), dataset), "bronze", table)
            if malformed.get["lines"] > most_rejected:
                raise ControlFailure(
                    f"landing {dataset}: {malformed.get['lines']} lines have too few or too many cells"
                )
            rejected = None
            if most_rejected:
                # Kept with all columns: the reader tells malformed lines by reading all.
                lines = stage.scratch().keep(extract.where(F.col(MALFORMED).isNotNull()), "malformed")
                lines = lines.select(F.col("_source_file").alias("file"), F.col(MALFORMED).alias("line"))
                rejected = stage.write(
                    rejected_lines(stage.spark, path, lines, dataset, batch_id, multi_line),
                    "bronze",
                    f"{table}_rejected",
                )
                n = rejected.count()
                if n > most_rejected:
                    raise ControlFailure(f"landing {dataset}: {n} lines rejected, at most {most_rejected} may be")
            counts = completeness(stage.spark, path, landed, dataset, multi_line, escape, rejected)
            require(
                counts.select(
                    F.concat(F.lit("rows of "), "dataset").alias("control"),
                    F.col("source_rows").alias("expected"),
                    F.col("bronze_rows").alias("actual"),
                ),
                "landing",
            )

        together(*[partial(land, dataset, path) for dataset, path in paths.items()])
    return batch_id


def land_frames(
    lake: Lakehouse,
    frames: Mapping[str, DataFrame],
    source: str,
    contract: Contract = DEFAULT,
    batch_id: str | None = None,
) -> str:
    """Rows already in Spark to bronze; `source` is recorded as their file."""
    contract.validate()
    batch_id = batch_id or uuid.uuid4().hex
    lake.create_layers()
    with lake.staged() as stage:

        def land(dataset: str, frame: DataFrame) -> None:
            landed = with_lineage(frame, batch_id, source)
            stage.write(to_bronze(landed, dataset), "bronze", contract.datasets[dataset].table)

        together(*[partial(land, dataset, frame) for dataset, frame in frames.items()])
    return batch_id


def refine(lake: Lakehouse, contract: Contract = DEFAULT) -> None:
    """Bronze to silver and quarantine.

    The annotated rows are evaluated once for each of the two tables: a second
    scan costs less than storing the whole annotated input in between. The
    lookup of repeated ids, the part that shuffles, is computed once. Values
    lost in typing are counted while silver is written.
    """
    contract.validate()
    lake.create_layers()
    with lake.staged() as stage:

        def split(name: str) -> None:
            dataset, source = contract.datasets[name], schemas.SOURCES[name]
            checked = annotate(stage.read("bronze", dataset.table), dataset.rules, stage.scratch())
            silver = schemas.silver(source)
            lost = Observation(f"{name}-values-lost")
            counted = with_types(clean(checked), silver).observe(lost, *losses(silver))
            reasons = to_quarantine(rejected(checked), name, schemas.quarantine(source))
            together(
                lambda: stage.write(counted, "silver", dataset.table),
                lambda: stage.write(reasons, "quarantine", dataset.table),
            )
            if any(lost.get.values()):
                raise ControlFailure(f"typing {name} lost values: {lost.get}")

        together(*[partial(split, name) for name in contract.datasets])
        layers = [tables(stage, layer, contract) for layer in ("bronze", "silver", "quarantine")]
        require(
            conservation(*layers).select(
                F.concat(F.lit("rows of "), "dataset").alias("control"),
                F.col("bronze_rows").alias("expected"),
                F.expr("silver_rows + quarantine_rows").alias("actual"),
            ),
            "row conservation",
        )


def publish(lake: Lakehouse, contract: Contract = DEFAULT) -> None:
    """Silver to the three reconciliation tables, which become current together.

    The detail is stored once and everything after reads it. It is laid out by
    status, so that the exceptions skip the matched keys. What its controls need is
    observed while it is written and held against the tables made of what was stored.
    """
    contract.validate()
    lake.create_layers()
    with lake.staged() as stage:
        present_detail(stage, tie_detail(stage, contract), contract)


def tie(lake: Lakehouse, contract: Contract = DEFAULT) -> DataFrame:
    """The first half of `publish` as a job of its own: the detail alone.

    Returns what was observed of it, which `present` holds against its tables.
    """
    contract.validate()
    lake.create_layers()
    with lake.staged() as stage:
        return tie_detail(stage, contract)


def present(lake: Lakehouse, observed: DataFrame, contract: Contract = DEFAULT) -> None:
    """The second half: the summary and the exceptions of a detail that `tie` stored."""
    contract.validate()
    lake.create_layers()
    with lake.staged() as stage:
        present_detail(stage, observed, contract)


def tie_detail(stage: Lakehouse, contract: Contract) -> DataFrame:
    silver = tables(stage, "silver", contract)
    recon = reconcile(
        silver["gl"],
        silver["ap"],
        contract.business_key,
        contract.tolerance,
        contract.precedence,
        contract.checks_periods,
    )
    # Rebalanced, or every task would write a file per status. Counted after that, in
    # the tasks that write, which count once each even if executors are lost.
    observed = Observation("recon-detail")
    detail = stage.write(
        gold.detail(recon)
        .hint("rebalance", "break_status")
        .observe(observed, *gold.measures(contract.business_key, contract.tolerance)),
        "gold",
        "recon_detail",
        partition_by=["break_status"],
    )
    measured = gold.as_row(stage.spark, observed.get)
    require(measured_controls(measured), "reconciliation")
    require(gold.stored_control(measured, detail), "reconciliation as stored")
    return measured


def present_detail(stage: Lakehouse, measured: DataFrame, contract: Contract) -> None:
    detail, silver = stage.read("gold", "recon_detail"), tables(stage, "silver", contract)

    def rank() -> DataFrame:
        ranked = gold.exceptions(detail, silver["gl"], silver["ap"], stage.scratch())
        return stage.write(ranked, "gold", "recon_exceptions")

    summary, exceptions = together(
        lambda: stage.write(gold.summary(detail), "gold", "recon_summary"), rank
    )
    require(gold.published_controls(measured, summary, exceptions), "gold")


def score(lake: Lakehouse, contract: Contract = DEFAULT) -> None:
    """Stored counts and recorded reasons to the two scorecards."""
    contract.validate()
    lake.create_layers()
    with lake.staged() as stage:
        bronze, silver, quarantine = (
            tables(stage, layer, contract) for layer in ("bronze", "silver", "quarantine")
        )
        rules = scorecard.rule_scorecard(
            scorecard.rule_catalogue(stage.spark, contract), scorecard.rule_violations(quarantine)
        )
        per_dataset = scorecard.scorecard(contract, bronze, silver, quarantine)
        stored, _ = together(
            lambda: stage.write(per_dataset, "gold", "dq_scorecard"),
            lambda: stage.write(rules, "gold", "dq_rule_scorecard"),
        )
        require(scorecard.conservation_control(stored), "scorecard")


def run(lake: Lakehouse, paths: Mapping[str, str], contract: Contract = DEFAULT) -> None:
    """Everything, from CSV extracts to scorecards."""
    land_extracts(lake, paths, contract)
    refine(lake, contract)
    publish(lake, contract)
    score(lake, contract)
