"""Every operator and report as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout import schemas
from tieout.contract import BUSINESS_KEY, CHECKS
from tieout.operators import annotate as contract_checks
from tieout.operators import controls, gold, reconcile, refine, reports, scorecard
from tieout.plans.expectations import expected_metrics
from tieout.plans.workspace import BATCH, Workspace, workspace
from tieout.session import run_folder, together
from tieout.sources import extracts

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def query(name: str):
    """Register a function of a workspace under a query name."""

    def register(build: Callable[[Workspace], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(workspace(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        _queries[name] = run
        return build

    return register


def per_dataset(prefix: str):
    """Register a function of (workspace, dataset) once for GL and once for AP."""

    def register(build: Callable[[Workspace, str], DataFrame]):
        for dataset in ("gl", "ap"):
            query(f"{prefix}_{dataset}")(lambda w, d=dataset: build(w, d))
        return build

    return register


def each(w: Workspace, build: Callable[[str], DataFrame]) -> DataFrame:
    """The rows of every dataset; lookups that a build writes are written together."""
    frames = together(*[partial(build, dataset) for dataset in w.contract.datasets])
    return reduce(DataFrame.unionByName, frames)


def queries() -> dict[str, Query]:
    return dict(_queries)


def _source_columns(dataset: str) -> list[str]:
    return schemas.SOURCES[dataset].fieldNames()


# --- landing --------------------------------------------------------------------


def _extract(w: Workspace, dataset: str) -> tuple[str, DataFrame]:
    """The dataset written as CSV files and read back through the extract reader."""
    if dataset not in w.extracts:
        path = f"{run_folder(w.spark)}/{dataset}"
        extracts.write_extract(w.source(dataset), path)
        w.extracts[dataset] = path
    path, source = w.extracts[dataset], schemas.SOURCES[dataset]
    return path, extracts.read_extract(w.spark, path, source, dataset)


@per_dataset("csv_roundtrip")
def _csv_roundtrip(w, dataset):
    return _extract(w, dataset)[1].select(*_source_columns(dataset))


@query("bronze_lineage")
def _bronze_lineage(w):
    """Lineage of rows landed from files; of the path, the folder is shown."""

    def rows(dataset):
        landed = extracts.with_lineage(_extract(w, dataset)[1], BATCH)
        return extracts.to_bronze(landed, dataset).select(
            F.col(w.primary_key(dataset)).alias("row_id"),
            F.regexp_extract("_source_file", "([^/]+)/[^/]+$", 1).alias("source_folder"),
            "_batch_id",
        )

    return each(w, rows)


@per_dataset("bronze")
def _bronze(w, dataset):
    landed = extracts.with_lineage(w.source(dataset), BATCH, w.sf_dir)
    return extracts.to_bronze(landed, dataset).drop("_ingested_at", "_source_file")


@query("ingest_completeness")
def _ingest_completeness(w):
    def counts(dataset):
        path, rows = _extract(w, dataset)
        return extracts.completeness(w.spark, path, rows, dataset)

    return each(w, counts)


@query("bronze_peek")
def _bronze_peek(w):
    return reports.peek(w.bronze("gl").select(*_source_columns("gl")), "gl_entry_id")


@query("bronze_defect_scan")
def _bronze_defect_scan(w):
    return reports.defect_scan(w.bronze("ap"))


# --- contract checks --------------------------------------------------------------


def _check(kind: str):
    @query(f"check_{kind}")
    def _rows(w):
        w.land()

        def rows(dataset):
            return contract_checks.breaches(
                w.bronze(dataset), w.rules(dataset), kind, w.primary_key(dataset), w.scratch()
            ).select(F.lit(dataset).alias("dataset"), "*")

        return each(w, rows)


for _kind in CHECKS:
    _check(_kind)


def _annotated(w: Workspace, dataset: str) -> DataFrame:
    return contract_checks.annotate(w.bronze(dataset), w.rules(dataset), w.scratch())


def _ids_of_all(w: Workspace, column: str) -> DataFrame:
    w.land()

    def rows(dataset):
        return _annotated(w, dataset).select(
            F.lit(dataset).alias("dataset"),
            F.col(w.primary_key(dataset)).alias("row_id"),
            "invoice_number",
            column,
        )

    return each(w, rows)


@query("failed_rule_ids")
def _failed_rule_ids(w):
    return _ids_of_all(w, "_failed_rule_ids")


@query("failed_rule_count")
def _failed_rule_count(w):
    return _ids_of_all(w, "_failed_rule_count")


@per_dataset("rule_flags")
def _rule_flags(w, dataset):
    """A flag per rule for every row."""
    return contract_checks.flags(
        w.bronze(dataset), w.rules(dataset), w.scratch(), [w.primary_key(dataset)]
    )


@query("rule_violation_counts")
def _rule_violation_counts(w):
    w.land()

    def counts(dataset):
        return contract_checks.violation_counts(w.bronze(dataset), w.rules(dataset), w.scratch())

    return each(w, counts)


# --- silver and quarantine ----------------------------------------------------------


@per_dataset("annotate")
def _annotate(w, dataset):
    return _annotated(w, dataset).drop("_ingested_at", "_source_file")


@per_dataset("silver")
def _silver(w, dataset):
    passed = contract_checks.clean(_annotated(w, dataset))
    typed = refine.to_silver(passed, schemas.silver(schemas.SOURCES[dataset]))
    return typed.drop("_ingested_at", "_source_file")


@per_dataset("quarantine")
def _quarantine(w, dataset):
    failed = contract_checks.rejected(_annotated(w, dataset))
    kept = refine.to_quarantine(failed, dataset, schemas.quarantine(schemas.SOURCES[dataset]))
    return kept.drop("_ingested_at", "_source_file", "_quarantined_at")


@query("row_conservation")
def _row_conservation(w):
    return refine.conservation(w.every("bronze"), w.every("silver"), w.every("quarantine"))


@query("dq_score_overall")
def _dq_score_overall(w):
    """From the stored rows, not from the scorecard."""
    counts = refine.conservation(w.every("bronze"), w.every("silver"), w.every("quarantine"))
    return refine.overall_score(
        counts.select(
            F.col("bronze_rows").alias("rows_received"), F.col("silver_rows").alias("rows_passed")
        )
    )


@query("quarantine_listing")
def _quarantine_listing(w):
    return reports.quarantine_listing(w.quarantine("ap"))


@query("rule_combinations")
def _rule_combinations(w):
    return reports.rule_combinations(w.every("quarantine"))


# --- reconciliation -------------------------------------------------------------------


@per_dataset("aggregate")
def _aggregate(w, dataset):
    return reconcile.aggregate_side(
        w.silver(dataset), BUSINESS_KEY, dataset, w.contract.checks_periods
    )


def _recon(w: Workspace) -> DataFrame:
    return reconcile.reconcile(
        w.silver("gl"), w.silver("ap"), checked_periods=w.contract.checks_periods
    )


@query("recon_full_outer")
def _recon_full_outer(w):
    return reconcile.match_sides(_aggregate(w, "gl"), _aggregate(w, "ap"), BUSINESS_KEY)


@query("recon_derived")
def _recon_derived(w):
    tied = reconcile.tie_sides(
        w.silver("gl"), w.silver("ap"), BUSINESS_KEY, w.contract.checks_periods
    )
    return reconcile.with_differences(tied)


@query("recon_classified")
def _recon_classified(w):
    return _recon(w)


@query("status_counts")
def _status_counts(w):
    return reconcile.status_counts(_recon(w))


@query("recon_controls")
def _recon_controls(w):
    return reconcile.recon_controls(_recon(w))


@query("recon_edge_cases")
def _recon_edge_cases(w):
    return reconcile.edge_cases(_recon(w))


@query("quarantine_single_sided")
def _quarantine_single_sided(w):
    rejected, landed = w.every("quarantine"), w.every("bronze")
    opposite = {"gl": "ap", "ap": "gl"}

    def counts(dataset):
        return reconcile.opposite_side_rejections(
            rejected[dataset], landed[opposite[dataset]], w.scratch()
        ).select(F.lit(dataset).alias("dataset"), "*")

    return each(w, counts)


@query("gl_key_uniqueness")
def _gl_key_uniqueness(w):
    return reconcile.repeated_keys(w.bronze("gl"))


# --- gold -------------------------------------------------------------------------------


@query("recon_detail")
def _recon_detail(w):
    return gold.detail(_recon(w))


@query("recon_summary")
def _recon_summary(w):
    return gold.summary(w.gold("recon_detail"))


@query("label_accounts")
def _label_accounts(w):
    return gold.labels(w.silver("gl"), "account_code", "account_name")


@query("label_vendors")
def _label_vendors(w):
    return gold.labels(w.silver("ap"), "vendor_code", "vendor_name")


@query("recon_exceptions")
def _recon_exceptions(w):
    detail = w.gold("recon_detail")
    return gold.exceptions(detail, w.silver("gl"), w.silver("ap"), w.scratch())


@query("exception_rank")
def _exception_rank(w):
    ranked = gold.ranked_exceptions(w.gold("recon_detail"), w.scratch())
    return ranked.select("exception_rank", *BUSINESS_KEY, "abs_amount_difference")


@query("gold_controls")
def _gold_controls(w):
    tables = (w.gold(t) for t in ("recon_detail", "recon_summary", "recon_exceptions"))
    return gold.gold_controls(*tables)


# --- scorecards ---------------------------------------------------------------------------


@query("rule_violations")
def _rule_violations(w):
    return scorecard.rule_violations(w.every("quarantine"))


@query("dq_rule_scorecard")
def _dq_rule_scorecard(w):
    return scorecard.rule_scorecard(
        scorecard.rule_catalogue(w.spark, w.contract),
        scorecard.rule_violations(w.every("quarantine")),
    )


@query("dq_scorecard")
def _dq_scorecard(w):
    layers = (w.every(layer) for layer in ("bronze", "silver", "quarantine"))
    return scorecard.scorecard(w.contract, *layers)


@query("scorecard_conservation")
def _scorecard_conservation(w):
    return scorecard.conservation_control(w.gold("dq_scorecard"))


@query("silent_rules")
def _silent_rules(w):
    return reports.silent_rules(w.gold("dq_rule_scorecard"))


@query("overall_from_scorecard")
def _overall_from_scorecard(w):
    return refine.overall_score(w.gold("dq_scorecard"))


@query("top_rules_with_predicate")
def _top_rules_with_predicate(w):
    return reports.top_rules_with_predicate(w.gold("dq_rule_scorecard"))


# --- reports ------------------------------------------------------------------------------

_FROM_SUMMARY = {
    "tile_break_mix": reports.break_mix,
    "tile_break_mix_exceptions": reports.break_mix_exceptions,
    "tile_breaks_by_period": reports.breaks_by_period,
    "tile_net_vs_gross": reports.net_vs_gross,
    "tile_unrecorded_liability": reports.unrecorded_liability,
    "period_filter": reports.period_filter,
    "break_mix_value": reports.break_mix_value,
    "period_status_grid": reports.period_status_grid,
    "unrecorded_by_period": reports.unrecorded_by_period,
}
for _name, _report in _FROM_SUMMARY.items():
    query(_name)(lambda w, r=_report: r(w.gold("recon_summary")))


@query("tile_headline")
def _tile_headline(w):
    tables = (w.gold(t) for t in ("recon_detail", "recon_exceptions", "dq_scorecard"))
    return reports.headline(*tables)


@query("tile_top_exceptions")
def _tile_top_exceptions(w):
    return reports.top_exceptions(w.gold("recon_exceptions"))


@query("top_exceptions_20")
def _top_exceptions_20(w):
    return reports.top_exceptions(w.gold("recon_exceptions"), 20)


@query("tile_duplicates")
def _tile_duplicates(w):
    return reports.duplicates(w.gold("recon_detail"))


@query("duplicates_evidence")
def _duplicates_evidence(w):
    return reports.duplicates(w.gold("recon_detail"), with_gl_rows=True)


@query("tile_dq_by_dataset")
def _tile_dq_by_dataset(w):
    return reports.dq_by_dataset(w.gold("dq_scorecard"))


@query("tile_most_violated")
def _tile_most_violated(w):
    return reports.most_violated(w.gold("dq_rule_scorecard"))


@query("tile_rule_catalogue")
def _tile_rule_catalogue(w):
    return reports.rule_listing(w.gold("dq_rule_scorecard"))


@query("tile_multi_rule_rows")
def _tile_multi_rule_rows(w):
    return reports.multi_rule_rows(w.every("quarantine"))


@query("unrecorded_detail")
def _unrecorded_detail(w):
    return reports.unrecorded_detail(w.gold("recon_exceptions"))


# --- verification -----------------------------------------------------------------------------


def _checks(w: Workspace) -> DataFrame:
    observed = controls.observed_metrics(
        w.gold("dq_scorecard"),
        w.gold("dq_rule_scorecard"),
        w.gold("recon_detail"),
        refine.rejections(w.every("quarantine")),
    )
    return controls.compare(expected_metrics(w.invoices(), w.contract), observed)


@query("control_checks")
def _control_checks(w):
    return _checks(w)


@query("control_failures")
def _control_failures(w):
    return controls.failures(_checks(w))


@query("fate_vs_status")
def _fate_vs_status(w):
    return controls.fate_vs_status(w.invoices(), w.gold("recon_detail"))
