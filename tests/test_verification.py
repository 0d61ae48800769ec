"""The controls must fail when data or expectation is tampered with."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF
from tieout.contract import STATUSES
from tieout.operators import controls, refine
from tieout.operators.uniqueness import attach_copies
from tieout.plans import pipeline
from tieout.plans.expectations import expected_metrics
from tieout.plans.workspace import workspace
from tieout.sources import fixtures
from tieout.sources.lakehouse import Lakehouse


def checks(spark, root, change=lambda frames: None):
    frames = {name: lines(spark, SF) for name, lines in fixtures.LINES.items()}
    change(frames)
    lake = Lakehouse(spark, root=str(root))
    pipeline.land_frames(lake, frames, SF)
    pipeline.refine(lake)
    pipeline.publish(lake)
    pipeline.score(lake)
    observed = controls.observed_metrics(
        lake.read("gold", "dq_scorecard"),
        lake.read("gold", "dq_rule_scorecard"),
        lake.read("gold", "recon_detail"),
        refine.rejections(pipeline.tables(lake, "quarantine")),
    )
    return expected_metrics(fixtures.invoices(spark, SF)), observed


def failed(expected, observed):
    return {r.metric for r in controls.failures(controls.compare(expected, observed)).collect()}


@pytest.fixture(scope="module")
def healthy(spark, tmp_path_factory):
    expected, observed = checks(spark, tmp_path_factory.mktemp("healthy"))
    return expected.cache(), observed.cache()


def test_healthy(healthy):
    assert controls.compare(*healthy).count() == 61
    assert failed(*healthy) == set()


def test_tampered_expectation(healthy):
    expected, observed = healthy
    off = expected.withColumn("expected", F.when(F.col("metric") == "break MISSING_FROM_GL",
                              F.col("expected") + 1).otherwise(F.col("expected")))
    assert failed(off, observed) == {"break MISSING_FROM_GL"}


def test_metric_missing_on_one_side(healthy):
    expected, observed = healthy
    assert failed(expected, observed.where("metric <> 'business keys'")) == {"business keys"}
    assert failed(expected.where("metric <> 'dq score'"), observed) == {"dq score"}


def drop(frames):
    frames["gl"] = frames["gl"].where("gl_entry_id <> 'GL000000000'")


def duplicate(frames):
    frames["ap"] = frames["ap"].unionByName(frames["ap"].where("ap_line_id = 'AP000000001'"))


def repair(frames):
    frames["ap"] = frames["ap"].withColumn("currency", F.lit("USD"))


def convert(frames):
    frames["ap"] = frames["ap"].withColumn(
        "amount", F.when(F.col("ap_line_id") == "AP000000001", "999999.00").otherwise(F.col("amount"))
    )


@pytest.mark.parametrize("change, metric", [
    (drop, "gl raw rows"),
    (duplicate, "ap raw rows"),
    (repair, "rule AP_DOM_CURRENCY"),
    (convert, "break AMOUNT_MISMATCH"),
])
def test_tampered_data(spark, tmp_path, change, metric):
    found = failed(*checks(spark, tmp_path / "lake", change))
    assert metric in found
    if change is convert:
        assert found == {"break AMOUNT_MISMATCH", "break MATCHED"}


def test_require_names_the_control(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], "control string, expected int, actual int")
    with pytest.raises(controls.ControlFailure, match="what: 1 failed: b: expected 1, found 2"):
        controls.require(rows, "what")


def test_require_counts_all_failures_and_takes_metrics(spark):
    rows = spark.createDataFrame([(f"m{i:02}", i, i + 1) for i in range(30)], "metric string, expected int, actual int")
    with pytest.raises(controls.ControlFailure, match="what: 30 failed: m00: .*m19: expected 19") as raised:
        controls.require(rows, "what")
    assert "m20" not in str(raised.value)
    with pytest.raises(controls.ControlFailure, match="30 failed: m00: expected 0, found 1$"):
        controls.require(rows, "what", shown=1)


def test_fates_land_in_their_status(spark, tmp_path):
    lake = Lakehouse(spark, root=str(tmp_path))
    pipeline.land_frames(lake, {n: f(spark, SF) for n, f in fixtures.LINES.items()}, SF)
    pipeline.refine(lake)
    pipeline.publish(lake)
    rows = controls.fate_vs_status(fixtures.invoices(spark, SF), lake.read("gold", "recon_detail"))
    by_fate = {}
    for row in rows.collect():
        by_fate.setdefault(row.fate, set()).add(row.break_status)
    assert by_fate[7] == by_fate[54] == {"MATCHED"}
    assert by_fate[8] == by_fate[10] == {"AMOUNT_MISMATCH"}
    assert by_fate[20] == {"TIMING_DIFFERENCE"}
    assert by_fate[41] == {"REJECTED"}
    assert by_fate[53] == {"DUPLICATE_IN_SUBLEDGER"}
    assert set.union(*by_fate.values()) == set(STATUSES) | {"REJECTED"}


def manifest_of(expected):
    """The nested manifest that states these metrics."""
    value = {r.metric: float(r.expected) for r in expected.collect()}
    nested = {"expected_quarantine": {"by_rule": {"gl": {}, "ap": {}}}, "expected_breaks": {}}
    for metric, at in controls.MANIFEST.items():
        *parents, name = at.split(".")
        place = nested
        for parent in parents:
            place = place.setdefault(parent, {})
        place[name] = value[metric]
    for metric, v in value.items():
        kind, _, name = metric.partition(" ")
        if kind == "rule" and v:
            nested["expected_quarantine"]["by_rule"][name[:2].lower()][name] = v
        if kind == "break":
            nested["expected_breaks"][name] = v
    return nested


def test_manifest_states_the_expectation(spark, healthy, tmp_path):
    expected, observed = healthy
    nested = manifest_of(expected)

    def stored():
        path = tmp_path / "manifest.json"
        path.write_text(json.dumps(nested, indent=1))
        return controls.manifest_metrics(spark, str(path))

    assert controls.compare(stored(), observed).count() == 61
    assert failed(stored(), observed) == set()
    nested["expected_breaks"]["MATCHED"] += 1
    nested["expected_quarantine"]["by_rule"]["ap"].pop("AP_NN_AMOUNT")
    del nested["expected_key_total"]
    assert failed(stored(), observed) == {
        "break MATCHED", "rule AP_NN_AMOUNT", "business keys", "keys with a known status"
    }
    with pytest.raises(controls.ControlFailure, match="load: 4 failed"):
        controls.require(controls.compare(stored(), observed), "load")


@pytest.mark.parametrize("dataset", ["gl", "ap"])
def test_published_predicates_count_what_they_claim(spark, scratch, dataset):
    w = workspace(spark, SF)
    rules = [r for r in w.gold("dq_rule_scorecard").collect() if r.dataset == dataset]
    checked = attach_copies(w.bronze(dataset), w.rules(dataset), scratch)
    counted = checked.agg(*[F.count_if(F.expr(r.predicate_sql)).alias(r.rule_id) for r in rules])
    assert counted.first().asDict() == {r.rule_id: r.rows_rejected for r in rules}
    assert len(rules) == len(w.rules(dataset))
