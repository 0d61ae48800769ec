from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF

from tieout import contract as c
from tieout import schemas
from tieout.functions.casts import conform
from tieout.operators import gold, scorecard
from tieout.operators.controls import ControlFailure
from tieout.operators.rank import global_rank
from tieout.operators.reconcile import reconcile
from tieout.plans import pipeline
from tieout.plans.workspace import workspace
from tieout.sources import fixtures

SIDE = (
    "account_code string, account_name string, vendor_code string, vendor_name string,"
    " invoice_number string, amount decimal(18,2), fiscal_period string"
)


def side(spark, rows):
    """Rows of (account, vendor, invoice, amount, period)."""
    return spark.createDataFrame(
        [(a, f"n{a}", v, f"n{v}", i, Decimal(m), p) for a, v, i, m, p in rows], SIDE
    )


@pytest.fixture(scope="module")
def ledgers(spark):
    gl = side(spark, [("6010", "V1", "a", "100", "2026-01"), ("6010", "V1", "b", "50", "2026-01"),
                      ("6010", "V1", "c", "10", "2026-02"), ("7010", "V9", "e", "5", "2026-02")])
    ap = side(spark, [("6010", "V1", "a", "150", "2026-01"), ("6010", "V1", "b", "0.50", "2026-01"),
                      ("6010", "V1", "c", "10", "2026-02"), ("6020", "V2", "d", "70", "2026-03")])
    return gl, ap


@pytest.fixture(scope="module")
def detail(ledgers):
    return gold.detail(reconcile(*ledgers))


def test_declared_columns_in_order(detail, ledgers, scratch):
    assert detail.columns == schemas.RECON_DETAIL.fieldNames()
    assert gold.summary(detail).columns == schemas.RECON_SUMMARY.fieldNames()
    made = gold.exceptions(detail, *ledgers, scratch)
    assert made.columns == schemas.RECON_EXCEPTIONS.fieldNames()
    for df, schema in ((detail, schemas.RECON_DETAIL), (made, schemas.RECON_EXCEPTIONS)):
        assert [f.dataType for f in df.schema] == [f.dataType for f in schema]


def test_missing_column_raises(detail):
    with pytest.raises(ValueError, match="break_status"):
        conform(detail.drop("break_status"), schemas.RECON_DETAIL, "recon_detail")


def test_reporting_period_falls_back_to_ap(detail):
    periods = {r.invoice_number: r.fiscal_period for r in detail.collect()}
    assert periods == {"a": "2026-01", "b": "2026-01", "c": "2026-02", "d": "2026-03",
                       "e": "2026-02"}


def test_summary_is_dense_and_adds_up(detail):
    rows = gold.summary(detail).collect()
    assert len(rows) == 3 * len(c.STATUSES)
    assert sum(r.key_count for r in rows) == detail.count()
    empty = next(r for r in rows if r.fiscal_period == "2026-03" and r.break_status == c.MATCHED)
    assert tuple(empty)[2:] == (0, 0, 0, 0, 0)


def test_net_cancels_and_gross_does_not(detail):
    cell = next(r for r in gold.summary(detail).collect()
                if (r.fiscal_period, r.break_status) == ("2026-01", c.AMOUNT_MISMATCH))
    assert cell.key_count == 2
    assert cell.net_amount_difference == Decimal("-0.50")
    assert cell.abs_amount_difference == Decimal("99.50")


def test_empty_summary(detail):
    assert gold.summary(detail.limit(0)).count() == 0


def test_exceptions_are_labelled_and_kept(detail, ledgers, scratch):
    rows = {r.invoice_number: r for r in gold.exceptions(detail, *ledgers, scratch).collect()}
    assert set(rows) == {"a", "b", "d", "e"}
    # No GL row names account 6020, no AP row names vendor V9.
    assert (rows["d"].account_name, rows["d"].vendor_name) == ("(unlabelled)", "nV2")
    assert (rows["e"].account_name, rows["e"].vendor_name) == ("n7010", "(unlabelled)")
    assert [r.invoice_number for r in sorted(rows.values(), key=lambda r: r.exception_rank)] == [
        "d", "a", "b", "e"
    ]


def test_labels_are_unique_and_least(spark):
    df = spark.createDataFrame([("1", "b"), ("1", "a"), ("2", "z"), ("1", "a")], "k string, n string")
    assert sorted(map(tuple, gold.labels(df, "k", "n").collect())) == [("1", "a"), ("2", "z")]


def test_rank_equals_the_window(spark, scratch):
    """Nine in ten rows tie on the first column of the order."""
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 101).otherwise(7).alias("x"),
        (F.col("id") * 7919 % 20011).alias("y"),
    )
    order = [F.desc("x"), F.asc("y")]
    got = global_rank(df.repartition(6), order, "n", scratch).orderBy("n").collect()
    want = spark.sql("SELECT x, y, row_number() OVER (ORDER BY x DESC, y) AS n FROM {df} ORDER BY n",
                     df=df).collect()
    assert [(r.x, r.y, r.n) for r in got] == [tuple(r) for r in want]


def test_rank_ties_break_by_key(spark, scratch):
    gl = side(spark, [("6020", "V1", "b", "5", "p"), ("6010", "V2", "a", "5", "p"),
                      ("6010", "V1", "b", "5", "p"), ("6010", "V1", "a", "5", "p")])
    made = gold.detail(reconcile(gl, gl.limit(0)))
    rows = gold.ranked_exceptions(made, scratch).orderBy("exception_rank").collect()
    assert [r.exception_rank for r in rows] == [1, 2, 3, 4]
    assert [(r.account_code, r.vendor_code, r.invoice_number) for r in rows] == [
        ("6010", "V1", "a"), ("6010", "V1", "b"), ("6010", "V2", "a"), ("6020", "V1", "b")
    ]


def test_rank_of_nothing(detail, scratch):
    assert gold.ranked_exceptions(detail.limit(0), scratch).count() == 0


def test_gold_controls_notice_a_lost_exception(detail, ledgers, scratch):
    made = gold.exceptions(detail, *ledgers, scratch)
    whole = gold.gold_controls(detail, gold.summary(detail), made)
    assert all(r.expected == r.actual for r in whole.collect())
    short = gold.gold_controls(detail, gold.summary(detail), made.where("exception_rank <> 2"))
    assert {r.control for r in short.collect() if r.expected != r.actual} == {
        "exceptions are keys less matched", "ranks run to the number of exceptions"
    }


# --- scorecards ------------------------------------------------------------------------

REASONS = "_dataset string, _failed_rule_ids string, _failed_rule_count int"


def test_catalogue_is_complete(spark):
    rows = scorecard.rule_catalogue(spark, c.DEFAULT).collect()
    assert len({r.rule_id for r in rows}) == 37
    assert all(r.description and r.predicate_sql for r in rows)
    assert {r.check_type for r in rows} == set(c.CHECKS)


def test_rows_with_two_rules_count_for_each(spark):
    gl = spark.createDataFrame([("gl", "A|B", 2), ("gl", "A", 1)], REASONS)
    ap = spark.createDataFrame([("ap", "C", 1)], REASONS)
    found = {r.rule_id: r.rows_rejected
             for r in scorecard.rule_violations({"gl": gl, "ap": ap}).collect()}
    assert found == {"A": 2, "B": 1, "C": 1}


def test_silent_rules_stay(spark):
    gl = spark.createDataFrame([("gl", "GL_NN_AMOUNT", 1)], REASONS)
    rows = scorecard.rule_scorecard(
        scorecard.rule_catalogue(spark, c.DEFAULT), scorecard.rule_violations({"gl": gl})
    ).collect()
    assert len(rows) == 37 and sum(r.rows_rejected for r in rows) == 1


def test_scorecard_of_nothing_scores_zero(spark):
    empty = spark.createDataFrame([], REASONS)
    layer = {"gl": empty, "ap": empty}
    rows = scorecard.scorecard(c.DEFAULT, layer, layer, layer).collect()
    assert [(r.rows_received, r.dq_score_pct) for r in rows] == [(0, Decimal("0.0000"))] * 2


def test_score_is_of_received_rows(spark):
    def rows(n, reason="", k=0):
        return spark.createDataFrame([("gl", reason, k)] * n, REASONS)

    made = scorecard.scorecard(
        c.DEFAULT, {"gl": rows(7)}, {"gl": rows(4)}, {"gl": rows(3, "A|B", 2)}
    )
    row = made.first()
    assert (row.rows_passed, row.rows_quarantined, row.rule_violations) == (4, 3, 6)
    assert row.dq_score_pct == Decimal("57.1429")
    control = scorecard.conservation_control(made).first()
    assert (control.expected, control.actual) == (7, 7)


def test_stored_exceptions_hold_disjoint_ranks(spark, lake):
    detail = workspace(spark, SF).gold("recon_detail")
    silver = {n: workspace(spark, SF).silver(n) for n in ("gl", "ap")}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = gold.exceptions(detail, silver["gl"], silver["ap"], lake.scratch())
        stored = lake.write(ranked, "gold", "recon_exceptions")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = stored.groupBy(F.input_file_name()).agg(
        F.min("exception_rank").alias("first"), F.max("exception_rank").alias("last")
    )
    ends = sorted((r["first"], r["last"]) for r in ranges.collect())
    assert len(ends) == 8
    assert all(last < first for (_, last), (first, _) in zip(ends, ends[1:]))


def test_published_tables_are_held_against_what_was_written(spark, lake):
    """The detail is tampered with between its write and the tables made of it."""
    pipeline.land_frames(
        lake, {n: rows(spark, "/root/testdata/sf0.001") for n, rows in fixtures.LINES.items()}, "memory"
    )
    pipeline.refine(lake)
    pipeline.publish(lake)
    detail = lake.read("gold", "recon_detail")
    exceptions = lake.read("gold", "recon_exceptions")
    written = gold.as_row(spark, gold.measured(detail).first().asDict())

    def failed(stored, ranked=exceptions):
        checks = gold.published_controls(written, gold.summary(stored), ranked).collect()
        assert len(checks) == 12
        return {c.control for c in checks if c.expected != c.actual}

    assert failed(detail) == set()
    key = detail.where("break_status = 'MATCHED'").first().invoice_number
    one = F.col("invoice_number") == key
    gone = failed(detail.where(~one))
    assert {"summary keys equal detail keys", "summary keys of MATCHED"} <= gone
    dearer = detail.withColumn("gl_amount", F.when(one, F.col("gl_amount") + 1).otherwise(F.col("gl_amount")))
    assert failed(dearer.select(detail.columns)) == {"summary total of gl_amount"}
    moved = detail.withColumn("break_status", F.when(one, "TIMING_DIFFERENCE").otherwise(F.col("break_status")))
    assert failed(moved) == {"summary keys of MATCHED", "summary keys of TIMING_DIFFERENCE"}
    assert failed(detail, exceptions.where("exception_rank <> 3")) == {
        "exceptions are keys less matched", "ranks run to the number of exceptions",
    }


def test_publishing_stops_when_the_stored_detail_differs(spark, lake, monkeypatch):
    pipeline.land_frames(
        lake, {n: rows(spark, "/root/testdata/sf0.001") for n, rows in fixtures.LINES.items()}, "memory"
    )
    pipeline.refine(lake)
    real = gold.summary
    monkeypatch.setattr(gold, "summary", lambda detail: real(detail.where("break_status <> 'MISSING_FROM_GL'")))
    with pytest.raises(ControlFailure, match="summary keys of MISSING_FROM_GL"):
        pipeline.publish(lake)
