"""Shape of the physical plans: what shuffles, what is broadcast, what is pruned."""

from __future__ import annotations

import contextlib
import io
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF
from tieout.contract import GL, BUSINESS_KEY
from tieout.operators import annotate, controls, gold, membership, reconcile, refine, reports, uniqueness
from tieout.plans.workspace import workspace


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def final_plan(df):
    """The plan AQE settled on."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture
def w(spark):
    return workspace(spark, SF)


@contextlib.contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_reconciliation_is_one_shuffle(w):
    p = plan(reconcile.reconcile(w.silver("gl"), w.silver("ap"), checked_periods=True))
    assert p.count("Exchange hashpartitioning") == 1
    assert "Join" not in p and "Sort" not in p
    assert "partial_sum" in p


def test_reconciliation_reads_five_columns(w):
    p = plan(reconcile.reconcile(w.silver("gl"), w.silver("ap"), checked_periods=True), "formatted")
    schemas_read = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert len(schemas_read) == 2
    assert all(line.count(":") == 6 for line in schemas_read)
    assert not any("extract_ts" in line for line in schemas_read)


def test_joining_aggregated_sides_adds_no_exchange(w):
    sides = [reconcile.aggregate_side(w.silver(d), BUSINESS_KEY, d, True) for d in ("gl", "ap")]
    p = plan(reconcile.match_sides(*sides, BUSINESS_KEY))
    assert p.count("Exchange hashpartitioning") == 2 and "SortAggregate" not in p


def test_rules_do_not_shuffle_rows(w, scratch):
    """Repeated ids are few, so rows meet them in a broadcast join."""
    p = plan(annotate.annotate(w.bronze("gl"), GL.rules, scratch))
    assert "BroadcastHashJoin" in p
    assert "Exchange hashpartitioning" not in p and "Window" not in p


def test_rules_are_evaluated_once(w, scratch):
    checked = annotate.annotate(w.bronze("gl"), GL.rules, scratch)
    for part in (annotate.clean(checked), annotate.rejected(checked)):
        assert plan(part).count("GL_NN_AMOUNT") <= 2  # Generate and its output line


def test_few_repeated_ids_shuffle_no_row(spark, w, scratch):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        p = plan(annotate.annotate(w.bronze("gl"), GL.rules, scratch))
    assert "SortMergeJoin" not in p and "Exchange hashpartitioning" not in p


def test_many_repeated_ids_shuffle_only_rows_that_may_repeat(spark, w, scratch):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        p = plan(annotate.annotate(w.bronze("gl"), GL.rules, scratch, most_broadcast=-1))
    assert "SortMergeJoin" in p and "Union" in p and "Window" not in p
    # One exchange of candidates, one of the repeated ids; the other branch has none.
    assert p.count("Exchange hashpartitioning") == 2
    candidates, others = p.split("SortMergeJoin")[1].split("Scan parquet", 1)[0], p.split("Scan parquet")[-2]
    assert "Exchange hashpartitioning(gl_entry_id" in candidates
    assert "Exchange hashpartitioning" not in others


@pytest.mark.parametrize("bits", [6, 8, 26])
def test_bitmap_of_repeated_ids_misses_none(spark, scratch, bits):
    ids = [f"id{i}" for i in range(500)] + [f"id{i}" for i in range(0, 500, 7)] + ["HOT"] * 300
    rows = spark.createDataFrame([(i,) for i in ids + ["", " ", None] * 50], "gl_entry_id string")
    rule = [r for r in GL.rules if r.check == "unique"]
    found = uniqueness.attach_copies(rows, rule, scratch, most_broadcast=-1, bits=bits).collect()
    counts = Counter(ids)
    assert len(found) == rows.count()
    for r in found:
        n = counts[r.gl_entry_id]
        assert r["_copies_gl_entry_id"] == (n if n > 1 else None)


@pytest.mark.parametrize("bits, slices", [(31, 1), (17, 3)])
def test_filter_of_many_ids_lets_few_others_through(spark, scratch, bits, slices):
    """20,000 repeated ids; its size follows their number, beyond 2**bits in slices."""
    ids = spark.range(20_000).select(F.concat(F.lit("id"), "id").alias("gl_entry_id"))
    repeated = scratch.keep(ids.withColumn("_copies_gl_entry_id", F.lit(2).cast("bigint")), "repeated")
    others = spark.range(400_000).select(F.concat(F.lit("other"), "id").alias("gl_entry_id"))
    rows = scratch.keep(others.unionByName(ids), "rows")
    found = uniqueness.joined_where_possible(rows, repeated, 20_000, "gl_entry_id", scratch, bits)
    per_copies = found.groupBy("_copies_gl_entry_id").count().collect()
    assert {r[0]: r["count"] for r in per_copies} == {None: 400_000, 2: 20_000}
    words = membership.words_for(-(-20_000 // slices), bits)
    passed = 0
    for number in range(slices):
        part = F.pmod(F.xxhash64("gl_entry_id", F.lit("slice")), F.lit(slices)) == number
        own = scratch.keep(membership.filter_rows(repeated.where(part), ["gl_entry_id"], words), "filter")
        assert own.select(F.sum(F.size("_words"))).first()[0] < words + 1024
        through, _ = uniqueness.passed_and_joined(
            rows.where(part), repeated.where(part), own, "gl_entry_id", words
        )
        passed += through.count()
    assert 20_000 <= passed < 20_000 + 0.01 * 400_000
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        p = plan(found)
    # Per slice one exchange of candidates and one of the repeated ids.
    assert p.count("Exchange hashpartitioning") == 2 * slices
    assert p.count("BroadcastHashJoin") == 2 * slices


def test_hot_id_is_split_when_nothing_is_broadcast(spark, scratch):
    """Half of the rows share an id; AQE cuts their partition and none is lost."""
    rows = spark.range(0, 400000, 1, 16).select(
        F.when(F.col("id") % 2 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("gl_entry_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    rule = [r for r in GL.rules if r.check == "unique"]
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    ):
        found = annotate.annotate(rows, rule, scratch, most_broadcast=-1)
        table = f"{scratch.root}/annotated"
        found.write.parquet(table)
        p = final_plan(annotate.rejected(found).select("payload"))
    assert "skew=true" in p
    stored = spark.read.parquet(table).groupBy("_failed_rule_count").count().collect()
    assert {r._failed_rule_count: r["count"] for r in stored} == {0: 200000, 1: 200000}


def test_rank_uses_no_global_window(w, scratch):
    ranked = gold.ranked_exceptions(w.gold("recon_detail"), scratch)
    p = plan(ranked)
    assert "BroadcastHashJoin" in p
    # The only single-partition step is over one row per range.
    assert p.count("Exchange SinglePartition") == 1
    assert "Window [sum(_n" in p


def test_exceptions_skip_matched_keys(w):
    p = plan(w.gold("recon_detail").where("break_status <> 'MATCHED'"), "formatted")
    assert "PartitionFilters: [isnotnull(break_status" in p


def test_summary_is_one_scan_without_join(w):
    p = plan(gold.summary(w.gold("recon_detail")))
    assert p.count("FileScan") == 1 and "Join" not in p


def test_labels_are_broadcast_by_size(w, scratch):
    p = plan(gold.exceptions(w.gold("recon_detail"), w.silver("gl"), w.silver("ap"), scratch))
    assert p.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in p


def test_metrics_of_the_detail_are_one_scan(w):
    tables = w.gold("dq_scorecard"), w.gold("dq_rule_scorecard"), w.gold("recon_detail")
    metrics = controls.observed_metrics(*tables, refine.rejections(w.every("quarantine")))
    scans = [line for line in plan(metrics, "formatted").splitlines() if "Location" in line]
    assert sum("recon_detail" in line for line in scans) == 1


def test_controls_of_published_tables_do_not_scan_the_detail(w):
    measured = gold.as_row(w.spark, {f.name: 0 for f in gold.measured(w.gold("recon_detail")).schema})
    p = plan(
        gold.published_controls(measured, w.gold("recon_summary"), w.gold("recon_exceptions")), "formatted"
    )
    assert "recon_summary" in p and "recon_exceptions" in p and "recon_detail" not in p


def test_top_exceptions_push_the_rank(w):
    p = plan(reports.top_exceptions(w.gold("recon_exceptions")), "formatted")
    assert "LessThanOrEqual(exception_rank,25)" in p


def test_peek_is_a_top_k(w):
    assert "TakeOrderedAndProject" in plan(reports.peek(w.bronze("gl"), "gl_entry_id"))


def test_opposite_side_goes_through_a_filter_when_nothing_is_broadcast(spark, w, scratch):
    """Many rejected keys: only rows of the other side that may hold one are shuffled."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        found = reconcile.opposite_side_rejections(
            w.quarantine("gl"), w.bronze("ap"), scratch, most_broadcast=-1
        )
        p = plan(found)
    # Down to the other side: join with the keys, exchange, filter, scan.
    below = p[p.index("Inner") :]
    scan = below.index("FileScan")
    assert below.index("Exchange hashpartitioning") < below.index("BroadcastHashJoin") < scan
    assert "LeftSemi" not in p
    few = reconcile.opposite_side_rejections(w.quarantine("gl"), w.bronze("ap"), scratch)
    assert found.collect() == few.collect() and few.first().rejected_rows > 0


def test_opposite_side_is_not_shuffled_whole(w, scratch):
    p = plan(reconcile.opposite_side_rejections(w.quarantine("gl"), w.bronze("ap"), scratch))
    assert "LeftSemi, BuildRight" in p
