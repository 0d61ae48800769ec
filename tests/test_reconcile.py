"""Statuses, tolerance, precedence, and the matchers that are known to be wrong."""

from __future__ import annotations

import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tieout import contract as c
from tieout.operators import reconcile as r

SCHEMA = (
    "account_code string, vendor_code string, invoice_number string,"
    " amount decimal(18,2), fiscal_period string"
)
KEY = c.BUSINESS_KEY


def side(spark, rows):
    """Rows of (invoice, amount, period)."""
    return spark.createDataFrame(
        [("6010", "V0001", i, Decimal(a), p) for i, a, p in rows], SCHEMA
    )


def statuses(spark, gl, ap, **options):
    done = r.reconcile(side(spark, gl), side(spark, ap), **options)
    return {row.invoice_number: row.break_status for row in done.collect()}


def test_each_status(spark):
    gl = [("match", "10", "2026-01"), ("amount", "10", "2026-01"), ("late", "10", "2026-01"),
          ("gl", "10", "2026-01"), ("double", "10", "2026-01")]
    ap = [("match", "10", "2026-01"), ("amount", "15", "2026-01"), ("late", "10", "2026-02"),
          ("ap", "10", "2026-01"), ("double", "10", "2026-01"), ("double", "10", "2026-01")]
    expected = {
        "match": c.MATCHED, "amount": c.AMOUNT_MISMATCH, "late": c.TIMING_DIFFERENCE,
        "gl": c.MISSING_FROM_SUBLEDGER, "ap": c.MISSING_FROM_GL,
        "double": c.DUPLICATE_IN_SUBLEDGER,
    }
    assert statuses(spark, gl, ap) == expected
    assert statuses(spark, gl, ap, checked_periods=True) == expected


def test_tolerance_is_inclusive(spark):
    amounts = ["100.00", "100.99", "101.00", "101.01", "99.00", "98.99"]
    gl = [(a, "100.00", "2026-01") for a in amounts]
    ap = [(a, a, "2026-01") for a in amounts]
    found = statuses(spark, gl, ap)
    assert [found[a] for a in amounts] == [
        c.MATCHED, c.MATCHED, c.MATCHED, c.AMOUNT_MISMATCH, c.MATCHED, c.AMOUNT_MISMATCH
    ]


def test_every_pair_one_apart_matches(spark):
    """In binary floating point some of these differ by more than 1.0."""
    cents = F.col("id").cast("decimal(16,0)") * F.expr("0.01BD")
    base = spark.range(20000).select(
        F.lit("6010").alias("account_code"), F.lit("V0001").alias("vendor_code"),
        F.col("id").cast("string").alias("invoice_number"), cents.cast("decimal(18,2)").alias("amount"),
        F.lit("2026-01").alias("fiscal_period"),
    )
    other = base.withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)"))
    assert r.reconcile(base, other).where(F.col("break_status") != c.MATCHED).count() == 0


def test_precedence(spark):
    gl = [("da", "10", "2026-01"), ("dt", "10", "2026-01"), ("at", "10", "2026-01")]
    ap = [("da", "10", "2026-01"), ("da", "55", "2026-01"), ("dt", "10", "2026-02"),
          ("dt", "10", "2026-02"), ("at", "99", "2026-02")]
    assert statuses(spark, gl, ap) == {
        "da": c.DUPLICATE_IN_SUBLEDGER, "dt": c.DUPLICATE_IN_SUBLEDGER, "at": c.AMOUNT_MISMATCH
    }
    with pytest.raises(c.ContractError):
        statuses(spark, gl, ap, precedence=c.PRECEDENCE[::-1])


def walk():
    """(invoice, gl rows, ap rows, delta, shifted) for all 66 non-empty cases."""
    for n, (g, a, delta, shifted) in enumerate(
        itertools.product(range(3), range(4), ("0", "0.50", "5.00"), (False, True))
    ):
        if g or a:
            yield f"k{n:02d}", g, a, Decimal(delta), shifted


def expected_status(g, a, delta, shifted):
    if a > 1:
        return c.DUPLICATE_IN_SUBLEDGER
    if not a:
        return c.MISSING_FROM_SUBLEDGER
    if not g:
        return c.MISSING_FROM_GL
    # One AP row against the sum of the GL rows.
    if abs(100 * g - (100 + delta)) > 1:
        return c.AMOUNT_MISMATCH
    return c.TIMING_DIFFERENCE if shifted else c.MATCHED


def test_case_walk(spark):
    cases = list(walk())
    assert len(cases) == 66
    gl = [(k, "100", "2026-03") for k, g, *_ in cases for _ in range(g)]
    ap = [(k, str(100 + d), "2026-04" if s else "2026-03")
          for k, _, a, d, s in cases for _ in range(a)]
    assert statuses(spark, gl, ap) == {k: expected_status(*rest) for k, *rest in cases}


def test_one_aggregation_equals_the_join(spark):
    cases = list(walk())
    gl = side(spark, [(k, "100", f"2026-0{1 + i}") for k, g, *_ in cases for i in range(g)])
    ap = side(spark, [(k, str(50 + d), f"2026-1{i}") for k, _, a, d, _ in cases for i in range(a)])
    join = r.match_sides(
        r.aggregate_side(gl, KEY, "gl"), r.aggregate_side(ap, KEY, "ap"), KEY
    )
    want = sorted(map(str, r.with_differences(join).collect()))
    for checked in (False, True):
        tied = r.with_differences(r.tie_sides(gl, ap, KEY, checked))
        assert sorted(map(str, tied.select(*join.columns, "amount_difference",
                                           "abs_amount_difference").collect())) == want


def test_absent_side_keeps_null_amount(spark):
    row = r.reconcile(side(spark, []), side(spark, [("x", "7", "2026-01")])).first()
    assert (row.gl_amount, row.gl_fiscal_period, row.gl_row_count) == (None, None, 0)
    assert (row.ap_amount, row.amount_difference, row.abs_amount_difference) == (7, -7, 7)


def test_all_key_parts_match(spark):
    gl = spark.createDataFrame([("6010", "V0001", "i", Decimal(1), "2026-01")], SCHEMA)
    ap = spark.createDataFrame([("6020", "V0001", "i", Decimal(1), "2026-01")], SCHEMA)
    found = sorted(x.break_status for x in r.reconcile(gl, ap).collect())
    assert found == [c.MISSING_FROM_GL, c.MISSING_FROM_SUBLEDGER]


def test_repeated_rows_do_not_fan_out(spark):
    gl = side(spark, [("x", "10", "2026-01")] * 3)
    ap = side(spark, [("x", "10", "2026-01")] * 4)
    row = r.reconcile(gl, ap).first()
    assert (row.gl_amount, row.ap_amount, row.gl_row_count, row.ap_row_count) == (30, 40, 3, 4)


def test_wide_totals_are_kept(spark):
    """A key whose total outgrows the type of a single amount."""
    ap = spark.range(40).select(
        F.lit("6010").alias("account_code"), F.lit("V0001").alias("vendor_code"),
        F.lit("x").alias("invoice_number"),
        F.lit(Decimal("999999999999999.99")).cast("decimal(18,2)").alias("amount"),
        F.lit("2026-01").alias("fiscal_period"),
    )
    assert r.reconcile(side(spark, []), ap).first().ap_amount == Decimal("39999999999999999.60")


def test_status_counts_list_all(spark):
    done = r.reconcile(side(spark, [("x", "1", "2026-01")]), side(spark, []))
    counts = {x.break_status: x.key_count for x in r.status_counts(done).collect()}
    assert counts == {s: int(s == c.MISSING_FROM_SUBLEDGER) for s in c.STATUSES}


def test_foreign_status_raises(spark):
    odd = spark.createDataFrame([("NEW",)], "break_status string")
    with pytest.raises(Exception, match="unknown break status: NEW"):
        r.status_counts(odd).collect()


def test_controls_see_null_keys(spark):
    gl = spark.createDataFrame([(None, "V0001", "i", Decimal(1), "2026-01")], SCHEMA)
    rows = {x.control: (x.expected, x.actual)
            for x in r.recon_controls(r.reconcile(gl, side(spark, []))).collect()}
    assert rows["keys with a null part"] == (0, 1)
    assert rows["statuses form a partition"] == (1, 1)


def test_opposite_side(spark, scratch):
    """A hot rejected key is one row of the join, and all its rows are counted."""
    rejected = side(spark, [("hot", "1", "2026-01")] * 50 + [("own", "1", "2026-01")])
    other = side(spark, [("hot", "1", "2026-01")] * 50)
    row = r.opposite_side_rejections(rejected, other, scratch).first()
    assert tuple(row) == (51, 50)


def test_repeated_keys(spark):
    rows = r.repeated_keys(side(spark, [("x", "1", "p")] * 2 + [("y", "1", "p")])).collect()
    assert [(x.invoice_number, x.row_count) for x in rows] == [("x", 2)]


# --- matchers that look right and are not ---------------------------------------------


@pytest.fixture(scope="module")
def sides(spark):
    gl = side(spark, [(f"m{i}", "10", "2026-01") for i in range(8)]
              + [("d1", "10", "2026-01"), ("d2", "10", "2026-01")])
    ap = side(spark, [(f"m{i}", "10", "2026-01") for i in range(8)]
              + [("d1", "10", "2026-01")] * 2
              + [("d2", "10", "2026-01"), ("d2", "12", "2026-01")])
    return gl, ap


def count(df):
    return {x.break_status: x["count"] for x in df.groupBy("break_status").count().collect()}


def test_right_matcher(sides):
    assert count(r.reconcile(*sides)) == {c.MATCHED: 8, c.DUPLICATE_IN_SUBLEDGER: 2}


def test_totals_without_row_counts_lose_duplicates(sides):
    tied = r.tie_sides(*sides, KEY).withColumn("ap_row_count", F.lit(1).cast("bigint"))
    found = count(r.with_differences(tied).withColumn("break_status", r.break_status()))
    assert c.DUPLICATE_IN_SUBLEDGER not in found and sum(found.values()) == 10


def test_join_then_dedupe_hides_duplicates(sides):
    gl, ap = sides
    joined = gl.join(ap.withColumnRenamed("amount", "ap_amount").drop("fiscal_period"), list(KEY))
    kept = joined.dropDuplicates(list(KEY))
    assert kept.count() == 10
    assert kept.where(F.abs(F.col("amount") - F.col("ap_amount")) <= 1).count() >= 9


def test_dedupe_then_join_splits_keys(sides):
    """Removing exact copies first leaves unequal copies, and fans out."""
    gl, ap = sides
    assert gl.join(ap.dropDuplicates(), list(KEY)).count() == 11
