from __future__ import annotations

import pytest
from conftest import SF
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieout.functions import casts
from tieout.operators import controls, gold
from tieout.operators.annotate import annotate, clean
from tieout.plans import pipeline
from tieout.plans.workspace import Workspace, workspace
from tieout.sources import fixtures
from tieout.sources.lakehouse import Lakehouse


def test_detail_is_tied_without_ranking_exceptions(spark):
    w = Workspace.fresh(spark, SF)
    w.gold("recon_detail")
    assert ("gold", "recon_detail") in w.lake.runs()
    assert ("gold", "recon_exceptions") not in w.lake.runs()
    detail = w.lake.runs()["gold", "recon_detail"]
    unmatched = w.gold("recon_detail").where("break_status <> 'MATCHED'").count()
    assert w.gold("recon_exceptions").count() == unmatched > 0
    assert w.lake.runs()["gold", "recon_detail"] == detail  # not tied again


def test_halves_of_publish_give_what_publish_gives(spark, tmp_path):
    lakes = [Lakehouse(spark, root=str(tmp_path / n)) for n in ("whole", "halves")]
    for lake in lakes:
        pipeline.land_frames(lake, {n: f(spark, SF) for n, f in fixtures.LINES.items()}, SF)
        pipeline.refine(lake)
    pipeline.publish(lakes[0])
    pipeline.present(lakes[1], pipeline.tie(lakes[1]))
    for table in ("recon_detail", "recon_summary", "recon_exceptions"):
        one, other = (lake.read("gold", table) for lake in lakes)
        assert one.exceptAll(other).count() == other.exceptAll(one).count() == 0
        assert one.count() == other.count() > 0


def test_a_detail_that_lost_rows_is_refused(spark):
    measured = spark.createDataFrame([(3,)], "n bigint")
    with pytest.raises(controls.ControlFailure, match="keys stored are keys written: expected 3, found 2"):
        controls.require(gold.stored_control(measured, spark.range(2)), "stored")


def test_fates_are_joined_by_a_hash_first_and_null_keys_are_rejected(spark):
    invoices = spark.createDataFrame(
        [("a", "v", "i", 1), ("a", "v", "i", 1), ("a", "v", "i", 2), ("a", None, "i", 3), ("b", "v", "i", 4)],
        "account string, vendor string, invoice string, f int",
    )
    detail = spark.createDataFrame(
        [("a", "v", "i", "MATCHED"), ("a", None, "i", "MATCHED")],
        "account_code string, vendor_code string, invoice_number string, break_status string",
    )
    found = controls.fate_vs_status(invoices, detail)
    assert sorted(map(tuple, found.collect())) == [
        (1, "MATCHED", 2), (2, "MATCHED", 1), (3, "REJECTED", 1), (4, "REJECTED", 1)
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter, ((((_hash" in plan


DATES = ["2024-02-29", "2023-02-29", "0000-01-01", "9999-12-31", "2024-13-01", "2024-04-31", "2024-1-01", "+2024-01-1"]
TIMES = ["2026-08-01T02:15:00Z", "2026-08-01T24:00:00Z", "2026-02-30T02:15:59Z", "2026-08-01T2:15:00.1Z", "0001-01-01T23:59:60Z"]


def broken(texts):
    """Each text, and each with one place or two neighbours replaced, one left out, one put in."""
    odd = list(" -+:T.Z09a\t١ ")
    yield from (None, "", " ", "2024", "2024-02", "20240229")
    for text in texts:
        yield from (text, f" {text}", f"{text} ", text.lower(), f"{text}T", text.replace("T", " "))
        for i in range(len(text)):
            yield text[:i] + text[i + 1 :]
            for o in odd:
                yield from (text[:i] + o + text[i + 1 :], text[:i] + o + text[i:], text[:i] + o + o + text[i + 2 :])


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dates_and_times_are_read_as_by_their_format(spark, zone):
    texts = spark.createDataFrame([(t,) for t in broken(DATES + TIMES + ["2026-03-08T02:30:00Z"])], "v string")
    by_format = {
        T.DateType(): F.try_to_date("v", casts.DATE_FORMAT),
        T.TimestampType(): F.try_to_timestamp("v", F.lit(casts.TIMESTAMP_FORMAT)),
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for data_type, expected in by_format.items():
            rows = texts.select("v", casts.typed("v", data_type).alias("typed"), expected.alias("expected"))
            assert rows.where("NOT typed <=> expected").collect() == []
            assert rows.where("typed IS NOT NULL").count() > 1
            plan = rows.select("typed")._jdf.queryExecution().optimizedPlan().toString()
            assert "cast(" in plan  # what is laid out so is not left to the format
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_invoices_write_their_day_once(spark, tmp_path):
    days = ["2024-02-29", "0999-01-31", "9999-12-31", "2024-12-31"]
    rows = [(k, k, 1.0, day) for k, day in enumerate(days)]
    orders = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_totalprice double, day string")
    orders = orders.withColumn("o_orderdate", F.col("day").cast("timestamp"))
    orders.drop("day").write.parquet(str(tmp_path / "orders.parquet"))
    found = fixtures.invoices(spark, str(tmp_path)).orderBy("k")
    assert [(r.written, r.period, r.invoice) for r in found.collect()] == [
        (day, day[:7], f"INV-{day[:4]}-{k:06}") for k, day in enumerate(days)
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format" not in plan and plan.count("as string) AS written") == 1


def test_rules_share_what_they_test(spark, scratch):
    w = workspace(spark, SF)
    checked = annotate(w.bronze("gl"), w.rules("gl"), scratch)
    plan = clean(checked)._jdf.queryExecution().executedPlan().toString()
    # Rules stand in a projection below the generator, whose equal parts are evaluated once.
    assert "Generate stack(1, _found" in plan
    assert plan.count("RLIKE(department_code") == 1
    assert plan.index("Generate stack") < plan.index("RLIKE(department_code")
