"""Publishing by pointer: all tables of a run at once, nothing moved, readers stay valid."""

from __future__ import annotations

import threading

import pytest

from tieout import schemas
from tieout.sources import lakehouse
from tieout.sources.lakehouse import Lakehouse

CARD, RULES = ("gold", "dq_scorecard"), ("gold", "dq_rule_scorecard")


def scores(spark, n):
    row = ("gl", "General Ledger", n, n, 0, 0, None)
    return spark.createDataFrame([row], schemas.ddl(schemas.DQ_SCORECARD).replace(" NOT NULL", ""))


def rules(spark, n):
    row = (f"R{n}", "gl", "amount", "range", "reject", "text", "TRUE", n)
    return spark.createDataFrame([row], schemas.DQ_RULE_SCORECARD)


@pytest.fixture(params=["folder", "catalog"])
def place(request, spark, tmp_path):
    """Makes lakehouses over the same tables, as sessions of their own would."""
    if request.param == "catalog":
        for layer in lakehouse.LAYERS:
            spark.sql(f"DROP DATABASE IF EXISTS spark_catalog.{layer} CASCADE")
        made = {"catalog": "spark_catalog"}
    else:
        made = {"root": str(tmp_path / "lake")}
    Lakehouse(spark, **made).create_layers()
    yield lambda: Lakehouse(spark, work=str(tmp_path / "work"), **made)
    if request.param == "catalog":
        for layer in lakehouse.LAYERS:
            spark.sql(f"DROP DATABASE IF EXISTS spark_catalog.{layer} CASCADE")


def publish(lake, n):
    with lake.staged() as stage:
        stage.write(scores(lake.spark, n), *CARD)
        stage.write(rules(lake.spark, n), *RULES)


def seen(lake):
    return lake.read(*CARD).first().rows_received, lake.read(*RULES).first().rows_rejected


def test_a_run_is_seen_as_a_whole_or_not_at_all(place):
    publish(place(), 1)
    lake = place()
    with lake.staged() as stage:
        stage.write(scores(lake.spark, 2), *CARD)
        assert stage.read(*CARD).first().rows_received == 2
        assert stage.read(*RULES).first().rows_rejected == 1
        assert seen(place()) == (1, 1)
        stage.write(rules(lake.spark, 2), *RULES)
        assert seen(place()) == (1, 1)
    assert seen(place()) == seen(lake) == (2, 2)


def test_a_job_that_dies_between_two_tables_changes_nothing(place):
    publish(place(), 1)
    with pytest.raises(KeyboardInterrupt):
        with place().staged() as stage:
            stage.write(scores(stage.spark, 2), *CARD)
            raise KeyboardInterrupt
    lake = place()
    assert seen(lake) == (1, 1)
    assert len(lake.stored_runs(*CARD)) == 2
    assert lake.expire() == []
    assert lake.expire(unpublished=True) == [stage.location(*CARD)]
    publish(lake, 3)
    assert seen(place()) == (3, 3)


def test_readers_see_one_set_while_others_publish(place):
    publish(place(), 1)
    wrong, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            first, second = seen(place())
            if first != second:
                wrong.append((first, second))

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 5):
        publish(place(), n)
    stop.set()
    reader.join()
    assert not wrong


def test_frames_over_replaced_tables_stay_valid_until_expiry(place):
    publish(place(), 1)
    old = place()
    frame = old.read(*CARD)
    publish(place(), 2)
    assert frame.first().rows_received == 1 and seen(old) == (1, 1)
    old.refresh()
    assert seen(old) == (2, 2)
    publish(place(), 3)
    lake = place()
    assert len(lake.expire(keep=2)) == 2 and seen(old) == (2, 2)
    assert len(lake.expire()) == 2 and seen(lake) == (3, 3)
    assert [len(lake.stored_runs(*t)) for t in (CARD, RULES)] == [1, 1]


def test_unwritten_tables_keep_their_run(place):
    publish(place(), 1)
    place().write(scores(place().spark, 7), *CARD)
    assert seen(place()) == (7, 1)
    versions = [(r.version, r.table) for r in place().log().collect()]
    assert sorted(versions) == [(1, RULES[1]), (1, CARD[1]), (2, CARD[1])]


def test_data_are_written_once_where_they_stay(spark, tmp_path):
    lake = Lakehouse(spark, root=str(tmp_path / "lake"))
    with lake.staged() as stage:
        stage.write(scores(spark, 1), *CARD)
        written = {p: p.stat() for p in (tmp_path / "lake").rglob("*.parquet")}
    assert written and "dq_scorecard/run_" in str(next(iter(written)))
    assert {p: (s.st_ino, s.st_mtime_ns) for p, s in written.items()} == {
        p: (p.stat().st_ino, p.stat().st_mtime_ns) for p in (tmp_path / "lake").rglob("*.parquet")
    }
    log = list((tmp_path / "lake" / "published").glob("*.json"))
    assert len(log) == 1 and len(log[0].read_text().splitlines()) == 1


def test_catalog_names_follow_the_log(spark, tmp_path):
    made = {"catalog": "spark_catalog", "work": str(tmp_path)}
    lake = Lakehouse(spark, **made)
    lake.create_layers()
    publish(lake, 1)
    publish(lake, 2)
    assert spark.table("spark_catalog.gold.dq_scorecard").first().rows_received == 2
    # As after a job that died before it named its tables.
    first = sorted(lake.log().collect(), key=lambda e: e.version)[-3].run
    spark.sql(
        "CREATE OR REPLACE VIEW spark_catalog.gold.dq_scorecard AS"
        f" SELECT * FROM {lake.place(*CARD, first)}"
    )
    assert seen(Lakehouse(spark, **made)) == (2, 2)
    Lakehouse(spark, **made).name_tables()
    assert spark.table("spark_catalog.gold.dq_scorecard").first().rows_received == 2


def test_tables_from_before_the_log_are_read(spark, tmp_path):
    lake = Lakehouse(spark, root=str(tmp_path / "lake"))
    scores(spark, 5).write.parquet(lake.target(*CARD))
    assert lake.read(*CARD).first().rows_received == 5
    lake.write(scores(spark, 6), *CARD)
    assert lake.read(*CARD).first().rows_received == 6
