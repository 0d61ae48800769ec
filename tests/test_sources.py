"""Extracts, tables and fixture views."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieout import schemas, session
from tieout.contract import DEFAULT
from tieout.functions.casts import typed
from tieout.operators.controls import ControlFailure
from tieout.plans import pipeline
from tieout.sources import extracts, fixtures
from tieout.sources.lakehouse import Lakehouse

SOURCE = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "note", "amount")])


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode())
    return str(folder)


def read(spark, path, **options):
    rows = extracts.read_extract(spark, path, SOURCE, "gl", **options)
    return sorted(tuple(r) for r in rows.drop("_source_file", extracts.MALFORMED).collect())


def test_text_is_kept_as_received(spark, tmp_path):
    path = write(tmp_path / "x", "a.csv",
                 'id,note,amount\n1, padded ,007.10\n2,"a, ""b""",N/A\n3,,\n4,"",NULL\n')
    assert read(spark, path, escape='"') == [
        ("1", " padded ", "007.10"), ("2", 'a, "b"', "N/A"), ("3", "", ""), ("4", "", "NULL")
    ]


def test_backslash_escapes_by_default(spark, tmp_path):
    path = write(tmp_path / "x", "a.csv", 'id,note,amount\n1,"a, \\"b\\"",2\n')
    assert read(spark, path) == [("1", 'a, "b"', "2")]


def test_all_columns_are_text(spark, tmp_path):
    path = write(tmp_path / "x", "a.csv", "id,note,amount\n1,2,3\n")
    df = extracts.read_extract(spark, path, SOURCE, "gl")
    assert {f.dataType for f in df.schema} == {T.StringType()}


@pytest.mark.parametrize("header, message", [
    ("id,amount,note", "column 2 should be note, is amount; column 3 should be amount, is note"),
    ("id,note", "column 3 should be amount, is nothing"),
    ("id,note,amount,extra", "column 4 should be nothing, is extra"),
    ("id,note,sum", "column 3 should be amount, is sum"),
])
def test_header_must_match(spark, tmp_path, header, message):
    path = write(tmp_path / "x", "a.csv", header + "\n1,2,3\n")
    with pytest.raises(extracts.HeaderMismatch, match=message):
        extracts.read_extract(spark, path, SOURCE, "gl")


def test_every_file_is_checked(spark, tmp_path):
    write(tmp_path / "x", "a.csv", "id,note,amount\n1,2,3\n")
    path = write(tmp_path / "x", "b.csv", "id,amount,note\n1,2,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        read(spark, path)


def test_completeness_counts_lines_not_rows(spark, tmp_path):
    write(tmp_path / "x", "a.csv", "id,note,amount\n1,2,3\n4,5,6")
    write(tmp_path / "x", "c.csv", "id,note,amount\n")
    path = write(tmp_path / "x", "b.csv", "id,note,amount\n7,8,9\n")
    rows = extracts.read_extract(spark, path, SOURCE, "gl")
    whole = extracts.completeness(spark, path, rows, "gl").first()
    assert tuple(whole) == ("gl", 3, 3, True)
    short = extracts.completeness(spark, path, rows.limit(2), "gl").first()
    assert tuple(short) == ("gl", 3, 2, False)


@pytest.mark.parametrize("multi_line", [False, True])
def test_ragged_lines_are_marked(spark, tmp_path, multi_line):
    write(tmp_path / "x", "a.csv", "id,note,amount\n1,2,3\n,,\n")
    path = write(tmp_path / "x", "b.csv", "id,note,amount\n1,2,3,4\n5,6\n")
    rows = extracts.read_extract(spark, path, SOURCE, "gl", multi_line=multi_line)
    marked = {r.id for r in rows.collect() if r[extracts.MALFORMED] is not None}
    assert marked == {"1", "5"} and rows.count() == 4


def test_quoted_line_breaks_need_multi_line(spark, tmp_path):
    path = write(tmp_path / "x", "a.csv", 'id,note,amount\n1,"two\nlines",3\n')
    assert read(spark, path, multi_line=True) == [("1", "two\nlines", "3")]
    assert len(read(spark, path)) == 2


def test_padding_survives_the_writer(spark, tmp_path):
    df = spark.createDataFrame([("1", " d100 ", ""), ("2", "a,b", 'q"q')], SOURCE)
    extracts.write_extract(df, str(tmp_path / "out"))
    assert read(spark, str(tmp_path / "out")) == [("1", " d100 ", ""), ("2", "a,b", 'q"q')]


def test_lineage_names_each_file(spark, tmp_path):
    write(tmp_path / "x", "a.csv", "id,note,amount\n1,2,3\n")
    path = write(tmp_path / "x", "b.csv", "id,note,amount\n1,2,3\n")
    rows = extracts.with_lineage(extracts.read_extract(spark, path, SOURCE, "gl"), "batch")
    found = {(r._source_file.rsplit("/", 1)[1], r._batch_id) for r in rows.collect()}
    assert found == {("a.csv", "batch"), ("b.csv", "batch")}
    assert all(r._ingested_at for r in rows.collect())


# --- casts -----------------------------------------------------------------------------


def test_casts_read_or_give_null(spark):
    df = spark.createDataFrame(
        [(" a ", "2026-03-14", "2026-08-01T02:15:00Z", "10.255", "30", "true"),
         ("", "2026-02-31", "2026-08-01", "N/A", "x", "maybe"),
         (None, "14.03.2026", "", "", "", "")],
        "s string, d string, t string, m string, i string, b string",
    )
    types = dict(s=T.StringType(), d=T.DateType(), t=T.TimestampType(),
                 m=schemas.MONEY, i=T.IntegerType(), b=T.BooleanType())
    rows = df.select(*[typed(c, t).cast("string").alias(c) for c, t in types.items()]).collect()
    assert tuple(rows[0]) == ("a", "2026-03-14", "2026-08-01 02:15:00", "10.26", "30", "true")
    assert tuple(rows[1]) == ("", None, None, None, None, None)
    assert tuple(rows[2])[1:] == (None,) * 5
    with pytest.raises(ValueError, match="no cast"):
        typed("s", T.DoubleType())


# --- declarations and tables -------------------------------------------------------------


def test_declarations():
    assert len(schemas.TABLES) == 11
    for name, source in schemas.SOURCES.items():
        landed = schemas.bronze(source)
        assert {f.dataType for f in landed if not f.name.startswith("_")} == {T.StringType()}
        refined = schemas.silver(source)
        assert refined.names == landed.names
        assert refined["amount"].dataType == schemas.MONEY and not refined["amount"].nullable
        rejected = schemas.quarantine(source)
        assert rejected.names[: len(landed)] == landed.names
    for schema in schemas.TABLES.values():
        assert all(f.metadata["comment"] for f in schema)
        assert not any(isinstance(f.dataType, (T.DoubleType, T.FloatType)) for f in schema)
        back = T.StructType.fromDDL(schemas.ddl(schema))
        assert [(f.name, f.dataType, f.nullable) for f in back] == [
            (f.name, f.dataType, f.nullable) for f in schema
        ]


def scores(spark, n):
    row = ("gl", "General Ledger", n, n, 0, 0, None)
    return spark.createDataFrame([row], schemas.ddl(schemas.DQ_SCORECARD).replace(" NOT NULL", ""))


def test_writing_replaces_and_reads_back(spark, lake):
    lake.write(scores(spark, 1), "gold", "dq_scorecard")
    stored = lake.write(scores(spark, 2), "gold", "dq_scorecard")
    assert [r.rows_received for r in stored.collect()] == [2]
    assert stored.columns == schemas.DQ_SCORECARD.fieldNames()
    assert lake.target("gold", "dq_scorecard") == f"{lake.root}/gold/dq_scorecard"


def test_undeclared_columns_are_not_stored(spark, lake):
    stored = lake.write(scores(spark, 1).withColumn("extra", F.lit(1)), "gold", "dq_scorecard")
    assert "extra" not in stored.columns
    with pytest.raises(ValueError, match="label"):
        lake.write(scores(spark, 1).drop("label"), "gold", "dq_scorecard")


def test_catalog_tables(spark):
    lake = Lakehouse(spark, catalog="spark_catalog")
    lake.create_layers()
    stored = lake.write(scores(spark, 3), "gold", "dq_scorecard")
    assert stored.first().rows_received == 3
    assert lake.target("gold", "dq_scorecard") == "spark_catalog.gold.dq_scorecard"
    described = spark.sql("DESCRIBE TABLE spark_catalog.gold.dq_scorecard").collect()
    assert [(r.col_name, r.data_type) for r in described] == [
        (f.name, f.dataType.simpleString()) for f in schemas.DQ_SCORECARD
    ]
    assert described[0].comment == "gl or ap."


def test_lakehouse_needs_one_place(spark):
    with pytest.raises(ValueError):
        Lakehouse(spark)


def test_work_folder_follows_the_session(spark):
    assert session.run_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.run_folder(spark) != session.run_folder(spark)


def test_sizing_grows_with_the_input():
    partitions, split = "spark__sql__shuffle__partitions", "spark__sql__files__maxPartitionBytes"
    small, large = session.sizing(1 << 30, 8), session.sizing(1 << 40, 400)
    huge = session.sizing(100 << 40, 4000)
    assert [int(x[partitions]) for x in (small, large, huge)] == [16, 1024, 102_400]
    assert (100 << 40) / 4 / int(huge[partitions]) == 256 << 20
    assert int(small[split]) == int(large[split]) == 128 << 20
    assert int(huge[split]) == (100 << 40) // 50_000


def test_active_session_takes_settings_or_raises(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.build_session(spark__sql__shuffle__partitions=7) is spark
        assert spark.conf.get("spark.sql.shuffle.partitions") == "7"
        with pytest.raises(ValueError, match="spark.driver.memory"):
            session.build_session(spark__driver__memory="77g")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# --- the whole way from files ---------------------------------------------------------------


@pytest.fixture
def files(spark, tmp_path):
    paths = {}
    for name, lines in fixtures.LINES.items():
        paths[name] = str(tmp_path / name)
        extracts.write_extract(lines(spark, "/root/testdata/sf0.001"), paths[name])
    return paths


def test_pipeline_from_files(spark, lake, files):
    pipeline.run(lake, files)
    counts = {r.break_status: r["count"] for r in
              lake.read("gold", "recon_detail").groupBy("break_status").count().collect()}
    assert counts == {
        "MATCHED": 1248, "AMOUNT_MISMATCH": 64, "TIMING_DIFFERENCE": 32,
        "MISSING_FROM_SUBLEDGER": 34, "MISSING_FROM_GL": 32, "DUPLICATE_IN_SUBLEDGER": 60,
    }
    for (layer, table), schema in schemas.TABLES.items():
        stored = lake.read(layer, table)
        assert [(f.name, f.dataType) for f in stored.schema] == [
            (f.name, f.dataType) for f in schema
        ]
        assert stored.count() > 0
    lake.register_views()
    keys = spark.sql("SELECT sum(key_count) AS n FROM gold_recon_summary").first().n
    assert keys == spark.sql("SELECT * FROM gold_recon_detail").count() == 1470


def test_pipeline_into_a_catalog(spark, files):
    lake = Lakehouse(spark, catalog="spark_catalog")
    pipeline.run(lake, files)
    assert lake.read("gold", "recon_detail").count() == 1470
    assert lake.read("gold", "recon_exceptions").count() == 222


def test_blank_line_stops_the_landing(lake, files, tmp_path):
    with open(f"{files['gl']}/zz.csv", "w") as handle:
        handle.write(",".join(schemas.GL_SOURCE.names) + "\n\n")
    with pytest.raises(ControlFailure, match="rows of gl"):
        pipeline.land_extracts(lake, files)


def test_lost_values_stop_the_refining(spark, lake):
    """A well-formed date that does not exist passes its rule."""
    gl = fixtures.gl_lines(spark, "/root/testdata/sf0.001")
    ap = fixtures.ap_lines(spark, "/root/testdata/sf0.001")
    odd = gl.withColumn("posting_date", F.when(F.col("gl_entry_id") == "GL000000000", "2026-02-31")
                        .otherwise(F.col("posting_date")))
    pipeline.land_frames(lake, {"gl": odd, "ap": ap}, "memory")
    with pytest.raises(ControlFailure, match="posting_date"):
        pipeline.refine(lake, DEFAULT)


@pytest.mark.parametrize("line", ["surplus", "missing"])
def test_ragged_extracts_do_not_land(spark, lake, files, tmp_path, line):
    header = ",".join(schemas.GL_SOURCE.fieldNames())
    cells = ["1"] * (len(schemas.GL_SOURCE) + (2 if line == "surplus" else -1))
    write(tmp_path / "gl", "ragged.csv", header + "\n" + ",".join(cells) + "\n")
    with pytest.raises(ControlFailure, match="landing gl: 1 lines"):
        pipeline.land_extracts(lake, files)


@pytest.mark.parametrize("place", ["folder", "catalog"])
def test_failing_controls_leave_the_tables_as_they_were(spark, tmp_path, files, place):
    if place == "folder":
        lake = Lakehouse(spark, root=str(tmp_path / "lake"))
    else:
        lake = Lakehouse(spark, catalog="spark_catalog")
    pipeline.land_extracts(lake, files, batch_id="good")
    pipeline.refine(lake)
    if place == "folder":
        assert not list((tmp_path / "lake" / "_work").iterdir())
    before = lake.read("silver", DEFAULT.datasets["gl"].table).count()
    header = ",".join(schemas.GL_SOURCE.fieldNames())
    write(tmp_path / "gl", "ragged.csv", header + "\n1,2\n")
    with pytest.raises(ControlFailure):
        pipeline.land_extracts(lake, {"gl": files["gl"]}, batch_id="bad")
    bronze = lake.read("bronze", DEFAULT.datasets["gl"].table)
    assert {r["_batch_id"] for r in bronze.select("_batch_id").distinct().collect()} == {"good"}
    assert lake.read("silver", DEFAULT.datasets["gl"].table).count() == before > 0


def test_another_table_format(spark, tmp_path, files):
    lake = Lakehouse(spark, root=str(tmp_path / "orc-lake"), table_format="orc")
    pipeline.land_extracts(lake, files)
    pipeline.refine(lake)
    folder = tmp_path / "orc-lake" / "silver" / DEFAULT.datasets["gl"].table
    assert list(folder.rglob("*.orc")) and not list(folder.rglob("*.parquet"))
    assert lake.read("silver", DEFAULT.datasets["gl"].table).count() > 0
