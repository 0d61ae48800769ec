"""Rejected lines as a table, and records counted without the CSV reader."""

from __future__ import annotations

import csv
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tieout import schemas
from tieout.operators.controls import ControlFailure
from tieout.plans import pipeline
from tieout.sources import extracts, fixtures, lines
from tieout.sources.lakehouse import Lakehouse

HEADER = ",".join(schemas.GL_SOURCE.fieldNames())
SPLITS = "spark.sql.files.maxPartitionBytes"


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode())
    return str(folder)


@pytest.fixture(params=["128m", "64b"])
def splits(request, spark):
    """Whole files, and splits of a few bytes, many of them inside a record."""
    before = spark.conf.get(SPLITS), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(SPLITS, request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield request.param
    spark.conf.set(SPLITS, before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


@pytest.fixture
def files(spark, tmp_path):
    paths = {}
    for name, rows in fixtures.LINES.items():
        paths[name] = str(tmp_path / name)
        extracts.write_extract(rows(spark, "/root/testdata/sf0.001"), paths[name])
    return paths


def row(*cells):
    return ",".join(cells)


def test_bad_lines_are_stored_with_their_places(spark, lake, files, tmp_path):
    good = row(*(["x"] * 13))
    bad = {
        row(*(["1"] * 12)): "too few cells",
        row(*(["2"] * 15)): "too many cells",
        good + ",": "too many cells",
        "": "blank line",
        "  ": "blank line",
        'a,"b' + ",c" * 12: "quote without an end",
        "één,too": "too few cells",
    }
    body = [HEADER, good, *bad, good, row(*(["1"] * 12)), good]
    write(tmp_path / "gl", "zz.csv", "\n".join(body) + "\n")
    write(tmp_path / "gl", "zy.csv", "\r\n".join([HEADER, good, "s,h", good]))
    clean = spark.read.csv(files["ap"], header=True).count()
    pipeline.land_extracts(lake, files, batch_id="b", most_rejected=100)
    found = lake.read("bronze", "gl_rejected").collect()
    assert len(found) == 9 and {(r._dataset, r._batch_id) for r in found} == {("gl", "b")}
    for r in found:
        content = (tmp_path / "gl" / r._source_file.rsplit("/", 1)[1]).read_bytes()
        end = content.find(b"\n", r.line_offset)
        assert content[r.line_offset : end].decode() == r.line
        assert r.reason == bad.get(r.line.rstrip("\r"), "too few cells")
    assert len({(r._source_file, r.line_offset) for r in found}) == 9
    assert lake.read("bronze", "ap_subledger_rejected").count() == 0
    assert lake.read("bronze", "ap_subledger").count() == clean
    held = lake.read("bronze", "gl").count() + 9
    assert held == extracts.source_rows(spark, files["gl"]).first()[0]


@pytest.mark.parametrize("most", [1, 2])
def test_landing_stops_at_the_limit(lake, files, tmp_path, most):
    write(tmp_path / "gl", "zz.csv", f"{HEADER}\n1,2\n\n3\n")
    with pytest.raises(ControlFailure, match="landing gl"):
        pipeline.land_extracts(lake, files, most_rejected=most)
    pipeline.land_extracts(lake, files, most_rejected=3)


def test_offsets_across_splits(spark, tmp_path, splits):
    text = "".join(f"line {i} {'é' * (i % 7)}\n" for i in range(60))
    path = write(tmp_path / "x", "a.csv", text)
    write(tmp_path / "x", "b.csv", "only")
    wanted = F.col("line").rlike("line .?[37] |only")
    found = lines.placed(lines.numbered_lines(spark, path), wanted).collect()
    assert len(found) == 13
    for r in found:
        content = (tmp_path / "x" / r.file.rsplit("/", 1)[1]).read_bytes()
        assert content[r.offset :].startswith(r.line.encode())


CELL = st.text(alphabet='ab,"\n\r ', max_size=6)


@given(st.lists(st.lists(CELL, min_size=2, max_size=3), min_size=1, max_size=25))
@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
def test_records_equal_what_was_written(spark, tmp_path_factory, splits, rows):
    out = io.StringIO()
    writer = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n")
    writer.writerows([["head", "er"], *rows])
    path = write(tmp_path_factory.mktemp("csv"), "a.csv", out.getvalue())
    assert [r.records for r in lines.records(spark, path, '"').collect()] == [len(rows) + 1]


@pytest.mark.parametrize("escape", ["\\", '"'])
def test_records_equal_the_reader(spark, tmp_path, splits, escape):
    quote = escape + '"'
    body = ["id,note,amount"]
    for i in range(30):
        note = ["plain", '"two\nlines"', f'"a {quote}word{quote}\n{quote}"', '"three\n\nlines\n"', '""'][i % 5]
        body.append(f"{i},{note},{i}")
    path = write(tmp_path / "x", "a.csv", "\n".join(body) + "\n")
    write(tmp_path / "x", "b.csv", 'id,note,amount\n1,"a\nb",2')
    source = schemas.T.StructType.fromDDL("id string, note string, amount string")
    read = extracts.read_extract(spark, path, source, "gl", multi_line=True, escape=escape)
    assert read.count() == 31
    whole = extracts.completeness(spark, path, read, "gl", multi_line=True, escape=escape).first()
    assert tuple(whole) == ("gl", 31, 31, True)
    write(tmp_path / "x", "c.csv", "id,note,amount\n7,8,9\n")
    assert not extracts.completeness(spark, path, read.where("id <> '7'"), "gl", True, escape).first().complete


def test_multi_line_landing_is_controlled(spark, lake, files, tmp_path):
    cells = ["x"] * 12
    write(tmp_path / "gl", "zz.csv", f'{HEADER}\n{row(*cells)},"a\nb"\n')
    pipeline.land_extracts(lake, files, multi_line=True, escape='"')
    before = lake.read("bronze", "gl").count()
    write(tmp_path / "gl", "zy.csv", f"{HEADER}\n\n{row(*cells)},z\n")
    with pytest.raises(ControlFailure, match="rows of gl"):
        pipeline.land_extracts(lake, files, multi_line=True, escape='"')
    assert lake.read("bronze", "gl").count() == before
    write(tmp_path / "gl", "zy.csv", f'{HEADER}\n1,"2\n3"\n')
    other = Lakehouse(spark, root=str(tmp_path / "other"))
    pipeline.land_extracts(other, files, multi_line=True, escape='"', most_rejected=5)
    found = other.read("bronze", "gl_rejected").collect()
    assert [(r.line_offset, r.reason) for r in found] == [(None, "too few cells")]
