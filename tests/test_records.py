"""CSV files cut into blocks against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from regloom.sources import records
from regloom.sources.readers import read_source
from regloom.sources.writers import write_csv

CELLS = ["", "a", "b c", "x,y", 'say "hi"', "two\nlines", "three\n\nmore\n", '"', '","', "cr\r\nlf", " lead", "é\u2028ü", "\n", '""']


@pytest.fixture
def small_blocks(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "300")
    yield
    spark.conf.set(name, before)


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def quoted(cell, draw):
    return '"' + cell.replace('"', '""') + '"' if set(cell) & set('",\n\r') or draw.random() < 0.2 else cell


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(2))
def test_blocks_read_as_whole_files(spark, tmp_path, small_blocks, end, seed):
    draw = random.Random(seed)
    for name in ("a", "b"):
        lines = ["id,note,more"]
        for i in range(80):
            cells = [f"{name}{i}", draw.choice(CELLS), draw.choice(CELLS)][: draw.choice([3, 3, 3, 2])]
            lines.append(",".join(quoted(c, draw) for c in cells))
            if draw.random() < 0.1:
                lines.append("")
        (tmp_path / f"{name}.csv").write_text(("\ufeff" if name == "b" and seed else "") + end.join(lines) + (end if seed % 2 else ""), newline="")
    got = read_source(spark, str(tmp_path), "csv")
    whole = spark.read.options(header="true", quote='"', escape='"', multiLine="true").csv(str(tmp_path))
    assert got.columns == ["id", "note", "more"]
    # In a file whose lines end with both characters Spark's reader turns such breaks in cells into line feeds; here they stay.
    plain = [F.replace(c, F.lit("\r\n"), F.lit("\n")).alias(c) if end == "\r\n" else F.col(c) for c in got.columns]
    assert rows_of(got.select(*plain)) == rows_of(whole)


def test_a_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    rows = spark.range(200).selectExpr("concat('r', id) AS id", "concat(repeat('\n', CAST(id % 40 AS INT)), '\"', id) AS note").coalesce(1)
    write_csv(rows, str(tmp_path / "one"))
    marked = []
    real = records.records_of
    records.records_of = lambda m: (marked.append(m), real(m))[1]
    try:
        got = read_source(spark, str(tmp_path / "one"), "csv")
    finally:
        records.records_of = real
    assert marked[0].select("block").distinct().count() > 4 and len(marked[0].inputFiles()) > 1
    assert rows_of(got) == rows_of(rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan and "FileScan text" not in plan  # scanned once


@pytest.mark.parametrize("batch", [10_000, 3])
def test_lines_are_joined_where_they_are(spark, tmp_path, monkeypatch, batch):
    """Only the pieces at the ends of a batch of lines, or of a block, are brought together."""
    rows = spark.range(600).selectExpr("concat('r', id) AS id", "concat('a', repeat('\n', CAST(id % 5 AS INT)), '\"', id) AS note").coalesce(1)
    write_csv(rows, str(tmp_path / "one"))
    made, real, name = {}, records.materialise, "spark.sql.execution.arrow.maxRecordsPerBatch"
    monkeypatch.setattr(records, "materialise", lambda df, purpose: made.setdefault(purpose, real(df, purpose)))
    before = spark.conf.get(name)
    spark.conf.set(name, str(batch))
    try:
        got = read_source(spark, str(tmp_path / "one"), "csv")
    finally:
        spark.conf.set(name, before)
    assert rows_of(got) == rows_of(rows)
    whole = made["csv-joined"].where("whole").count()
    assert whole + made["csv-joined"].where("NOT whole").select("of_block", "of_place").distinct().count() == 480
    assert whole == 480 if batch == 10_000 else 0 < whole < 480


def test_a_cell_that_covers_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f'line "{i}", still' for i in range(100))
    (tmp_path / "x.csv").write_text("k,v\n1,\"" + long.replace('"', '""') + "\"\n2,\"\n\"\n3,plain 5\" pipe\n4,z\n")
    got = {r.k: r.v for r in read_source(spark, str(tmp_path), "csv").collect()}
    assert got == {"1": long, "2": "\n", "3": 'plain 5" pipe', "4": "z"}


def test_headers_schema_and_paths(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,"two\nparts"\n1,x\n')
    (tmp_path / "b.csv").write_text('"two\nparts",other,n\ny,z,2\n')
    (tmp_path / "c.csv").write_text("n\n")
    (tmp_path / "d.csv").write_text("")
    got = read_source(spark, str(tmp_path), "csv", path_column="file").select("*", F.regexp_extract("file", "([^/]*)$", 1).alias("name")).drop("file")
    assert sorted(got.columns) == ["n", "name", "other", "two\nparts"]
    assert {(r.n, r["two\nparts"], r.other, r.name) for r in got.collect()} == {("1", "x", None, "a.csv"), ("2", "y", "z", "b.csv")}
    typed = read_source(spark, str(tmp_path), "csv", schema=spark.createDataFrame([], "n int, none string").schema)
    assert {(r.n, r.none) for r in typed.collect()} == {(1, None), (2, None)}
    bare = read_source(spark, str(tmp_path / "a.csv"), "csv", header="false")
    assert {tuple(r) for r in bare.collect()} == {("n", "two\nparts"), ("1", "x")}
    assert read_source(spark, str(tmp_path / "d.csv"), "csv").collect() == []


def test_lines_that_end_inside_a_cell():
    opens = records.open_cell(",", '"')
    for line, inside in [
        ("", False), ("a,b", False), ('"a', True), ('"a"', False), ('"a""', True), ('a"b', False), ('x,"', True), ('"a"b"c,d', False),
        ('"a","b', True), ('"","""', True), ('""', False), ('"""', True), ('a,,"b""c""', True), ("," * 50_000 + '"', True), ('"' + '""' * 50_000, True),
    ]:
        assert (opens.match(line) is not None) == inside, line[:40]
