import bz2
import csv
import json
import random
import re
import zipfile
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.functions.keys import as_timestamp, content_type, layout_key, raw_key, rules_key, target_key
from regloom.jurisdictions import layout_for, rules_for
from regloom.operators import ledger as ledger_ops
from regloom.operators.files import files_diff, group_paths, load_manifest, manifest_files, plan_workload, size_range
from regloom.operators.ledger import ledger_filter, ledger_transition, ledger_upsert, new_items
from regloom.operators.metadata import (
    backfill,
    backfill_dry_run,
    is_metadata_set,
    join_file_metadata,
    mapping_labels,
    parse_labels,
    render_metadata,
    stamp_metadata,
)
from regloom.operators.normalize import normalize_company, share_view
from regloom.operators.parse import parse_fixed_width
from regloom.operators.rows import head_samples, sample_path
from regloom.operators.schema import add_missing_columns, append_evolving, append_quarantine, encode_json
from regloom.operators.types import promoted
from regloom.operators.validate import is_date_valid, route_counts, rows_valid, split_by_dates, with_route
from regloom.plans.compiler import map_to_cdm
from regloom.plans.model import CDM, CDM_FIELDS, lake_schema, timestamp_fields
from regloom.plans.versions import load_rule_book, map_by_version, used_rules
from regloom.sources import writers
from regloom.sources.archives import expand_archives, list_members, read_archives
from regloom.sources.inventory import file_inventory, filter_files, route_files
from regloom.sources.readers import read_json_lines, read_source
from regloom.sources.writers import append_routes, bulk_projection, write_csv, write_routes
from regloom.streaming.ingest import ingest_available, records_from_lines, records_from_rows, stream_lines, stream_rows, without_redelivered


def one(spark, column):
    return spark.range(1).select(column.alias("v")).head()[0]


# --- validity ---

ISO, US, FL = "%Y-%m-%d", "%m/%d/%Y", "%m%d%Y"
VALIDITY = [
    ({"r": {"value": "2021-01-01", "python_date_format": ISO}}, True, True),
    ({"r": {"value": "2021-01-01", "python_date_format": ISO}, "s": {"value": "x", "python_date_format": US}}, True, True),
    ({"r": "foo"}, False, False),
    ({"r": {"value": "2021-02-31", "python_date_format": ISO}}, False, False),
    ({"r": {"value": "2021", "python_date_format": FL}}, False, False),
    ({"r": {"value": "202101", "python_date_format": FL}}, False, False),
    ({"r": {"value": "21", "python_date_format": FL}}, False, False),
    ({"r": {"python_date_format": US}}, False, False),
    ({"r": {"value": "12/31/2021"}}, False, False),
    ({"r": {"value": None, "python_date_format": None}}, False, True),
    ({"r": {}}, False, True),
    ({"r": {"value": "", "python_date_format": ""}}, False, True),
    ({"r": {"value": None, "python_date_format": ISO}}, False, False),
    ({"r": {"value": "2021-01-01", "python_date_format": None}}, False, False),
    ({}, False, False),
]


@pytest.mark.parametrize("no_data_ok", [False, True])
def test_validity_of_json_text(spark, no_data_ok):
    rows = [(i, json.dumps(v)) for i, (v, _, _) in enumerate(VALIDITY)] + [(100, None), (101, ""), (102, "{broken")]
    df = spark.createDataFrame(rows, "id int, d string")
    got = {r.id: r.ok for r in df.select("id", is_date_valid(df, "d", no_data_ok).alias("ok")).collect()}
    for i, (_, strict, lax) in enumerate(VALIDITY):
        assert got[i] is (lax if no_data_ok else strict), VALIDITY[i]
    assert got[100] is no_data_ok and got[101] is no_data_ok and got[102] is False


@pytest.mark.parametrize("no_data_ok", [False, True])
def test_validity_of_maps(spark, no_data_ok):
    cases = [c for c in VALIDITY if c[0] and isinstance(c[0]["r"], dict)]
    rows = [(i, {k: (e.get("value"), e.get("python_date_format")) for k, e in v.items()}) for i, (v, _, _) in enumerate(cases)]
    df = spark.createDataFrame(rows + [(100, None), (101, {})], "id int, d map<string,struct<value:string,python_date_format:string>>")
    got = {r.id: r.ok for r in df.select("id", is_date_valid(df, "d", no_data_ok).alias("ok")).collect()}
    for i, (_, strict, lax) in enumerate(cases):
        assert got[i] is (lax if no_data_ok else strict), cases[i]
    assert got[100] is no_data_ok and got[101] is no_data_ok


def test_first_written_entry_decides(spark):
    kind = "struct<value:string,python_date_format:string>"
    rows = [
        (1, (("2021-01-01", ISO), ("x", ISO))),
        (2, (None, ("x", ISO))),
        (3, (None, ("2021-01-01", ISO))),
        (4, (("x", ISO), ("2021-01-01", ISO))),
        (5, None),
    ]
    df = spark.createDataFrame(rows, f"id int, d struct<a:{kind},b:{kind}>")
    first = df.select("id", is_date_valid(df, "d").alias("ok"), is_date_valid(df, "d", mode="all").alias("every")).collect()
    assert {r.id: r.ok for r in first} == {1: True, 2: False, 3: True, 4: False, 5: False}
    assert {r.id: r.every for r in first} == {1: False, 2: False, 3: True, 4: False, 5: False}


ROW_DATES = [
    ("1", "%H"), ("2020.02.28", "%Y.%m.%d"), ("2020.02.30", "%Y.%m.%d"), ("x", "%Q"), ("3 feb 99", "%d %b %y"), ("100%", "100%%"),
    ("Monday, 3  February 1969", "%A, %d %B %Y"), ("1.2", "%m.%m"), ("2020", "%Y%"), ("a+b 2020", "a+b %Y"), ("68", "%y"),
    ("2021-06-07T08:09:10.5Z", "%Y-%m-%dT%H:%M:%S.%f%z"), ("0000-01-01", "%Y-%m-%d"), ("(5) 2020", "(%d) %Y"), ("07:30 PM", "%I:%M %p"),
]


def test_a_format_named_by_the_row_is_judged(spark):
    """Any format of Python's is, a bad one is one nothing parses under, and no row stops the job."""
    rows = [(i, json.dumps({"a": {"value": v, "python_date_format": f}})) for i, (v, f) in enumerate(ROW_DATES)]
    df = spark.createDataFrame(rows, "id int, d string")
    got = {r.id: r.ok for r in df.select("id", is_date_valid(df, "d", formats=["%H"]).alias("ok")).collect()}
    for i, (value, fmt) in enumerate(ROW_DATES):
        try:
            expected = bool(datetime.strptime(value, fmt))
        except (ValueError, re.error):  # Python has no rule for a repeated directive but its pattern's
            expected = False
        assert got[i] is expected, (value, fmt)


def test_split(spark):
    def entry(v, f):
        return json.dumps({"f": {"value": v, "python_date_format": f}})

    rows = [(1, entry("01012021", FL), entry("2021-02-30", ISO)), (2, entry("01012021", FL), entry("2021-01-01", ISO)), (3, None, None)]
    df = spark.createDataFrame(rows, "id int, incorporation_date string, dissolution_date string")
    fields = ["incorporation_date", "dissolution_date"]
    valid, invalid = split_by_dates(df, fields, no_data_ok=False)
    assert [r.id for r in valid.collect()] == [2] and sorted(r.id for r in invalid.collect()) == [1, 3]
    valid, invalid = split_by_dates(df, fields)
    assert sorted(r.id for r in valid.collect()) == [2, 3] and [r.id for r in invalid.collect()] == [1]
    assert df.filter(rows_valid(df, [])).count() == 3
    counts = {r._route: r.rows for r in route_counts(with_route(df, fields)).collect()}
    assert counts == {"valid": 2, "invalid": 1}


# --- keys ---


def test_keys(spark):
    day = F.lit(datetime(2031, 1, 9))
    assert one(spark, target_key("im", day, "in/ships/anna.csv", index=12)) == "im/2031/1/9/anna_12.csv"
    assert one(spark, target_key("im", day, "anna.csv.bz2", index=2, add_file_name_as_prefix=True)) == "im/2031/1/9/anna/anna_2.csv"
    assert one(spark, target_key("im", day, "in/anna.jsonl", "json", 3)) == "im/2031/1/9/anna_3.json"
    assert one(spark, target_key("im", day, "in/anna", "parquet")) == "im/2031/1/9/anna.parquet"
    assert one(spark, target_key("im", day)) == "im/2031/1/9/anon.csv"
    assert one(spark, target_key("im", day, "in/b.c.d", index=-1, suffix="invalid")) == "im/2031/1/9/b_invalid.csv"
    assert one(spark, target_key("im", day, "in/b", filename="x.y")) == "im/2031/1/9/x.csv"
    assert one(spark, target_key("im", None, "z.csv", index=1)).endswith("/z_1.csv")

    assert one(spark, raw_key("landing/ships", "anna.txt", F.lit("2031-01-09T23:59:59"), "iso")) == "landing/ships/2031/01/09/anna.txt"
    assert one(spark, raw_key("", "b.txt", F.lit("1999-11-30T00:00:01"), "text")) == "/1999/11/30/b.txt"
    assert one(spark, raw_key("p", "f", F.lit(951782400), "epoch")) == "p/2000/02/29/f"
    now = F.lit(datetime(2020, 2, 3))
    assert one(spark, raw_key("p", "f", F.lit(0), "epoch", now)) == "p/2020/02/03/f"
    assert one(spark, raw_key("p", "f", F.lit(None).cast("string"), "iso", now)) == "p/2020/02/03/f"

    assert one(spark, rules_key("us_fl", "json")) == "cdm_mapping_rules/us_fl/json/latest/cdm_mapping_us_fl.json"
    assert one(spark, rules_key("FR", "CSV", "v2")) == "cdm_mapping_rules/fr/csv/v2/cdm_mapping_fr.json"
    assert one(spark, rules_key("im", "Json_lines")) == "cdm_mapping_rules/im/jsonlines/latest/cdm_mapping_im.json"
    assert one(spark, layout_key("US_FL")) == "fixed_width_field_def/us_fl/latest/us_fl.json"
    assert content_type("Json_Lines") == "json_lines" and content_type("text/csv") == "csv"
    with pytest.raises(ValueError):
        content_type("xml")


# --- file sets ---


def files(spark, *rows):
    return spark.createDataFrame([(r if isinstance(r, tuple) else (r, None)) for r in rows], "name string, timestamp string")


def names(df):
    return sorted(r.name for r in df.collect())


def test_files_diff(spark):
    source = files(spark, "file1.txt", "file2.txt", "file3.txt")
    assert names(files_diff(source, source)) == []
    assert names(files_diff(source, files(spark, "file4.txt"))) == ["file1.txt", "file2.txt", "file3.txt"]
    assert names(files_diff(source, files(spark, "file2.txt", "file4.txt"))) == ["file1.txt", "file3.txt"]
    assert names(files_diff(source.limit(0), source)) == []


def test_files_diff_by_time(spark):
    source = files(spark, ("file1.txt", "2021-01-01T00:00:00"), ("file2.txt", "2023-01-01T00:00:00"), ("file3.txt", "1609459300"))
    target = files(spark, ("file1.txt", "2020-01-01T00:00:00"), ("file2.txt", "1609459300"), ("file3.txt", None))
    assert len(names(files_diff(source, target, True, kind="text"))) == 3
    target = files(spark, ("file1.txt", "2020-01-01T00:00:00"), ("file2.txt", "1609459300"), ("file3.txt", "2021-01-01T00:01:40"))
    assert names(files_diff(source, target, True, kind="text")) == ["file1.txt", "file2.txt"]
    source = files(spark, "file1.txt", ("file2.txt", "1609459300"), ("file3.txt", "1609459400"))
    assert names(files_diff(source, source, True, kind="text")) == ["file1.txt"]
    assert len(names(files_diff(source, source.limit(0), True, kind="text"))) == 3


def test_last_of_equal_target_names_counts(spark):
    source = files(spark, ("a", "5"))
    target = spark.createDataFrame([("a", "9", 1), ("a", "5", 2)], "name string, timestamp string, n int")
    assert names(files_diff(source, target, True, kind="text", order="n")) == []
    assert names(files_diff(source, target, True, kind="text")) == ["a"]


def test_inventory(spark, tmp_path):
    for f in ("p/a.txt", "p/b.log", "p/q/c.txt", "r/d.csv.bz2", "r/d_invalid.csv.bz2"):
        (tmp_path / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f).write_text("xyz")
    found = file_inventory(spark, str(tmp_path))
    assert sorted(r.key for r in found.collect()) == ["p/a.txt", "p/b.log", "p/q/c.txt", "r/d.csv.bz2", "r/d_invalid.csv.bz2"]
    row = found.filter("name = 'c.txt'").head()
    assert (row.path, row["size"]) == ("p/q", 3) and row.timestamp is not None
    assert names(file_inventory(spark, str(tmp_path), "p", [".txt"])) == ["a.txt", "c.txt"]
    assert names(file_inventory(spark, str(tmp_path), names=["b.log", "zzz"])) == ["b.log"]
    assert names(filter_files(found, "p/a.txt")) == ["a.txt"]
    routes = {r.name: r._route for r in route_files(found).collect()}
    assert routes == {"d.csv.bz2": "valid", "d_invalid.csv.bz2": "invalid"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


MANIFEST = "ingest_config string, jurisdiction string, source_path string, target_path string, file_pattern string, file_names string, periodicity string, check_timestamp boolean"


def test_plan_workload(spark):
    manifest = spark.createDataFrame(
        [
            ("us_fl", "us_fl", "doc/cor", "us_fl", ".txt", None, "daily", False),
            ("us_fl_q", "us_fl", "doc/Quarterly", "hist", None, "cordata.zip,extra.zip", "quarterly", True),
        ],
        MANIFEST,
    )
    inventory = spark.createDataFrame(
        [
            ("doc/cor", "1.txt", 10), ("doc/cor", "2.txt", 10), ("doc/cor", "x.zip", 10),
            ("doc/Quarterly", "cordata.zip", 20), ("doc/Quarterly", "extra.zip", 30), ("doc/Quarterly", "no.zip", 1),
        ],
        "path string, name string, timestamp long",
    )
    landed = spark.createDataFrame(
        [("us_fl/2024/01/01", "1.txt", 1), ("hist/2024/01/01", "cordata.zip", 20), ("hist/2024/01/01", "extra.zip", 29), ("other", "2.txt", 10)],
        "path string, name string, timestamp long",
    )
    got = plan_workload(manifest, inventory, landed, kind="epoch").collect()
    assert sorted((r.object_key, r.ingest_config, r.timestamp, r.status, r.periodicity) for r in got) == [
        ("doc/Quarterly/extra.zip", "us_fl_q", 30, "NEW", "quarterly"),
        ("doc/cor/2.txt", "us_fl", 0, "NEW", "daily"),
    ]
    both = spark.createDataFrame([("bad", "us_fl", "doc/cor", "t", ".txt", "a", "daily", False)], MANIFEST)
    with pytest.raises(PySparkException, match="either"):
        plan_workload(both, inventory, landed, kind="epoch").collect()


def test_group_paths_cuts_a_hot_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("object_key"),
        F.lit("t").alias("target"), F.col("id").cast("string").alias("path"),
    )
    got = group_paths(df, max_paths=100).collect()
    assert sorted(int(p) for r in got for p in r.paths) == list(range(3000))
    hot = [r for r in got if r.object_key == "hot"]
    assert len(hot) == 10 and max(len(r.paths) for r in hot) < 160
    assert all(r.part == 0 for r in got if r.object_key != "hot")


def test_size_range(spark):
    df = spark.createDataFrame([("0",), ("12",), ("9",)], "size string")
    assert tuple(size_range(df).head()) == (9, 12)


# --- ledger ---


def ledger(spark):
    rows = [("b/1", "NEW", "t0"), ("b/2", "PREPARING", "t0"), ("c/3", None, "t0"), ("c/4", "PROCESSED", "t0")]
    return spark.createDataFrame(rows, "object_key string, status string, timestamp string")


def test_ledger(spark):
    tasks = ledger(spark)
    assert [r.object_key for r in ledger_filter(tasks, "b/").collect()] == ["b/1", "b/2"]
    assert [r.object_key for r in ledger_filter(tasks, "b/", "NEW").collect()] == ["b/1"]
    assert [r.object_key for r in ledger_filter(tasks, limit=2).collect()] == ["b/1", "b/2"]
    assert sorted(r.object_key for r in new_items(tasks).collect()) == ["b/1", "c/3"]
    assert [r.object_key for r in new_items(tasks, 1).collect()] == ["b/1"]


def test_guarded_transitions(spark):
    changes = spark.createDataFrame(
        [("b/1", "PREPARING", "NEW", "t1"), ("b/2", "PROCESSING", "NEW", "t1"), ("c/4", "ERROR", None, "t1"), ("zz", "NEW", None, "t1")],
        "object_key string, to_status string, from_status string, timestamp string",
    )
    got = {r.object_key: (r.status, r.timestamp, r.applied) for r in ledger_transition(ledger(spark), changes).collect()}
    assert got == {
        "b/1": ("PREPARING", "t1", True), "b/2": ("PREPARING", "t0", False),
        "c/3": (None, "t0", None), "c/4": ("ERROR", "t1", True),
    }
    timed = spark.createDataFrame([("b/1", "X", "NEW", "t9"), ("b/2", "Y", "PREPARING", "t0")], changes.schema)
    got = {r.object_key: r.status for r in ledger_transition(ledger(spark), timed, match_timestamp=True).collect()}
    assert got["b/1"] == "NEW" and got["b/2"] == "Y"


def test_upsert(spark):
    added = spark.createDataFrame([("b/1", "DONE", "t2"), ("n", "NEW", "t2")], "object_key string, status string, timestamp string")
    got = {r.object_key: r.status for r in ledger_upsert(ledger(spark), added).collect()}
    assert got == {"b/1": "DONE", "b/2": "PREPARING", "c/3": None, "c/4": "PROCESSED", "n": "NEW"}


# --- metadata ---


def test_metadata(spark):
    assert is_metadata_set(["a", "b"], {"a": None}) and not is_metadata_set(["b"], {"a": 1}) and not is_metadata_set([], {"a": 1})
    with pytest.raises(ValueError):
        is_metadata_set(["a"], None)
    df = spark.createDataFrame([("x", None), (None, "y")], "a string, b string")
    got = stamp_metadata(df, {"a": "m", "c": "n"}).collect()
    assert [tuple(r) for r in got] == [("x", None, "n"), ("m", "y", "n")]
    meta = spark.createDataFrame([("f1", None, "raw.txt", datetime(2024, 1, 2, 3, 4, 5), "?"), ("f2", "s", "raw", None, "?")],
                                 "path string, source_name string, fetched_file string, fetched_at timestamp, extra string")
    rows = spark.createDataFrame([("f1", 1), ("f2", 2), ("f3", 3)], "path string, n int")
    joined = join_file_metadata(rows, meta)
    shown = joined.select("n", *[c.alias(k) for k, c in render_metadata(meta, "_file").items()]).orderBy("n").collect()
    assert [(r.source_name, r.fetched_at) for r in shown] == [("raw.txt", "2024-01-02T03:04:05"), ("s", None), (None, None)]
    assert "extra" not in shown[0].asDict() and "fetched_file" not in shown[0].asDict()
    assert parse_labels(layout_for("us_fl"), "us_fl", "T") == {"parsed_by": "us_fl_fixed_width_field_def_0.1", "parsed_at": "T", "target": "src_us_fl"}
    assert mapping_labels(rules_for("im"), "me", "T")["cdm_mapping_rules"] == "cdm_mapping_im:0.1"


def test_backfill(spark):
    df = spark.createDataFrame([("a/x.txt", "old"), ("a/y.txt", ""), ("a/z.txt", None)], "path string, source_name string")
    assert [r.source_name for r in backfill(df, "source_name").collect()] == ["old", "y.txt", "z.txt"]
    assert [r.source_name for r in backfill(df, "source_name", overwrite=True).collect()] == ["x.txt", "y.txt", "z.txt"]
    assert [r.periodicity for r in backfill(df, "periodicity", "daily").collect()] == ["daily"] * 3
    assert not any(r.changed for r in backfill(df, "periodicity", "").collect())
    assert [r.path for r in backfill_dry_run(df, "source_name").collect()] == ["a/y.txt", "a/z.txt"]


# --- sinks and sources ---


def test_encode_json(spark):
    df = spark.sql("select 'v' a, named_struct('b', 1, 'c', cast(null as string)) s, array('x','y') l, map('k', array(1)) m, 5 n")
    assert encode_json(df).head().asDict() == {"a": "v", "s": '{"b":1}', "l": '["x","y"]', "m": '{"k":[1]}', "n": 5}


def test_csv_round_trip_and_python_csv(spark, tmp_path):
    import csv

    df = spark.createDataFrame([('a "q", b', '{"k":"v,1"}', None), ("x", "é", "")], "a string, b string, c string")
    write_csv(df.coalesce(1), str(tmp_path / "out"))
    back = read_source(spark, str(tmp_path / "out"), "csv")
    assert {(r.a, r.b) for r in back.collect()} == {('a "q", b', '{"k":"v,1"}'), ("x", "é")}
    part = next((tmp_path / "out").glob("part-*.csv"))
    with open(part, encoding="utf-8", newline="") as f:
        assert {(r["a"], r["b"]) for r in csv.DictReader(f)} == {('a "q", b', '{"k":"v,1"}'), ("x", "é")}
    write_csv(df, str(tmp_path / "bz"), compression="bzip2")
    assert read_source(spark, str(tmp_path / "bz"), "text/csv").count() == 2
    write_csv(spark.range(10).coalesce(1), str(tmp_path / "cut"), max_rows=3)
    assert len(list((tmp_path / "cut").glob("part-*.csv"))) == 4


def test_read_formats(spark, tmp_path):
    (tmp_path / "a.csv.bz2").write_bytes(bz2.compress(b"x,y\n1,\n2\n3,4,5\n"))
    got = read_source(spark, str(tmp_path / "a.csv.bz2"), "csv").collect()
    assert [(r.x, r.y) for r in got] == [("1", None), ("2", None), ("3", "4")]
    (tmp_path / "b.jsonl").write_text('{"a":"1"}\n\n{"a":"2","l":[{"x":"y"}]}\n')
    assert read_source(spark, str(tmp_path / "b.jsonl"), "json_lines").count() == 2
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert read_source(spark, str(tmp_path / "p"), "parquet").count() == 3
    (tmp_path / "deep/er").mkdir(parents=True)
    (tmp_path / "deep/er/c.csv").write_text("x\n1\n")
    assert read_source(spark, str(tmp_path / "deep"), "csv", recursive=True).count() == 1


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        z.writestr("cor0.txt", "a\r\nb\n\nc")
        z.writestr("sub/cor1.x.txt", "d\n")
        z.writestr("empty.txt", "")
    archives = read_archives(spark, str(tmp_path))
    got = expand_archives(archives).collect()
    assert sorted((r.member, r.source_name, r.value) for r in got) == [
        ("cor0.txt", "cor0", ""), ("cor0.txt", "cor0", "a"), ("cor0.txt", "cor0", "b"), ("cor0.txt", "cor0", "c"), ("sub/cor1.x.txt", "cor1", "d"),
    ]
    members = {r.member: (r.key.rsplit("/", 2)[-1], r["size"]) for r in list_members(archives).collect()}
    assert members["cor0.txt"] == ("cor0.txt", 7) and len(members) == 3


def test_only_the_directory_and_own_members_of_an_archive_are_read(spark, tmp_path, monkeypatch):
    """A file with a hole of 5 GB between its members: neither the listing nor a member's lines read through it."""
    import struct

    path = tmp_path / "with blank, large.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("first.txt", "one\ntwo\n")
        z.writestr("dir/", "")
        with z.open("far.txt", "w", force_zip64=True) as f:
            f.write(b"three\n" * 1000)
    # The same archive with its directory moved behind a hole, as a large member would push it.
    data, hole = path.read_bytes(), 5 << 30
    end = data.rindex(b"PK\x05\x06")
    size, start = struct.unpack("<LL", data[end + 12 : end + 20])
    with open(path, "wb") as f:
        f.write(data[:start])
        f.seek(start + hole)
        f.write(data[start : start + size])
        f.write(struct.pack("<4sQHHLLQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 3, 3, size, start + hole))
        f.write(struct.pack("<4sLQL", b"PK\x06\x07", 0, start + hole + size, 1))
        f.write(struct.pack("<4sHHHHLLH", b"PK\x05\x06", 0, 0, 3, 3, size, 0xFFFFFFFF, 0))
    archives = read_archives(spark, str(tmp_path))
    assert archives.columns == ["archive", "bytes"] and archives.first()["bytes"] > hole
    members = list_members(archives)
    assert {(r.member, r["size"], r.source_name) for r in members.collect()} == {("first.txt", 8, "first"), ("far.txt", 6000, "far")}
    lines = expand_archives(archives).groupBy("member", "value", "key").count().collect()
    assert {(r.member, r.value, r["count"], r.key.rsplit("/", 1)[1]) for r in lines} == {
        ("first.txt", "one", 1, "first.txt"), ("first.txt", "two", 1, "first.txt"), ("far.txt", "three", 1000, "far.txt"),
    }
    path.unlink()


def test_add_missing_and_evolving_append(spark):
    df = spark.createDataFrame([("1",)], "a string")
    wide = add_missing_columns(df, lake_schema())
    assert set(wide.columns) == {"a", *CDM_FIELDS} and wide.schema["fetched_at"].dataType.simpleString() == "timestamp"
    append_evolving(df, "evolving")
    append_evolving(spark.createDataFrame([("2", ("x",))], "b string, s struct<k:string>"), "evolving")
    append_evolving(spark.createDataFrame([("3", "4")], "b string, a string"), "evolving")
    rows = {(r.a, r.b, r.s) for r in spark.table("evolving").collect()}
    assert rows == {("1", None, None), (None, "2", '{"k":"x"}'), ("4", "3", None)}
    assert not append_quarantine(df.limit(0), "never") and not spark.catalog.tableExists("never")
    assert append_quarantine(df, "quarantine") and spark.table("quarantine").count() == 1


def test_model():
    assert len(CDM_FIELDS) == 26 and CDM_FIELDS[:2] == ("company_number", "name") and CDM_FIELDS[-1] == "source_timestamp"
    assert timestamp_fields(lake_schema()) == ["fetched_at", "parsed_at", "cdm_mapped_at"]
    assert "name" in CDM and "nope" not in CDM


def company_rows(spark):
    from regloom.operators.parse import render_fixed_width

    layout = layout_for("us_fl")
    base = dict.fromkeys(layout.names, "")
    rows = [
        {
            **base, "COR_NUMBER": f"L{i}", "COR_NAME": "ACME", "COR_FILING_TYPE": "FLAL", "COR_FILE_DATE": d,
            "COR_MAIL_ADD_1": "1 ST", "COR_MAIL_ADD_2": "APT 2", "COR_MAIL_CITY": "MIAMI", "COR_FEI_NUMBER": "77" if i else "",
            "RA_NAME": "AGENT", "RA_NAME_TYPE": "P", "RA_ZIP5": "33029", "RA_ZIP4": "0001", "STATE_COUNTRY": "FL",
            "PRINC1_NAME_TYPE": "P", "PRINC1_NAME": "DOE", "PRINC1_TITLE": "MGR", "PRINC2_NAME": "ROE",
        }
        for i, d in enumerate(["09182024", "132021", "02302020", ""])
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in layout.names))
    lines = render_fixed_width(df, layout)
    return map_to_cdm(parse_fixed_width(lines, layout), rules_for("us_fl"), {"fetched_at": "2024-10-07T00:00:00"})


@pytest.mark.parametrize("as_text", [False, True])
def test_normalised_tables(spark, as_text):
    records = company_rows(spark)
    if as_text:
        records = encode_json(records)
    tables = normalize_company(records)
    company = {r.company_number: r for r in tables["company"].collect()}
    assert [str(company[f"L{i}"].incorporation_date) for i in range(4)] == ["2024-09-18", "2021-01-03", "None", "None"]
    assert company["L0"].retrieved_at == datetime(2024, 10, 7)
    officers = sorted(tuple(r) for r in tables["officer"].filter("company_number = 'L0'").collect() if r.position)
    assert officers == [("L0", "AGENT", "agent"), ("L0", "DOE", "MGR")]
    assert tables["officer"].count() == 12
    addresses = tables["officer_address"].collect()
    assert len(addresses) == 4 and addresses[0].postal_code == "33029-0001"
    mail = tables["mailing_address"].head()
    assert (mail.street_address, mail.locality, mail.region, mail.postal_code) == ("1 ST, APT 2", "MIAMI", None, None)
    assert tables["headquarters_address"].count() == 0
    assert {tuple(r) for r in tables["company_identifier"].collect()} == {(f"L{i}", "us_fein", "77") for i in (1, 2, 3)}
    assert tables["all_attributes"].head().jurisdiction_of_origin == "FL"
    assert tables["previous_names"].count() == 0
    assert share_view(records).count() == 4


def test_isle_of_man_tables(spark):
    from regloom.jurisdictions import im

    df = spark.createDataFrame([('{"Number":"1","Registered Agents":[{"Agent":"A","Address":"B"}],"Previous Names":[{"Name":"H","Status":"Current"}],"Place of Business":"P","Documents":"2"}',)], "v string")
    records = map_to_cdm(df.select(F.from_json("v", im.source_schema()).alias("v")).select("v.*"), rules_for("im"))
    for frame in (records, encode_json(records)):
        tables = normalize_company(frame)
        assert [tuple(r) for r in tables["officer"].collect()] == [("1", "A", None)]
        assert [tuple(r) for r in tables["officer_address"].collect()] == [("1", "A", "B", None, None, None)]
        assert [tuple(r) for r in tables["previous_names"].collect()] == [("1", "H", "Current")]
        assert tables["all_attributes"].head().documents == "2"


def test_routes_written_in_one_pass(spark, tmp_path):
    records = company_rows(spark)
    routed = with_route(records, rules_for("us_fl").date_fields())
    for run in ("a", "a", "b"):
        assert write_routes(routed, str(tmp_path / "out"), run) == {"valid": 3, "invalid": 1}
        append_routes(spark, str(tmp_path / "out"), run, "stg_test", "stg_test_invalid", schema=lake_schema())
    counts = {r._run: r["count"] for r in spark.table("stg_test").groupBy("_run").count().collect()}
    assert counts == {"a": 3, "b": 3} and dict(spark.table("stg_test").dtypes)["fetched_at"] == "timestamp"
    bad = spark.table("stg_test_invalid").collect()
    assert [r.company_number for r in bad] == ["L2", "L2"]


def test_bulk_projection(spark):
    at = F.lit(datetime(2024, 1, 1))
    got = bulk_projection(company_rows(spark), extracted_at=at)
    assert got.columns == [*CDM_FIELDS, "extracted_at"]
    assert all(f.dataType.simpleString() == "string" for f in got.schema.fields[:-1])


def test_head_samples(spark):
    df = spark.range(0, 500, numPartitions=6).select((F.lit(499) - F.col("id")).alias("k"))
    got = head_samples(df, ["k"], (3, 250))
    assert sorted(r.k for r in got[3].collect()) == [0, 1, 2] and got[250].agg(F.max("k")).head()[0] == 249
    tied = spark.range(0, 5000, numPartitions=6).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 100 = 1 THEN NULL ELSE id END AS k", "id")
    head = [(r.k, r.id) for r in head_samples(tied, ["k", "id"], (5, 40))[40].collect()]
    rows = [(r.k, r.id) for r in tied.collect()]
    assert sorted(head, key=str) == sorted(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))[:40], key=str)
    assert sample_path("a/b.csv", 1000) == "a/b_1000.csv"


@pytest.mark.parametrize("kind", ["long", "decimal(38,0)", "timestamp"])
def test_head_samples_with_a_hot_key_that_doubles_round(spark, kind):
    hot = 2**57 + 10 if kind == "timestamp" else 2**60 + 100
    key = f"CASE WHEN id < 10000 THEN id WHEN id < 25000 THEN {hot} ELSE {hot} + id END"
    df = spark.range(0, 30000, numPartitions=6).selectExpr(f"timestamp_micros({key}) AS k" if kind == "timestamp" else f"CAST({key} AS {kind}) AS k", "id")
    got = head_samples(df, ["k", "id"], (15000,))[15000].agg(F.count("*"), F.max("id")).head()
    assert tuple(got) == (15000, 14999)


def test_streaming_takes_each_file_once(spark, tmp_path):
    from regloom.operators.parse import render_fixed_width

    layout, src, sink, ledger_path = layout_for("us_fl"), tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()

    def land(name, n):
        rows = [{**dict.fromkeys(layout.names, ""), "COR_NUMBER": f"{name}{i}", "COR_FILE_DATE": "01012024" if i else "02302024"} for i in range(n)]
        df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in layout.names))
        (src / f"{name}.txt").write_text("\n".join(r[0] for r in render_fixed_width(df, layout).collect()) + "\n")

    def run():
        ingest_available(records_from_lines(stream_lines(spark, str(src)), layout, rules_for("us_fl")), sink, ledger_path)
        return spark.read.parquet(sink).count()

    land("a", 3)
    assert run() == 3
    land("b", 2)
    assert run() == 5
    assert run() == 5
    out = spark.read.parquet(sink)
    assert out.count() == 5 and out.filter("_route = 'invalid'").count() == 2
    assert {r.source_name for r in out.collect()} == {"a", "b"}


def test_as_timestamp_kinds(spark):
    assert one(spark, as_timestamp(F.lit("nope"), "text")) is None
    assert one(spark, as_timestamp(F.lit(0), "epoch")).replace(tzinfo=timezone.utc).timestamp() == 0


def test_configuration_files(spark, tmp_path):
    from regloom.functions.keys import check_jurisdiction, source_table, staging_table
    from regloom.plans.layout import Layout, load_layout
    from regloom.plans.rules import load_rules

    rules = {"meta_data": {"file_name": "r", "version": "2", "extra": 1}, "rules": {"a": {"source_field": "x", "cdm_field": "name", "note": "n"}}}
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    layout = {"meta_data": {"file_name": "l", "version": "3"}, "fields": [{"name": "x", "start": 1, "end": 4, "length": 4}]}
    (tmp_path / "layout.json").write_text(json.dumps(layout, indent=2))
    for session in (None, spark):
        assert load_rules(str(tmp_path / "rules.json"), session).label == "r:2"
        loaded = load_layout(str(tmp_path / "layout.json"), session)
        assert loaded.parsed_by == "l_3" and loaded.fields[0].length == 4
    with pytest.raises(ValueError):
        Layout.from_dict({"fields": [{"name": "x", "start": 0, "end": 4}]})
    assert check_jurisdiction("im") == "im"
    with pytest.raises(ValueError):
        check_jurisdiction("xx")
    assert (source_table("im"), staging_table("im"), staging_table("im", False)) == ("src_im", "stg_im", "stg_im_invalid")


def test_scratch_folder_follows_the_session(spark):
    from regloom.session import scratch_dir

    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_folders_can_be_released(spark):
    from regloom.session import materialise, release_scratch

    kept = materialise(spark.range(5), "release")
    folder = kept.inputFiles()[0].rpartition("/")[0].removeprefix("file://")
    assert Path(folder).exists() and release_scratch(spark) > 0 and not Path(folder).exists()
    assert release_scratch(spark) == 0


def test_a_filter_on_a_split_reaches_the_scan(spark, tmp_path):
    company_rows(spark).write.parquet(str(tmp_path / "records"))
    valid, _ = split_by_dates(spark.read.parquet(str(tmp_path / "records")), ["incorporation_date"], formats=["%m%d%Y"])
    plan = valid.filter("company_number = 'L0'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(company_number,L0)" in plan and "Exchange" not in plan


def test_a_split_of_mapped_rows_stays_above_the_mapping(spark):
    rows = company_rows(spark)
    valid, invalid = split_by_dates(rows, ["incorporation_date"], computed=True, formats=["%m%d%Y"])
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("__plain") and "Exchange" not in plan
    assert valid.columns == rows.columns and (valid.count(), invalid.count()) == (3, 1)


def test_building_a_plan_runs_no_job(spark):
    """Paths, workloads, samples ahead of their numbering, and splits are planned without an action."""
    from regloom.operators.rows import _leading_rows

    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    files = spark.range(100).selectExpr("'k' AS object_key", "'t' AS target", "concat('p', id) AS path", "concat('n', id) AS name", "id AS timestamp")
    entries = spark.createDataFrame(
        [("c", "j", "src", "raw/1", ".txt", None, "daily", False)],
        "ingest_config string, jurisdiction string, source_path string, target_path string, file_pattern string, file_names string, periodicity string, check_timestamp boolean",
    )
    group_paths(files, max_paths=10)
    planned = plan_workload(entries, files, files, kind="epoch")
    _leading_rows(files, "timestamp", 10)
    split_by_dates(company_rows(spark), ["incorporation_date"])
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert "NestedLoop" not in planned._jdf.queryExecution().executedPlan().toString()


def test_changes_of_a_task_follow_each_other(spark):
    """One row per task; each change sees what the one before has left."""
    changes = spark.createDataFrame(
        [("b/1", "PREPARING", "NEW", "t1", 1), ("b/1", "PROCESSING", "PREPARING", "t2", 2), ("b/1", "NEW", "ERROR", "t3", 3), ("b/2", "ERROR", "NEW", "t1", 1)],
        "object_key string, to_status string, from_status string, timestamp string, seq long",
    )
    got = {r.object_key: (r.status, r.timestamp, r.applied) for r in ledger_transition(ledger(spark), changes).collect()}
    assert got == {"b/1": ("PROCESSING", "t2", True), "b/2": ("PREPARING", "t0", False), "c/3": (None, "t0", None), "c/4": ("PROCESSED", "t0", None)}


def test_csv_headers_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"a\nb"\n')
    (tmp_path / "b.csv").write_text("\ufeffy,x,z\n3,4,5\n")
    (tmp_path / "c.csv").write_text('x,"y"\n6,7\n')
    rows = {r.x: (r.y, r.z) for r in read_source(spark, str(tmp_path), "csv").collect()}
    assert rows == {"1": ("a\nb", None), "4": ("3", "5"), "6": ("7", None)}
    kind = T.StructType([T.StructField("y", T.StringType()), T.StructField("x", T.LongType())])
    assert sorted(tuple(r) for r in read_source(spark, str(tmp_path), "csv", schema=kind).collect()) == [("3", 4), ("7", 6), ("a\nb", 1)]


def test_broken_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a":"1"}\n{"a":\n\n{"a":"2"}\n')
    kind = T.StructType([T.StructField("a", T.StringType())])
    good, bad = read_json_lines(spark, str(tmp_path), kind)
    assert sorted(r.a for r in good.collect()) == ["1", "2"]
    assert [(r.path.rpartition("/")[2], r.value) for r in bad.collect()] == [("x.jsonl", '{"a":')]
    with pytest.raises(Exception, match="Malformed records"):
        read_source(spark, str(tmp_path), "json_lines", schema=kind).collect()


def test_names_of_another_case_are_one_column(spark):
    append_evolving(spark.createDataFrame([("a",)], "name string"), "case_test")
    append_evolving(spark.createDataFrame([("b", 1)], "Name string, n int"), "case_test")
    assert sorted(tuple(r) for r in spark.table("case_test").collect()) == [("a", None), ("b", 1)]


def test_manifest_file(spark, tmp_path):
    entries = {
        "a": {"jurisdiction": "us_fl", "source_path": "doc", "target_path": "us_fl", "file_pattern": ".txt", "secret_name": "s"},
        "b": {"jurisdiction": "im", "source_path": "d", "target_path": "t", "file_names": "x,y", "check_timestamp": True, "periodicity": "weekly"},
    }
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps(entries))
    got = {r.ingest_config: r for r in load_manifest(spark, str(path)).collect()}
    assert (got["a"].periodicity, got["a"].check_timestamp, got["a"].file_names) == ("daily", False, None)
    assert (got["b"].periodicity, got["b"].check_timestamp) == ("weekly", True)
    path.write_text(json.dumps({"a": {**entries["a"], "file_names": "x"}}))
    with pytest.raises(ValueError, match="either"):
        load_manifest(spark, str(path))


def test_streaming_json_lines(spark, tmp_path):
    from regloom.jurisdictions import im

    (tmp_path / "in").mkdir()
    (tmp_path / "in/im_2024.jsonl").write_text('{"Number":"1","Date of Incorporation":"3 Oct 2024"}\n{"Number":"2","Date of Incorporation":"31 Feb 2024"}\n')
    stream = stream_rows(spark, str(tmp_path / "in"), "json_lines", im.source_schema(), glob="*.jsonl", max_files=1)
    records = records_from_rows(stream, rules_for("im"), {"periodicity": "daily"})
    ingest_available(records, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = {r.company_number: (r._route, r.source_name, r.periodicity) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"1": ("valid", "im_2024", "daily"), "2": ("invalid", "im_2024", "daily")}


@pytest.mark.parametrize("bits", [16, 2, 1])
@pytest.mark.parametrize("match", [False, True])
def test_a_key_with_most_changes_is_composed_in_parts(spark, monkeypatch, bits, match):
    """Against changes applied one by one, with states no task is in, null states and times, and parts cut anywhere."""
    monkeypatch.setattr(ledger_ops, "RUN_BITS", bits)
    draw = random.Random(4)
    states = ["A", "B", "C", "D", None]
    changes = [
        ("hot" if i % 3 else f"k{i % 7}", draw.choice(states), draw.choice(["A", "B", "C", "E", "A", None]), draw.choice(["t1", "t2", None]), i // 2)
        for i in range(600)
    ]
    tasks = [("hot", "A", "t1"), ("k0", None, "t2"), ("k1", "B", None), ("k2", "Z", "t1"), ("k3", "E", "t2"), ("free", "A", "t1")]
    schema = "object_key string, to_status string, from_status string, timestamp string, seq long"
    got = ledger_transition(
        spark.createDataFrame(tasks, "object_key string, status string, timestamp string"), spark.createDataFrame(changes, schema).repartition(5), match_timestamp=match
    )
    want = []
    for key, status, at in tasks:
        mine = sorted((c for c in changes if c[0] == key), key=lambda c: (c[4], c[3] or "", c[1] or "", c[2] or ""))
        applied = False if mine else None
        for _, to, frm, when, _ in mine:
            if (frm is None or frm == status) and (not match or (when is not None and when == at)):
                status, at, applied = to, at if match else when, True
        want.append((key, status, at, applied))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


# --- loads that bring other types, and loads that are repeated ---


def test_types_meet():
    integer, long, text, double = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType()
    assert promoted(integer, long) == long and promoted(T.DecimalType(10, 2), long) == T.DecimalType(21, 2)
    assert promoted(long, double) == double and promoted(T.DecimalType(38, 0), T.DecimalType(38, 9)) == text
    assert promoted(T.DateType(), T.TimestampType()) == T.TimestampType() == promoted(T.TimestampType(), T.DateType())
    assert promoted(T.BooleanType(), integer) == text == promoted(T.DateType(), long)


@pytest.mark.parametrize("external", [True, False])
def test_a_load_widens_a_column_and_quarantines_a_cell(spark, tmp_path, external):
    table = f"widened_{external}"
    first = spark.createDataFrame([("a", 1, "x")], "id string, n int, note string")
    append_evolving(first, table, path=str(tmp_path / "t") if external else None)
    append_evolving(spark.createDataFrame([("b", "12 units"), ("c", "9000000000"), ("d", None), ("e", " 7 ")], "id string, n string"), table)
    assert dict(spark.table(table).dtypes)["n"] == "bigint"
    assert {(r.id, r.n, r.note) for r in spark.table(table).collect()} == {
        ("a", 1, "x"), ("b", None, None), ("c", 9000000000, None), ("d", None, None), ("e", 7, None),
    }
    (cell,) = spark.table(f"{table}_cells").collect()
    assert (cell.column, cell.type, cell.text, json.loads(cell.row)["id"]) == ("n", "bigint", "12 units", "b")
    # A decimal, then a number too long for it, then another kind: nothing that was there changes.
    append_evolving(spark.createDataFrame([("f", "0.125")], "id string, n string"), table)
    assert dict(spark.table(table).dtypes)["n"] == "decimal(38,3)"
    append_evolving(spark.createDataFrame([("g", True)], "id string, n boolean"), table)
    got = {r.id: r.n for r in spark.table(table).collect()}
    assert got == {"a": "1.000", "b": None, "c": "9000000000.000", "d": None, "e": "7.000", "f": "0.125", "g": "true"}


def test_doubles_round_nothing(spark):
    append_evolving(spark.createDataFrame([(2**53 + 1,)], "n long"), "rounded")
    append_evolving(spark.createDataFrame([(0.5,)], "n double"), "rounded")
    assert {r.n for r in spark.table("rounded").collect()} == {str(2**53 + 1), "0.5"}
    append_evolving(spark.createDataFrame([(2**50,)], "n long"), "kept_double")
    append_evolving(spark.createDataFrame([(0.5,)], "n double"), "kept_double")
    assert {r.n for r in spark.table("kept_double").collect()} == {float(2**50), 0.5}


def test_texts_and_dates_that_widen(spark):
    append_evolving(spark.createDataFrame([(1.5,)], "v double").selectExpr("v", "DATE '2024-01-02' AS d", "TRUE AS b"), "texts")
    append_evolving(spark.createDataFrame([("2.25", "2024-01-03 10:00:00", "false"), ("1.23456789012345678", "x", "maybe")], "v string, d string, b string"), "texts")
    assert [t for _, t in spark.table("texts").dtypes] == ["double", "timestamp", "boolean"]
    assert {(r.v, str(r.d), r.b) for r in spark.table("texts").collect()} == {
        (1.5, "2024-01-02 00:00:00", True), (2.25, "2024-01-03 10:00:00", False), (None, "None", None),
    }
    assert {(r.column, r.text) for r in spark.table("texts_cells").collect()} == {("v", "1.23456789012345678"), ("d", "x"), ("b", "maybe")}


def test_a_load_is_replaced_by_itself(spark):
    for rows in ([("1",), ("x",)], [("1",), ("2",)], []):
        append_evolving(spark.createDataFrame([(0,)], "n int"), "loaded", load="a")
        append_evolving(spark.createDataFrame(rows, "n string"), "loaded", load="b'\\")
        want = sorted([0] + [int(r[0]) if r[0] != "x" else -1 for r in rows])
        assert sorted(-1 if r.n is None else r.n for r in spark.table("loaded").collect()) == want
        assert spark.table("loaded_cells").count() == sum(r[0] == "x" for r in rows)
    with pytest.raises(ValueError, match="partitioned"):
        append_evolving(spark.createDataFrame([(0,)], "n int"), "loaded", partition_by=["n"])


def test_an_interrupted_widening_is_settled(spark, monkeypatch):
    append_evolving(spark.createDataFrame([(1,)], "n int"), "settled")
    spark.sql("CREATE TABLE settled__next AS SELECT * FROM settled")  # stopped before the old table was dropped
    append_evolving(spark.createDataFrame([(2,)], "n int"), "settled")
    assert sorted(r.n for r in spark.table("settled").collect()) == [1, 2] and not spark.catalog.tableExists("settled__next")
    spark.sql("ALTER TABLE settled RENAME TO settled__next")  # and after
    append_evolving(spark.createDataFrame([(3,)], "n int"), "settled")
    assert sorted(r.n for r in spark.table("settled").collect()) == [1, 2, 3]


def test_a_load_stopped_between_its_tables_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path, tables = str(tmp_path / "staged"), ("half_valid", "half_invalid")
    rules = rules_for("us_fl")
    routed = with_route(company_rows(spark), rules.date_fields())
    write_routes(routed, path, "r1")
    real = writers.append_evolving

    def stops(df, table, **options):
        if table == "half_invalid":
            raise RuntimeError("killed")
        real(df, table, **options)

    monkeypatch.setattr(writers, "append_evolving", stops)
    with pytest.raises(RuntimeError):
        append_routes(spark, path, "r1", *tables, schema=lake_schema())
    assert [r.run for r in writers.open_loads(spark, path)] == ["r1"] and not spark.catalog.tableExists("half_invalid")
    monkeypatch.setattr(writers, "append_evolving", real)
    write_routes(routed, path, "r2")
    append_routes(spark, path, "r2", *tables, schema=lake_schema())
    assert writers.open_loads(spark, path) == []
    for table, n in zip(tables, (3, 1), strict=True):
        assert {r._run: r["count"] for r in spark.table(table).groupBy("_run").count().collect()} == {"r1": n, "r2": n}
    # A run that is written again without rejected rows takes its old ones away.
    write_routes(routed.withColumn("_route", F.lit("valid")), path, "r2")
    append_routes(spark, path, "r2", *tables, schema=lake_schema())
    assert [r._run for r in spark.table("half_invalid").collect()] == ["r1"] and spark.table("half_valid").count() == 7


# --- manifests, samples, rule versions, redelivered rows ---


def test_a_folder_with_most_files_is_spread(spark):
    """Entries that overlap, names given twice, patterns longer than a name; a hot folder is dealt over the join's tasks."""
    entries = spark.createDataFrame(
        [
            ("all", "j", "hot", "t", ".txt", None, "daily", False), ("some", "j", "hot", "t", "9.txt", None, "daily", False),
            ("named", "j", "hot", "t", None, "f1.txt,f2.txt,f1.txt,no", "daily", False), ("long", "j", "cold", "t", "a-long-ending.txt", "", "daily", False),
        ],
        MANIFEST,
    )
    files = spark.range(0, 3000, numPartitions=4).selectExpr("IF(id % 3 < 2, 'hot', 'cold') AS path", "concat('f', id, IF(id % 5 = 0, '.zip', '.txt')) AS name", "id AS timestamp")
    found = manifest_files(entries, files)
    want = []
    for r in files.collect():
        for e in entries.collect():
            if r.path == e.source_path and (r.name.endswith(e.file_pattern) if e.file_pattern else r.name in e.file_names.split(",")):
                want.append((e.ingest_config, r.name))
    assert sorted((r.ingest_config, r.name) for r in found.collect()) == sorted(want)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = manifest_files(entries, files).where("ingest_config = 'all'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(tasks) >= 5 and max(r["count"] for r in tasks) < sum(r["count"] for r in tasks) / 2


def test_names_may_be_a_frame(spark):
    files = spark.createDataFrame([("a/x.csv",), ("b/y.csv",), ("x.csv/z",)], "key string")
    names = spark.createDataFrame([("x.csv",), ("x.csv",), ("w",)], "name string")
    assert [r.key for r in filter_files(files, names=names).collect()] == ["a/x.csv"] == [r.key for r in filter_files(files, names=["x.csv"]).collect()]
    assert filter_files(files, suffixes=[".csv"], names=names).columns == ["key"]


def test_sample_files(spark, tmp_path):
    rows = spark.range(0, 60, numPartitions=5).selectExpr("id", "59 - id AS k", "concat('line\\n \"', id, '\" ') AS note")
    path = str(tmp_path / "out" / "rows.csv")
    for _ in range(2):
        made = writers.write_samples(rows, path, ["k"], (5, 20, 1000))
    assert made == [path.replace(".csv", f"_{n}.csv") for n in (5, 20, 1000)]
    for name, n in zip(made, (5, 20, 60), strict=True):
        with open(name, newline="") as f:
            got = list(csv.reader(f))
        assert got == [["id", "k", "note"]] + [[str(59 - k), str(k), f'line\n "{59 - k}" '] for k in range(n)]
    assert writers.write_samples(rows.where("id < 0"), str(tmp_path / "none.csv"), ["k"], (5,)) == []


def test_rules_by_version(spark, tmp_path):
    def rules(version, **own):
        return {"meta_data": {"file_name": "m", "version": version}, "rules": {n: {"source_field": s, "cdm_field": n} for n, s in own.items()}}

    for key, found in {"im/json/v1": rules("1", name="a"), "im/json/latest": rules("2", name="b", company_type="a"), "us_fl/csv/v1": rules("9", name="c")}.items():
        folder = tmp_path / "cdm_mapping_rules" / key
        folder.mkdir(parents=True)
        (folder / f"cdm_mapping_{key.split('/')[0]}.json").write_text(json.dumps(found))
    book = load_rule_book(spark, str(tmp_path))
    files = spark.createDataFrame([("1", "IM", "json", "v1"), ("2", "im", "Json", None), ("3", "us_fl", "csv", "v1"), ("4", "im", "json", "v7"), ("5", None, "json", "v1")], "path string, j string, t string, v string")
    files = files.select("path", rules_key(F.col("j"), F.col("t"), F.col("v")).alias("rules_key"))
    rows = files.withColumns({"a": F.concat(F.lit("a"), "path"), "b": F.lit("b"), "c": F.struct(F.lit(1).alias("x"))})
    used = used_rules(files, book)
    assert set(used) == set(book) and len(book) == 3
    records, lost = map_by_version(rows, used, {"fetched_by": "me"}, keep=["path"])
    got = {r.path: (r.name, r.company_type, r.cdm_mapping_rules, r.fetched_by) for r in records.collect()}
    assert got == {"1": ("a1", None, "m:1", "me"), "2": ("b", "a2", "m:2", "me"), "3": ('{"x":1}', None, "m:9", "me")}
    assert {(r.path, r.rules_key, json.loads(r.row)["a"]) for r in lost.collect()} == {
        ("4", "cdm_mapping_rules/im/json/v7/cdm_mapping_im.json", "a4"), ("5", None, "a5"),
    }
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan") == rows._jdf.queryExecution().executedPlan().toString().count("Scan")
    empty, all_lost = map_by_version(rows, {}, keep=["path"])
    assert empty.count() == 0 and all_lost.count() == 5


def test_redelivered_rows_are_left_out(spark, tmp_path):
    source, sink, ledger_path = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    source.mkdir()
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("hash", "v")])

    def land(name, *rows):
        (source / name).write_text("".join(json.dumps(dict(zip(("hash", "v"), r))) + "\n" for r in rows))

    def run():
        rows = without_redelivered(stream_rows(spark, str(source), "json_lines", schema).drop("_corrupt_record"))
        return ingest_available(rows, sink, ledger_path, partition_by=())

    land("a.json", ("h1", "x"), ("h2", "y"), (None, "p"), (None, "q"))
    assert run() == {"rows": 4, "repeated": 0}
    land("b.json", ("h1", "x"), ("h2", "y"), ("h3", "z"), ("h3", "z"))
    assert run() == {"rows": 4, "repeated": 3}
    assert run()["repeated"] == 0
    got = sorted((r.hash or "", r.v) for r in spark.read.schema(schema).parquet(sink).collect())
    assert got == [("", "p"), ("", "q"), ("h1", "x"), ("h2", "y"), ("h3", "z")]
