"""Every registered query against its expected result, over whole tables."""

import importlib.util
import os
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from regloom.workload import oracle
from regloom.workload import queries as workload

spec = importlib.util.spec_from_file_location("entry", Path(__file__).resolve().parent.parent / "__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES, ORACLE = dict(workload.QUERIES), dict(oracle.ORACLE)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(repr(r[i]) for i in order) for r in rows)


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    found = duck.execute(ORACLE[name])
    expected = canonical(found.fetchall(), [d[0] for d in found.description])
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    wrong = [(g, e) for g, e in zip(got[1], expected[1]) if g != e]
    assert not wrong, wrong[:2]


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_csv_chunks_are_written_by_many_tasks(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(workload.writers, "write_csv", lambda df, path, max_rows, f=workload.writers.write_csv: (seen.append(df), f(df, path, max_rows=max_rows)))
    files = {r.rows: r.files for r in workload.QUERIES["csv_chunks"](spark, "/root/testdata/sf0.01").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.01/customer.parquet").selectExpr("concat('', c_custkey) AS c_custkey", "c_name")
    n = rows.count()
    assert files == {100: n // 100} | ({n % 100: 1} if n % 100 else {})
    (written,) = seen
    tasks = [r["n"] for r in written.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(tasks) > 1 and sorted(written.collect()) == sorted(rows.collect())
