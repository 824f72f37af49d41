"""Writing results: CSV, routed folders, warehouse load."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.operators.rows import SAMPLE_SIZES, head_samples, sample_path
from regloom.operators.schema import append_evolving, clear_partition, encode_json
from regloom.operators.validate import ROUTE
from regloom.plans.model import CDM, target_model
from regloom.session import file_system, scratch_dir


RUN = "_run"


def write_csv(
    df: DataFrame, path: str, compression: str | None = None, max_rows: int | None = None, mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> None:
    """CSV with header; nested values (lists too) as JSON text.  ``max_rows``
    bounds the rows of one file."""
    if max_rows is not None and max_rows < 1:
        raise ValueError("max_rows must be positive")
    writer = encode_json(df).write.mode(mode).option("header", "true").option("escape", '"')
    # Keep an empty text apart from a null on the way back in.
    writer = writer.option("emptyValue", '""').option("lineSep", "\n")
    # Blanks and line breaks at a cell's ends are part of it; Spark would leave them out.
    writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    if compression:
        writer = writer.option("compression", compression)
    if max_rows is not None:
        writer = writer.option("maxRecordsPerFile", max_rows)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_samples(df: DataFrame, path: str, order_by: Sequence[str], sizes: Sequence[int] = SAMPLE_SIZES) -> list[str]:
    """Files with the first n rows for each size, with a header each: ``orders.csv`` as ``orders_1000.csv`` and so on.

    Rows are sorted once (``number_rows``, over those that can be among the first) and written once: a row's rank tells which
    samples it is part of.  A sample is one file, written by one task, with as many rows as its size at most; what is there of that
    name is replaced.  Without rows there are no files.
    """
    most, row, name = max(sizes), "__row", "__sample"
    numbered = head_samples(df, order_by, [most], keep_row=row)[most]
    part_of = F.filter(F.array(*[F.lit(n) for n in sorted(set(sizes))]), lambda n: n > F.col(row))
    dealt = numbered.withColumn(name, F.explode(part_of)).repartition(len(sizes), name).sortWithinPartitions(name, row)
    spark, made = df.sparkSession, scratch_dir(df.sparkSession, "samples")
    write_csv(dealt.drop(row), made, partition_by=[name])
    files, place = file_system(spark, made)
    out = []
    for n in sorted(set(sizes)):
        found = files.globStatus(file_system(spark, f"{made}/{name}={n}/*.csv")[1])
        if not found:
            continue
        out.append(sample_path(path, n))
        target_files, target = file_system(spark, out[-1])
        target_files.mkdirs(target.getParent())
        target_files.delete(target, False)
        if not target_files.rename(found[0].getPath(), target):
            raise OSError(f"cannot move a sample to {out[-1]}")
    return out


def write_routes(routed: DataFrame, path: str, run: str, fmt: str = "parquet") -> dict[str, int]:
    """Write valid and quarantined rows of one run in one pass, a folder each
    (``_run=…/_route=valid``, ``_run=…/_route=invalid``), and return the row counts
    taken in that same pass.  Repeating a run replaces what it had written."""
    counts = Observation()
    observed = encode_json(routed).observe(
        counts,
        F.count_if(F.col(ROUTE) == "valid").alias("valid"),
        F.count_if(F.col(ROUTE) == "invalid").alias("invalid"),
    )
    observed.write.mode("overwrite").partitionBy(ROUTE).format(fmt).save(f"{path}/{RUN}={run}")
    return dict(counts.get)


# Loads that have begun: a folder each below the staged runs, gone when both tables have the run.
OPEN = "_loads"
INTENT = "run string, valid_table string, invalid_table string, valid_place string, invalid_place string, schema string"


def open_loads(spark: SparkSession, path: str) -> list[Row]:
    """The loads below ``path`` that were begun and not finished."""
    files, place = file_system(spark, f"{path}/{OPEN}")
    if not files.exists(place) or not files.listStatus(place):
        return []
    return spark.read.schema(INTENT).option("recursiveFileLookup", "true").json(f"{path}/{OPEN}").collect()


def _load_run(spark: SparkSession, path: str, load: Row, counts: Mapping[str, int] | None = None) -> None:
    staged = spark.read.parquet(f"{path}/{RUN}={load['run']}").withColumn(RUN, F.lit(load["run"]))
    schema = T.StructType.fromJson(json.loads(load["schema"])) if load["schema"] else None
    for route in ("valid", "invalid"):
        table, place = load[f"{route}_table"], load[f"{route}_place"]
        part = staged.filter(F.col(ROUTE) == route).drop(ROUTE)
        if counts[route] if counts is not None else not part.isEmpty():
            append_evolving(part, table, path=place, schema=schema, partition_by=[RUN])
        elif spark.catalog.tableExists(table):
            # What an earlier version of the run had here is gone too.
            clear_partition(spark, table, RUN, load["run"])


def append_routes(
    spark: SparkSession, path: str, run: str, valid_table: str, invalid_table: str, schema: T.StructType | None = None,
    locations: tuple[str | None, str | None] = (None, None), counts: Mapping[str, int] | None = None,
) -> None:
    """Load the folders of one run of ``write_routes`` into their tables, partitioned by run.

    ``schema`` gives the types of a new table's columns, as ``lake_schema`` has its timestamps; ``counts``, as ``write_routes``
    returned them, saves looking whether a route has rows.  Loading a run again replaces its
    partition, so a repeated load leaves each row once.  Both tables move together: the load is noted below ``path`` before
    the first is written and the note is taken away after the second; a load that was interrupted in between
    is finished, from its note, by the next one.
    """
    note = {
        "run": run, "valid_table": valid_table, "invalid_table": invalid_table, "valid_place": locations[0],
        "invalid_place": locations[1], "schema": schema.json() if schema is not None else None,
    }
    earlier = [load for load in open_loads(spark, path) if load["run"] != run]
    spark.createDataFrame([tuple(note.values())], INTENT).coalesce(1).write.mode("overwrite").json(f"{path}/{OPEN}/run={quote(run, safe='')}")
    for load in [*earlier, Row(**note)]:
        _load_run(spark, path, load, counts if load["run"] == run else None)
        files, place = file_system(spark, f"{path}/{OPEN}/run={quote(load['run'], safe='')}")
        files.delete(place, True)


def bulk_projection(df: DataFrame, model=CDM, extracted_at: Column | None = None) -> DataFrame:
    """The columns a warehouse load names, in model order, with its load time."""
    fields = target_model(model).fields
    encoded = encode_json(df)
    at = extracted_at if extracted_at is not None else F.current_timestamp()
    present = set(encoded.columns)
    columns = [F.col(f) if f in present else F.lit(None).cast("string").alias(f) for f in fields]
    return encoded.select(*columns, at.alias("extracted_at"))


def bulk_load(df: DataFrame, table: str, jdbc_options: dict[str, str], model=CDM) -> None:
    """Append to ``source.<table>`` over JDBC."""
    if not table:
        raise ValueError("target table name is required")
    writer = bulk_projection(df, model).write.format("jdbc").options(**jdbc_options)
    writer.option("dbtable", f"source.{table}").mode("append").save()
