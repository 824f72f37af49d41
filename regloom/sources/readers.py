"""Reading source files as DataFrames."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.functions.keys import content_type
from regloom.operators.parse import explode_lines
from regloom.session import materialise
from regloom.sources.records import read_csv_records

# Doubled quotes, as written by most CSV tools and expected by warehouses.  A cell may hold line breaks; streams
# read such a file in one task.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
# Options that block-wise reading does not know.
WHOLE_FILES = ("multiLine", "lineSep", "encoding", "charset", "comment", "delimiter", "ignoreLeadingWhiteSpace", "unescapedQuoteHandling")
CORRUPT = "_corrupt_record"


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def file_headers(spark: SparkSession, paths: str | Sequence[str], **options) -> dict[tuple[str, ...], list[str]]:
    """The files below ``paths`` by the column names of their first line.

    One row per file reaches the driver, as many as Spark's own listing holds.  The byte order mark some
    tools write is not part of a name.
    """
    reader = spark.read.options(**{k: v for k, v in options.items() if k in ("recursiveFileLookup", "pathGlobFilter")})
    lines = reader.text(_paths(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("id"),
    )
    first = lines.where("block = 0").groupBy("path").agg(F.min_by("value", "id").alias("line"))
    found: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for row in first.collect():
        line = row["line"].removeprefix("\ufeff")
        cells = next(csv.reader([line], delimiter=options.get("sep", ",")), [])
        found[tuple(cells)].append(row["path"])
    return {k: sorted(v) for k, v in sorted(found.items())}


def _read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None, options: dict) -> DataFrame:
    """CSV files of any header by Spark's reader, columns matched by name; a column a file lacks is null."""
    headers = file_headers(spark, paths, **options) if options["header"] == "true" else {}
    if len(headers) <= 1:
        reader = spark.read.options(**options)
        if schema is None:
            return reader.csv(_paths(paths))
        names = next(iter(headers), tuple(schema.names))
        if names == tuple(schema.names):
            return reader.option("enforceSchema", "false").schema(schema).csv(_paths(paths))
    found = None
    for names, files in headers.items():
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        part = spark.read.options(**options).schema(text).csv(files)
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    if schema is None:
        return found
    missing = [f.name for f in schema.fields if f.name not in found.columns]
    padded = found.select("*", *[F.lit(None).cast("string").alias(n) for n in missing])
    return padded.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def read_source(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str,
    schema: T.StructType | None = None,
    recursive: bool = False,
    path_column: str | None = None,
    **options,
) -> DataFrame:
    """Read csv, json_lines, json or parquet, by short name or MIME type.  ``path_column`` adds the path of each row's file.

    CSV columns stay text (no inference) and are matched by name, file by file.  Files are cut into blocks although
    their cells may hold line breaks, and scanned when this is called (``read_csv_records``).  With ``multiLine`` given, or
    options of other dialects, Spark reads them: whole files in a task each with ``true``, a record a line with ``false``.  JSON lines
    with a declared schema keep what cannot be read in ``_corrupt_record`` if the schema has it, and
    otherwise stop at it.  Compression follows the file extension.
    """
    kind = content_type(fmt)
    if recursive:
        options = {"recursiveFileLookup": "true", **options}
    if kind == "csv":
        given = {**CSV_OPTIONS, **options}
        if given["escape"] == given["quote"] and len(given["quote"]) == 1 and len(given.get("sep", ",")) == 1 and not set(options) & set(WHOLE_FILES):
            return read_csv_records(spark, _paths(paths), schema, given, path_column)
        found = _read_csv(spark, paths, schema, given)
        return found.select("*", F.input_file_name().alias(path_column)) if path_column else found
    found = _read_other(spark, paths, kind, schema, options)
    return found.select("*", F.col("_metadata.file_path").alias(path_column)) if path_column else found


def _read_other(spark: SparkSession, paths: str | Sequence[str], kind: str, schema: T.StructType | None, options: dict) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind == "json_lines":
        kept = schema is None or CORRUPT in schema.names
        bad = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT} if kept else {"mode": "FAILFAST"}
        return reader.options(**{**bad, **options}).json(paths)
    if kind == "json":
        return reader.options(**{"multiLine": "true", **options}).json(paths)
    return reader.options(**options).parquet(*_paths(paths))


def read_json_lines(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, **options
) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine): the lines that are records, and those that are not as ``(path, value)``."""
    marked = T.StructType([*(f for f in schema.fields if f.name != CORRUPT), T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.options(**options).text(_paths(paths)).select("value", F.col("_metadata.file_path").alias("path"))
    # Parsed from the text: Spark does not let a scan be asked for its broken records alone.
    parsed = lines.where(F.btrim("value") != "").withColumn("v", F.from_json("value", marked, {"columnNameOfCorruptRecord": CORRUPT}))
    broken = F.col(f"v.{CORRUPT}").isNotNull()
    return parsed.where(~broken).select("v.*").drop(CORRUPT), parsed.where(broken).select("path", "value")


def read_lines(spark: SparkSession, paths: str | Sequence[str], with_path: bool = False) -> DataFrame:
    """Text lines, decoded as UTF-8 with U+FFFD for bad bytes."""
    lines = spark.read.text(paths)
    if not with_path:
        return explode_lines(lines)
    return explode_lines(lines.select("value", F.col("_metadata.file_path").alias("path")), keep=["path"])


def write_numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines with ``path`` and their 0-based ``row_index`` within the file, at the boundaries of ``read_lines``.

    A line's place inside its split follows from the id its scan task gives it, so nothing is sorted: only one count per
    split is aggregated and summed up along the file.  The scan is written to the scratch
    folder when this is called, because a second scan could be cut into other splits.
    """
    scanned = spark.read.text(_paths(paths)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    )
    broken = explode_lines(scanned, keep=["path", "block"])
    fixed = materialise(broken.withColumn("id", F.monotonically_increasing_id()), "lines")
    blocks = fixed.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    offsets = blocks.select("path", "block", "first", offset.alias("offset"))
    joined = fixed.join(offsets, ["path", "block"])
    return joined.select("value", "path", (F.col("offset") + F.col("id") - F.col("first")).alias("row_index"))
