"""Incremental ingest: each run takes the files that arrived since the last one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.functions.text import stem
from regloom.operators.parse import parse_fixed_width
from regloom.operators.schema import encode_json
from regloom.operators.validate import ROUTE, with_route
from regloom.plans.compiler import map_to_cdm
from regloom.plans.layout import Layout
from regloom.plans.rules import MappingRules
from regloom.sources.readers import CORRUPT, CSV_OPTIONS


def stream_lines(spark: SparkSession, path: str, glob: str = "*.txt", max_files: int | None = None) -> DataFrame:
    """New text lines with the ``path`` of their file."""
    reader = spark.readStream.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("path"))


def stream_rows(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, glob: str | None = None, max_files: int | None = None
) -> DataFrame:
    """New rows of CSV or JSON-lines files with the ``path`` of their file.

    A JSON line that is no record comes as ``_corrupt_record``; a CSV file whose header is not the schema's stops the
    stream, as a stream's files are not known when it is planned.
    """
    if fmt != "csv":
        schema = T.StructType([*(f for f in schema.fields if f.name != CORRUPT), T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        rows = reader.options(**CSV_OPTIONS, enforceSchema="false").csv(path)
    else:
        rows = reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return rows.select("*", F.col("_metadata.file_path").alias("path"))


def records_from_lines(
    lines: DataFrame, layout: Layout, rules: MappingRules, metadata: Mapping[str, Column | str | None] | None = None
) -> DataFrame:
    """Lines to routed company records: one narrow stage."""
    parsed = parse_fixed_width(lines, layout, keep=["path"], decode=True)
    return records_from_rows(parsed, rules, metadata)


def records_from_rows(
    rows: DataFrame, rules: MappingRules, metadata: Mapping[str, Column | str | None] | None = None
) -> DataFrame:
    """Routed records; lines that are no record go to quarantine with their text and path."""
    broken = CORRUPT in rows.columns
    columns = [c for c in rows.columns if c not in ("path", CORRUPT)]
    stamps = {"source_name": stem(F.col("path")), **(metadata or {})}
    records = map_to_cdm(rows, rules, stamps, source_columns=columns, keep=[CORRUPT, "path"] if broken else [])
    routed = with_route(records, rules.date_fields(), formats=rules.date_formats())
    if broken:
        bad = F.col(CORRUPT).isNotNull()
        routed = routed.withColumn(ROUTE, F.when(bad, F.lit("invalid")).otherwise(F.col(ROUTE)))
    return encode_json(routed)


ARRIVED = "__arrived"


def without_redelivered(stream: DataFrame, key: str = "hash", within: str = "30 days") -> DataFrame:
    """Each row once, though files may be delivered again under other names: rows whose ``key``, the row hash, came before
    are left out.

    The state keeps a key for ``within`` after it arrived, by the clock of the micro-batch, so no row is ever too late, and the state
    is bounded by what arrives in that time.  A row without a key is told by all its columns.  This is an addition:
    a stream keeps re-delivered rows unless it is asked.
    """
    told = F.coalesce(F.col(key).cast("string"), F.sha2(F.to_json(F.struct("*")), 256))
    stamped = stream.withColumns({"__key": told, ARRIVED: F.current_timestamp()}).withWatermark(ARRIVED, within)
    return stamped.dropDuplicatesWithinWatermark(["__key"]).drop("__key", ARRIVED)


# Settings of a run: state on disk, and the progress of all its micro-batches.
RUN_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Files of a few rows are not laid out at their full size ahead.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.numRecentProgressUpdates": str(1 << 20),
}


def ingest_available(stream: DataFrame, sink: str, checkpoint: str, partition_by: tuple[str, ...] = (ROUTE,)) -> dict[str, int]:
    """Process all files not seen before, then stop; returns the rows that were read, and those left out as ``repeated``.

    The checkpoint is the ledger of processed files: a file is taken exactly once,
    also when a run is interrupted and repeated.
    """
    spark = stream.sparkSession
    writer = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    parts = [c for c in partition_by if c in stream.columns]
    if parts:
        writer = writer.partitionBy(*parts)
    before = {name: spark.conf.get(name, None) for name in RUN_SETTINGS}
    for name, value in RUN_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        run = writer.trigger(availableNow=True).start()
        run.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    done = run.recentProgress
    repeated = sum(int(o.customMetrics.get("numDroppedDuplicateRows", 0)) for p in done for o in p.stateOperators)
    return {"rows": sum(p.numInputRows for p in done), "repeated": repeated}
