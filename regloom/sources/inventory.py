"""File listings as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.functions.text import base_name


def suffix_match(c: Column, suffixes: Sequence[str]) -> Column:
    matched = F.lit(False)
    for suffix in suffixes:
        matched = matched | F.endswith(c, F.lit(suffix))
    return matched


def filter_files(
    files: DataFrame,
    prefix: str | None = None,
    suffixes: Sequence[str] | None = None,
    names: Sequence[str] | DataFrame | None = None,
    key: str = "key",
) -> DataFrame:
    """Files by key prefix, any of some suffixes, and exact base names.  Names may be a frame with a column
    ``name``: any number of them, met by an equi-join."""
    c = F.col(key)
    if prefix:
        files = files.filter(F.startswith(c, F.lit(prefix)))
    if suffixes:
        files = files.filter(suffix_match(c, suffixes))
    if isinstance(names, DataFrame):
        wanted = names.select(F.col("name").alias("__name"))
        return files.withColumn("__name", base_name(c)).join(wanted, "__name", "left_semi").drop("__name")
    return files.filter(base_name(c).isin(list(names))) if names else files


def file_inventory(
    spark: SparkSession,
    path: str,
    prefix: str | None = None,
    suffixes: Sequence[str] | None = None,
    names: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """``(key, path, name, size, timestamp)`` of every file below ``path``.

    ``key`` is relative to ``path``.  Only file metadata is selected, so no file
    content is read.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    root = F.lit(path.rstrip("/") + "/")
    plain = F.regexp_replace(F.col("path"), "^[a-z0-9]+:/*", "/")
    bare_root = F.regexp_replace(root, "^[a-z0-9]+:/*", "/")
    keyed = listed.select(
        F.when(F.startswith(plain, bare_root), F.substr(plain, F.char_length(bare_root) + 1))
        .otherwise(plain)
        .alias("key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("timestamp"),
    )
    files = keyed.select(
        "key",
        F.regexp_replace(F.regexp_extract("key", "^(.*)/[^/]*$", 1), "/+$", "").alias("path"),
        base_name(F.col("key")).alias("name"),
        "size",
        "timestamp",
    )
    return filter_files(files, prefix, suffixes, names)


def route_files(files: DataFrame, key: str = "key", suffix: str = ".csv.bz2", invalid: str = "_invalid.csv.bz2") -> DataFrame:
    """Data files with ``_route``; a file is either valid or invalid, never both."""
    c = F.col(key)
    rejected = F.endswith(c, F.lit(invalid))
    return files.filter(F.endswith(c, F.lit(suffix))).withColumn(
        "_route", F.when(rejected, F.lit("invalid")).otherwise(F.lit("valid"))
    )
