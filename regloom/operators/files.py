"""File-set operators: differences, workloads, grouping of paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.functions.keys import as_timestamp
from regloom.plans.layout import read_config

# States of a queued task.
STATUSES = ("NEW", "PREPARING", "PROCESSING", "PROCESSED", "ERROR")


def latest_target(target: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row per key with its time ``ts``: the last one by ``order`` (by time if
    not given).  Aggregates before the shuffle, so repeated names cost little."""
    picked = F.max_by(F.struct("ts"), F.col(order)) if order else F.struct(F.max("ts").alias("ts"))
    return target.groupBy(*keys).agg(picked.alias("t")).select(*keys, F.col("t.ts").alias("ts"))


def is_new_or_changed(found: Column, source_ts: Column, target_ts: Column) -> Column:
    """Not in the target, or times differ, or no time to compare on either side."""
    same = F.coalesce(source_ts == target_ts, F.lit(False))
    return found.isNull() | ~same


def files_diff(
    source: DataFrame,
    target: DataFrame,
    compare_timestamp: bool = False,
    timestamp: str = "timestamp",
    kind: str = "timestamp",
    order: str | None = None,
) -> DataFrame:
    """Source files that are not in the target, by ``name``.

    With ``compare_timestamp`` also those whose times differ, or have none on both
    sides.  ``kind`` tells how times are kept (see ``as_timestamp``).  Among equal
    names in the target the last by ``order`` counts.
    """
    if not compare_timestamp:
        return source.join(target.select("name").distinct(), "name", "left_anti").select(*source.columns)
    ts = as_timestamp(F.col(timestamp), kind)
    known = latest_target(target.withColumn("ts", ts), ["name"], order)
    known = known.select("name", F.col("ts").alias("__target"), F.lit(True).alias("__found"))
    joined = source.join(known, "name", "left")
    return joined.filter(is_new_or_changed(F.col("__found"), ts, F.col("__target"))).select(*source.columns)


MANIFEST_SCHEMA = (
    "ingest_config string, jurisdiction string, source_path string, target_path string, file_pattern string, "
    "file_names string, periodicity string, content_type string, check_timestamp boolean"
)


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest frame of a JSON file ``{ingest_config: {jurisdiction, source_path, …}}``.

    ``periodicity`` is daily and ``check_timestamp`` false unless given.  Transport
    settings (secrets, download strategy) are of no use here and left out.
    """
    rows = []
    for name, entry in read_config(path, spark).items():
        missing = [k for k in ("jurisdiction", "source_path", "target_path") if not entry.get(k)]
        if missing:
            raise ValueError(f"manifest entry {name!r} lacks {', '.join(missing)}")
        if bool(entry.get("file_pattern")) == bool(entry.get("file_names")):
            raise ValueError(f"manifest entry {name!r}: give either file_pattern or file_names")
        rows.append(
            (
                name,
                entry["jurisdiction"],
                entry["source_path"],
                entry["target_path"],
                entry.get("file_pattern"),
                entry.get("file_names"),
                entry.get("periodicity", "daily"),
                entry.get("content_type"),
                bool(entry.get("check_timestamp", False)),
            )
        )
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def check_manifest(manifest: DataFrame) -> DataFrame:
    """Every entry names either a file pattern or file names; a bad entry stops
    the job."""
    pattern, names = F.coalesce("file_pattern", F.lit("")), F.coalesce("file_names", F.lit(""))
    bad = (pattern == "") == (names == "")
    checked = F.when(bad, F.raise_error(F.concat(F.lit("give either file_pattern or file_names: "), "ingest_config")))
    return manifest.withColumn("ingest_config", F.coalesce(checked.cast("string"), F.col("ingest_config")))


# Parts the files of a folder are dealt into when they meet the manifest.
PARTS = 16
NAMED = -1


def wanted_files(files: DataFrame, entries: DataFrame, folder: str, path: str = "path") -> DataFrame:
    """Files with each manifest entry that asks for them: in the folder the entry names in column ``folder``, with a name that ends with
    its pattern or is one of its names.

    Joined on equal keys: the folder, and the end of the name at each length that some pattern has (few), or the whole
    name.  The files of a folder are dealt into parts, each of which meets the entries, so a folder with a large share of all files
    is spread.
    """
    size, key, tail, part = "__size", "__folder", "__tail", "__part"
    names = F.transform(F.array_distinct(F.split("file_names", ",")), lambda n: F.struct(F.lit(NAMED).alias(size), n.alias(tail)))
    pattern = F.array(F.struct(F.char_length("file_pattern").alias(size), F.col("file_pattern").alias(tail)))
    asked = entries.withColumn("__ask", F.explode(F.when(F.coalesce("file_pattern", F.lit("")) != "", pattern).otherwise(names)))
    asked = asked.select("*", "__ask.*", F.col(folder).alias(key)).drop("__ask")
    asked = asked.withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    sizes = entries.agg(F.collect_set(F.char_length(F.nullif("file_pattern", F.lit("")))).alias("sizes")).scalar()
    sized = files.withColumn("__sizes", F.array_append(sizes, F.lit(NAMED)))
    sized = sized.withColumn(size, F.explode("__sizes")).drop("__sizes").where(F.col(size) <= F.char_length("name"))
    ends = F.when(F.col(size) == NAMED, F.col("name")).otherwise(F.right("name", F.col(size)))
    dealt = sized.withColumns({tail: ends, key: F.col(path), part: F.pmod(F.xxhash64("name"), F.lit(PARTS)).cast("int")})
    return dealt.join(asked, [key, size, tail, part]).drop(key, size, tail, part)


def manifest_files(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """Listed files each manifest entry asks for: those in its source path whose
    name ends with the pattern or is one of the names."""
    return wanted_files(inventory, check_manifest(manifest), "source_path")


def plan_workload(
    manifest: DataFrame, inventory: DataFrame, landed: DataFrame, kind: str = "timestamp"
) -> DataFrame:
    """New tasks: files a manifest entry asks for that have not landed under its
    target path yet, or whose time changed if the entry checks times.

    ``inventory`` and ``landed`` have ``(path, name, timestamp)``.
    """
    wanted = manifest_files(manifest, inventory).withColumn("ts", as_timestamp(F.col("timestamp"), kind))
    entries = check_manifest(manifest).select("ingest_config", "target_path", "file_pattern", "file_names")
    entries = entries.withColumn("target_path", F.rtrim("target_path", F.lit("/")))
    # A landed file lies under each folder its path passes through, so the join is on equal paths.
    folders = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(folders)), lambda n: F.array_join(F.slice(folders, F.lit(1), n), "/"))
    under = landed.withColumn("__under", F.explode(above))
    here = wanted_files(under, entries, "target_path", "__under")
    known = latest_target(here.withColumn("ts", as_timestamp(F.col("timestamp"), kind)), ["ingest_config", "name"])
    known = known.select("ingest_config", "name", F.col("ts").alias("__target"), F.lit(True).alias("__found"))
    joined = wanted.join(known, ["ingest_config", "name"], "left")
    checks = F.coalesce("check_timestamp", F.lit(False))
    fresh = F.col("__found").isNull() | (checks & is_new_or_changed(F.col("__found"), F.col("ts"), F.col("__target")))
    return joined.filter(fresh).select(
        "jurisdiction",
        F.concat_ws("/", "path", "name").alias("object_key"),
        F.coalesce("periodicity", F.lit("daily")).alias("periodicity"),
        F.when(checks, F.coalesce(F.unix_timestamp("ts"), F.lit(0))).otherwise(F.lit(0)).cast("long").alias("timestamp"),
        F.lit("NEW").alias("status"),
        "ingest_config",
    )


def group_paths(
    files: DataFrame, keys: tuple[str, ...] = ("object_key", "target"), path: str = "path", max_paths: int = 10_000
) -> DataFrame:
    """Paths per task and table, as ``(keys, part, paths)``: the grain is a part of a group.

    A load job takes a list of paths, but one task may own most files: a group is
    cut by path hash into parts of about ``max_paths``, so no array and no reduce
    task grows with the largest group.  Group sizes come from a count that is
    aggregated before its shuffle.
    """
    sizes = files.groupBy(*keys).agg(F.count("*").alias("__n"))
    # Only groups above the limit need cutting, and there are few of those.
    large = sizes.filter(F.col("__n") > max_paths)
    parts = large.select(*keys, F.ceil(F.col("__n") / max_paths).cast("int").alias("__parts"))
    sized = files.join(parts, list(keys), "left")
    part = F.pmod(F.xxhash64(path), F.coalesce("__parts", F.lit(1))).cast("int")
    salted = sized.withColumn("part", part)
    return salted.groupBy(*keys, "part").agg(F.sort_array(F.collect_list(path)).alias("paths"))


def size_range(files: DataFrame, size: str = "size") -> DataFrame:
    """Smallest and largest size, leaving zero sizes out."""
    c = F.col(size).cast("long")
    nonzero = F.when(c != 0, c)
    return files.agg(F.min(nonzero).alias("min_size"), F.max(nonzero).alias("max_size"))
