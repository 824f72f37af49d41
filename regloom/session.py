"""Session settings the jobs are written for, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# codegen.maxFields, hugeMethodLimit: a parse or mapping projection has close to a
# hundred output columns.  Past HotSpot's 8000-bytecode limit a fused method is never
# JIT compiled, so such projections run faster as split methods; with the lower field
# limit they are not fused, and compiled for nothing, in the first place.
# maxConcurrentOutputFileWriters: the two routes of a write stay open side by side,
# instead of sorting all rows by route first.
# dataFrameDebugging: recording a call site for every column call doubles the time
# it takes to build a wide plan.
RECOMMENDED = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.maxFields": "60",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Those of them a running session can still take on.
ADJUSTABLE = (
    "spark.sql.session.timeZone",
    "spark.sql.codegen.maxFields",
    "spark.sql.codegen.hugeMethodLimit",
    "spark.sql.maxConcurrentOutputFileWriters",
)


def build_session(app: str = "regloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def share_code(spark: SparkSession) -> None:
    """Let the session's Python workers import this package from where the driver has it.

    For a package that is not installed; executors that have it installed, or are sent it, lose nothing.
    """
    root = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the shared folder.  Only a local master may
    fall back to the machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="regloom-")
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


_made: list[str] = []


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this driver has made so far, and return how many.

    For the end of a job: frames that still read from them cannot be used any more.
    """
    gone = 0
    while _made:
        files, place = file_system(spark, _made.pop())
        gone += files.delete(place, True)
    return gone


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage is
    cut, and a lost executor costs a re-read of files instead of a recompute."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores, ahead of heavy per-row work on narrow rows (rendering, parsing, hashing)."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
