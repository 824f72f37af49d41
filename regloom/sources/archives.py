"""Zip archives on any file system to member rows and member lines.

An archive is never read whole.  Its directory, which is at its end, lists the members; members are dealt to tasks one
by one, and a task seeks to each of its own.  Archives may be of any size, with Zip64 directories.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.operators.parse import explode_lines

BATCH_ROWS = 20_000
MEMBER_SCHEMA = "archive string, member string, place long, size long, packed_size long"
LINE_SCHEMA = "archive string, member string, size long, value binary"


def open_seekable(path: str) -> BinaryIO:
    """A file opened for reading at any place: local paths as they are, others by the file system their scheme names."""
    scheme = urlsplit(path).scheme if ":/" in path else ""
    if scheme in ("", "file"):
        # As Hadoop writes local paths, file:/a and file:///a, without escapes.
        return open(path.removeprefix("file:").replace("//", "/", 1).replace("//", "/", 1) if scheme else path, "rb")
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(archive, bytes)`` of the zip files below a path.  Only the listing is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true")
    return files.load(path).select(F.col("path").alias("archive"), F.col("length").alias("bytes"))


def list_members(archives: DataFrame) -> DataFrame:
    """``(archive, member, place, size, packed_size, key, source_name)``: every member becomes a sibling of its archive, named
    after itself.  ``place`` is its number in the directory, which is all that is read of an archive."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch["archive"]:
                with open_seekable(archive) as file, zipfile.ZipFile(file) as z:
                    found = [(archive, i.filename, n, i.file_size, i.compress_size) for n, i in enumerate(z.infolist()) if not i.is_dir()]
                for at in range(0, len(found), BATCH_ROWS):
                    yield pd.DataFrame(found[at : at + BATCH_ROWS], columns=["archive", "member", "place", "size", "packed_size"])

    listed = archives.select("archive").repartition("archive").mapInPandas(members, MEMBER_SCHEMA)
    folder = F.regexp_extract("archive", "^(.*)/[^/]*$", 1)
    return listed.select(
        "*",
        F.concat_ws("/", folder, "member").alias("key"),
        F.substring_index(F.regexp_extract("member", "([^/]*)$", 1), ".", 1).alias("source_name"),
    )


def expand_members(members: DataFrame) -> DataFrame:
    """``(archive, member, size, key, source_name, value)``: the text lines of listed members.

    A member is unpacked as a stream, by the task it is dealt to, and handed on in batches of lines.  Members of
    one archive that meet in a task share one opening of it.
    """

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        known, file, z = None, None, None
        names = ["archive", "member", "size", "value"]
        try:
            for batch in batches:
                for archive, member, place, size in batch[["archive", "member", "place", "size"]].itertuples(index=False):
                    if archive != known:
                        if file is not None:
                            file.close()
                        known, file = archive, open_seekable(archive)
                        z = zipfile.ZipFile(file)
                        infos = z.infolist()
                    with z.open(infos[place]) as stream:
                        for line in stream:
                            rows.append((archive, member, size, line))
                            if len(rows) >= BATCH_ROWS:
                                yield pd.DataFrame(rows, columns=names)
                                rows = []
        finally:
            if file is not None:
                file.close()
        if rows:
            yield pd.DataFrame(rows, columns=names)

    dealt = members.select("archive", "member", "place", "size").repartition("archive", "place").sortWithinPartitions("archive", "place")
    raw = dealt.mapInPandas(lines, LINE_SCHEMA)
    plain = F.regexp_replace(F.make_valid_utf8(F.col("value").cast("string")), "\r?\n?$", "")
    text = raw.select("archive", "member", "size", plain.alias("value"))
    broken = text.select("archive", "member", "size", F.explode(F.split("value", "\r")).alias("value"))
    rows = explode_lines(broken, keep=["archive", "member", "size"])
    folder = F.regexp_extract("archive", "^(.*)/[^/]*$", 1)
    name = F.substring_index(F.regexp_extract("member", "([^/]*)$", 1), ".", 1)
    return rows.select("archive", "member", "size", F.concat_ws("/", folder, "member").alias("key"), name.alias("source_name"), "value")


def expand_archives(archives: DataFrame) -> DataFrame:
    """The text lines of every member of every archive (``expand_members``)."""
    return expand_members(list_members(archives))
