"""Helpers the corpus operators share: stable row addresses, Arrow text access, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.session import materialise

# ASCII white space: blank, tab, line feed, vertical tab, form feed, carriage return.
# bytes.split() without an argument breaks at exactly these.
WHITE = " \t\n\x0b\f\r"
BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` itself if its rows come from Parquet files, else a copy in the shared scratch folder."""
    try:
        df.select(df.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        return materialise(df, purpose)
    return df


def located(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as ``d`` (a struct of all its columns), with the address of each row: ``f`` (a hash of
    the file's path) and ``r`` (its row there).

    The address stays the same however often the frame is read, also after a lost executor.  A
    frame that is not read from Parquet is written first.
    """
    df = stored(df, purpose)
    meta = df.metadataColumn("_metadata")
    columns = [df[f"`{c.replace('`', '``')}`"] for c in df.columns]
    return df.select(F.struct(*columns).alias("d"), F.xxhash64(meta["file_path"]).alias("f"), meta["row_index"].alias("r"))


def without(rows: DataFrame, dropped: DataFrame, purpose: str) -> DataFrame:
    """The documents of ``located`` rows whose address is not in ``dropped``.

    The addresses are written first, so their size is known when the join is planned: Spark
    broadcasts them below its own threshold and shuffles both sides beyond it.
    """
    gone = materialise(dropped.select("f", "r"), purpose)
    return rows.join(gone, ["f", "r"], "left_anti").select("d.*")


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for null, empty or blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BREAK))


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % by


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array, without a copy; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def utf8(texts: pa.Array) -> Iterator[bytes]:
    """Each text in UTF-8; null is empty."""
    offsets, data = raw(texts)
    view = memoryview(data)
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield bytes(view[start:end])


def slices(n_bytes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes each, one row at least."""
    start, held = 0, 0
    for i, n in enumerate(n_bytes):
        if i > start and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(n_bytes):
        yield start, len(n_bytes)


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between ``n`` nodes, given as two index arrays, as links to the smallest node of each
    component: fewer than ``n``, with the same components."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def components(links: DataFrame, purpose: str) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the smallest node reachable.

    Large-star and small-star steps (Kiveris et al. 2014) until every node points to its root; each
    round is written to the shared scratch folder.  No component is ever held by one task.
    """
    links = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), purpose
    )
    known = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        links = materialise(small.select("e.*").where("a <> b").distinct(), purpose)
        # A sum of hashes over whole rows tells one set of links from another, in any order.
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == known:
            break
        known = now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
