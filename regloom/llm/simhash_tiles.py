"""Near duplicates by SimHash and tiled exact comparison.

A text's fingerprint has a bit set where over half of its 3-word shingles' 64-bit hashes have it set.
Two fingerprints link when they differ in at most ``RADIUS`` bits.  Distinct fingerprints are dealt into tiles by
their population counts: one count for each 16-bit quarter.  A differing bit changes one count by one, so tiles whose
counts differ by more than the radius in sum hold no link and are skipped; all other tile pairs are compared
whole, by exclusive-or and bit count.  A pair of tiles sends on only links that span its components, so groups of
near copies never grow into all their pairs.

The work grows with the square of the number of distinct fingerprints, divided by some 20 (the share of
tile pairs that are not skipped): exact for every radius, and affordable for tens of millions of them.

Defined cases: null, empty and blank texts have fingerprint zero, which links like any other; fewer than three
words are one shingle; rows with the same id are rows of their own; a null id is never a component's id, and a
component without any id has a null one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from regloom.llm.common import components, located, spanning, utf8, without
from regloom.session import materialise

SHINGLE = 3
SEED = 42
RADIUS = 3
TILE = 2048  # fingerprints in a tile, on average at most
BLOCK = 65536  # shingles whose bits are counted at a time


def fingerprint(text: bytes) -> int:
    """The SimHash of one text, as an unsigned 64-bit number."""
    words = text.lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return 0
    plain = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    k = min(SHINGLE, len(words))
    starts = [0, *(e + 1 for e in ends[: len(ends) - k])]
    hashed = xxhash.xxh64_intdigest
    h = np.array([hashed(plain[s:e], SEED) for s, e in zip(starts, ends[k - 1 :], strict=True)], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), BLOCK):
        part = h[i : i + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


@F.arrow_udf(LongType())
def fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array(np.fromiter(map(fingerprint, utf8(texts)), np.uint64, len(texts)).view(np.int64))


def counts(fp: Column) -> list[Column]:
    """Population counts of the four 16-bit quarters of a fingerprint."""
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]


def tile_of(quarters: list[int]) -> int:
    return sum(q * 32**i for i, q in enumerate(quarters))


def offsets(radius: int) -> list[int]:
    """What lies between the numbers of two tiles that may hold links, one direction of each."""
    span = range(-radius, radius + 1)
    near = [(a, b, c, d) for a in span for b in span for c in span for d in span if abs(a) + abs(b) + abs(c) + abs(d) <= radius]
    return sorted(tile_of(list(x)) for x in near if x >= (0, 0, 0, 0))


def compare(radius: int):
    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_a, found_b = [], []
            for left, right in zip(batch["left"], batch["right"], strict=True):
                x, y = left.values.to_numpy().view(np.uint64), right.values.to_numpy().view(np.uint64)
                i, j = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= radius)
                both, place = np.unique(np.concatenate([x, y]), return_inverse=True)
                a, b = spanning(place[i], place[j + len(x)], len(both))
                found_a.append(both[a])
                found_b.append(both[b])
            if found_a:
                pair = [pa.array(np.concatenate(found).view(np.int64)) for found in (found_a, found_b)]
                yield pa.RecordBatch.from_arrays(pair, ["a", "b"])

    return tiles


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all within ``radius`` of each other."""
    quarters = prints.select("fp", *(q.alias(f"q{i}") for i, q in enumerate(counts(F.col("fp")))))
    keyed = quarters.select("fp", F.expr("q0 + 32 * q1 + 1024 * q2 + 32768 * q3").alias("tile"))
    # A tile of many fingerprints is cut by hash into parts of bounded size.
    parts = keyed.groupBy("tile").agg(F.ceil(F.count("*") / TILE).alias("parts"))
    dealt = keyed.join(parts, "tile").withColumn("part", F.expr("pmod(xxhash64(fp), parts)"))
    tiles = materialise(dealt.groupBy("tile", "part").agg(F.collect_list("fp").alias("fps")), "op3-tiles")
    near = F.explode(F.array(*(F.lit(o) for o in offsets(radius))))
    left = tiles.select(F.col("tile").alias("own"), F.col("part").alias("own_part"), F.col("fps").alias("left"), near.alias("o"))
    left = left.withColumn("tile", F.col("own") + F.col("o"))
    pairs = left.join(tiles, "tile").where("own <> tile OR own_part <= part")
    return pairs.select("left", F.col("fps").alias("right")).mapInArrow(compare(radius), "a long, b long")


def groups(docs: DataFrame, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """``located`` documents, and for each address doc_id, fp and the component's ``root`` and id."""
    rows = located(docs, "op3-docs")
    marked = rows.select("f", "r", F.col("d.doc_id").cast("long").alias("doc_id"), fingerprints("d.text").alias("fp"))
    marked = materialise(marked, "op3-prints")
    prints = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(prints.select("fp"), radius), "op3-links")
    classes = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialise(classes.join(ids, "root").select("fp", "root", "component_id"), "op3-classes")
    return rows, marked.join(classes, "fp")


def simhash_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (least id reachable)."""
    _, members = groups(docs, radius)
    return members.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The documents that stay: of each component the row with the least id, then address."""
    rows, members = groups(docs, radius)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "f", "r"))
    stay = members.groupBy("root").agg(first.alias("k")).select("k.f", "k.r")
    return without(rows, members.join(stay, ["f", "r"], "left_anti"), "op3-dropped")
