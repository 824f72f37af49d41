"""Merkle fixity audit of replicated WARC archives.

Each record is hashed, and archives are trees over their records in order of offset: a node's hash covers the offsets,
lengths and hashes of up to ``FAN`` children.  Two replicas are compared by their archives' roots; only below a root that
differs are the children compared, level by level, so an audit of sound replicas moves one row per archive, and a damaged
one some ``FAN`` rows per level and damaged record; a lost or added record moves all that follow it, so there the rest of its
archive is compared.  Archives hold at most ``FAN ** LEVELS`` records, so no group grows with the data.

Records that differ by place are paired by hash: those at the same offset are intact, others moved, the n-th with a hash
in one replica being the n-th in the other.  The rest stand in gaps between paired records, and in each gap the n-th of
one replica is a damaged copy of the n-th of the other; what has no partner is missing or extra.

Records come from page tables (``page_records``) or from WARC files (``read_warc``, uncompressed, each file of a bounded
size as ``write_warc`` makes them).

Defined cases: null and empty pages are records with an empty block; null urls and ids are written empty; rows with the
same id are records of their own; a record with another hash is damaged, one whose hash is right at another offset moved, one that
only one replica has missing or extra (an extra one has its place in the replica); an empty table gives an empty result; other
columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regloom.llm.common import located, stored
from regloom.session import materialise

FAN = 16
LEVELS = 3
RECORDS = FAN**LEVELS  # in an archive
CRLF = "\r\n"
CLOSE = b"\r\n\r\n"
#: The end of a record that another one's version line follows.
NEXT = re.compile(rb"\r\n\r\n(?=WARC/\d+\.\d+\r\n)")
LEAF = "archive string, seq long, offset long, length long, digest string"


def record_text() -> str:
    """SQL: a page's record without the two line ends that close it."""
    head = [
        "'WARC/1.1'", "'WARC-Type: resource'", "concat('WARC-Record-ID: <urn:page:', coalesce(cast(page_id AS string), ''), '>')",
        "concat('WARC-Target-URI: ', coalesce(url, ''))", "'WARC-Date: 1970-01-01T00:00:00Z'", "'Content-Type: text/html'",
        "concat('Content-Length: ', octet_length(coalesce(html, '')))", "''",
    ]
    return f"concat(concat_ws(char(13) || char(10), {', '.join(head)}), char(13) || char(10), coalesce(html, ''))"


def page_records(pages: DataFrame, html: str = "html") -> DataFrame:
    """The records of a page table: page_id, archive, seq, offset, length, digest.  Archives are runs of stored rows.

    ``html`` is an expression for the page as this replica has it.
    """
    rows = located(pages, "op8-pages").select("f", "r", F.col("d.page_id").cast("long").alias("page_id"), F.col("d.url").alias("url"), F.col("d.html").alias("html"))
    closed = F.concat(F.expr(record_text()), F.lit(CRLF + CRLF))
    made = rows.withColumn("html", F.expr(html)).select(
        "page_id", F.concat_ws("-", F.hex("f"), F.floor(F.col("r") / RECORDS)).alias("archive"), (F.col("r") % RECORDS).alias("seq"),
        F.octet_length(closed).cast("long").alias("length"), F.sha2(closed, 256).alias("digest"),
    )
    order = Window.partitionBy("archive").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return made.withColumn("offset", F.sum("length").over(order) - F.col("length"))


def write_warc(pages: DataFrame, path: str) -> None:
    """Pages as uncompressed WARC files of at most ``RECORDS`` records."""
    records = pages.select(F.expr(record_text()).alias("value"))
    # Two line ends close a record, so Spark's text writer with them as separator writes whole WARC files.
    records.write.option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", RECORDS).text(path)


def parse(name: str, data: bytes) -> Iterator[tuple[str, int, int, int, str, str, str]]:
    """Records of one WARC file.

    A length holds if two line ends close the record there and the file ends or another record begins.  Where it does not, and
    where no record begins, the record reaches to the next version line after two line ends, or to the end of the file.
    """
    offset, seq = 0, 0
    while offset < len(data):
        stop = data.find(b"\r\n\r\n", offset)
        fields = {}
        if data.startswith(b"WARC/", offset) and stop >= 0:
            for line in data[offset:stop].split(b"\r\n")[1:]:
                key, _, value = line.partition(b":")
                fields[key.strip().lower()] = value.strip()
        size = fields.get(b"content-length", b"")
        end = stop + 8 + int(size) if size.isdigit() and len(size) < 19 else 0
        closed = offset < end <= len(data) and data.endswith(CLOSE, offset, end)
        if not closed or not (end == len(data) or data.startswith(b"WARC/", end)):
            found = NEXT.search(data, offset)
            # With no version line before its end, a closed record is whole, and what follows it is damaged.
            if not closed or (found and found.end() < end):
                end = found.end() if found else len(data)
        body = data[offset:end]
        uri = fields.get(b"warc-target-uri", b"").decode("utf-8", "replace")
        block = data[stop + 4 : end].removesuffix(CLOSE).decode("utf-8", "replace") if fields else ""
        yield name, seq, offset, len(body), hashlib.sha256(body).hexdigest(), uri, block
        offset, seq = end, seq + 1


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files below ``path``: archive (file name), seq, offset, length, digest, uri, block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["archive", "seq", "offset", "length", "digest", "uri", "block"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            for name, data in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                rows = list(parse(name.rpartition("/")[2], data.as_py()))
                columns = zip(*rows, strict=True) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, f"{LEAF}, uri string, block string")


def tree(leaves: DataFrame) -> DataFrame:
    """All nodes of all archives: archive, level (0: records), place, offset, length, digest, and whether a root."""
    own = leaves.select("archive", F.lit(0).alias("level"), F.col("seq").alias("place"), "offset", "length", "digest")
    nodes = below = own
    for level in range(1, LEVELS + 1):
        inner = below.groupBy("archive", F.floor(F.col("place") / FAN).alias("place")).agg(
            F.min("offset").alias("offset"), F.sum("length").alias("length"),
            F.array_sort(F.collect_list(F.struct("place", "offset", "length", "digest"))).alias("children"),  # FAN at most
        )
        text = F.array_join(F.transform("children", lambda c: F.concat_ws(":", c["offset"], c["length"], c["digest"])), ",")
        below = inner.select("archive", F.lit(level).alias("level"), "place", "offset", "length", F.sha2(text, 256).alias("digest"))
        nodes = nodes.unionByName(below)
    return nodes


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records that differ: archive, seq, offset, length, status, replica_digest.  Takes two trees."""
    own, other = materialise(primary, "op8-primary"), materialise(replica, "op8-replica")

    def level(nodes: DataFrame, n: int, side: str) -> DataFrame:
        picked = nodes.where(F.col("level") == n)
        return picked.select("archive", "place", *(F.col(c).alias(f"{side}_{c}") for c in ("offset", "length", "digest")))

    suspect = None
    for n in range(LEVELS, -1, -1):
        a, b = level(own, n, "own"), level(other, n, "other")
        if suspect is not None:
            parent = suspect.select("archive", F.col("place").alias("parent"))
            a, b = (x.withColumn("parent", F.floor(F.col("place") / FAN)).join(parent, ["archive", "parent"], "left_semi").drop("parent") for x in (a, b))
        same = " AND ".join(f"own_{c} <=> other_{c}" for c in ("offset", "length", "digest"))
        suspect = materialise(a.join(b, ["archive", "place"], "full").where(f"NOT ({same})"), "op8-suspects")
    return paired(suspect)


def paired(suspect: DataFrame) -> DataFrame:
    """The leaves that differ by place, paired by hash, then by their order between paired ones."""
    names = ["place", "offset", "length", "digest"]
    own, other = (
        suspect.where(F.col(f"{side}_digest").isNotNull()).select("archive", "place", *(F.col(f"{side}_{c}").alias(c) for c in names[1:]))
        for side in ("own", "other")
    )
    both = own.withColumn("side", F.lit(0)).unionByName(other.withColumn("side", F.lit(1)))
    # At most two archives' records have the same archive, so no window grows with the data.
    there = Window.partitionBy("archive", "offset", "length", "digest")
    both = both.withColumn("here", F.count("*").over(there) == 2)
    nth = Window.partitionBy("archive", "digest", "here", "side").orderBy("place")
    both = both.withColumn("key", F.when(F.col("here"), F.col("offset")).otherwise(F.row_number().over(nth)))
    mates = Window.partitionBy("archive", "digest", "here", "key")
    both = both.withColumn("mate", F.when(F.count("*").over(mates) == 2, F.min(F.when(F.col("side") == 0, F.col("place"))).over(mates)))
    # Suspects without a gap between their places form a run, which begins at the same place on both sides.
    in_order = Window.partitionBy("archive", "side").orderBy("place")
    both = both.withColumn("run", F.col("place") - F.row_number().over(in_order))
    before = Window.partitionBy("archive", "side", "run").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("after", F.coalesce(F.last("mate", ignorenulls=True).over(before), F.lit(-1)))
    gap = Window.partitionBy("archive", "side", "run", "after", F.col("mate").isNull()).orderBy("place")
    both = both.withColumn("n", F.when(F.col("mate").isNull(), F.row_number().over(gap)))
    row = F.struct(*names, "here")
    pairs = both.groupBy(
        "archive", "mate", F.when(F.col("mate").isNull(), F.col("run")).alias("run"), F.when(F.col("mate").isNull(), F.col("after")).alias("after"), "n"
    ).agg(F.max(F.when(F.col("side") == 0, row)).alias("own"), F.max(F.when(F.col("side") == 1, row)).alias("other"))
    status = F.when(F.col("other").isNull(), "missing").when(F.col("own").isNull(), "extra")
    status = status.when(F.col("mate").isNotNull(), "moved").otherwise("damaged")
    return pairs.where("NOT coalesce(own.here, false)").select(
        "archive", F.coalesce("own.place", "other.place").alias("seq"), F.coalesce("own.offset", "other.offset").alias("offset"),
        F.coalesce("own.length", "other.length").alias("length"), status.alias("status"), F.col("other.digest").alias("replica_digest"),
    )


def fixity(pages: DataFrame, replica_html: str) -> DataFrame:
    """One row per page: page_id, length, sha256, status against a replica that holds ``replica_html``, replica_sha256."""
    pages = stored(pages, "op8-pages")  # both replicas' archives are cut at the same rows
    records = materialise(page_records(pages), "op8-records")
    replica = page_records(pages, replica_html)
    found = audit(tree(records.drop("page_id")), tree(replica.drop("page_id")))
    # An extra record belongs to no page.
    found = found.where("status <> 'extra'").select("archive", "seq", "status", "replica_digest")
    out = records.join(found, ["archive", "seq"], "left")
    status = F.coalesce("status", F.lit("intact"))
    return out.select(
        "page_id", "length", F.col("digest").alias("sha256"), status.alias("status"),
        F.when(F.col("status").isNull(), F.col("digest")).otherwise(F.col("replica_digest")).alias("replica_sha256"),
    )
