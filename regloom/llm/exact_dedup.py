"""Exact deduplication with keyed streaming state.

Texts are equal when they are the same after all ASCII white space is deleted.  A stream over the
documents' digests keeps one state row per digest, in RocksDB and without expiry: how many rows had it, and
the id, length and content locator (file, row) of the one that stays.  State is aggregated ahead of the
shuffle, so a text copied into a third of all rows costs its state task one row per map task.
Every digest that was hit more than once is then checked on the full bytes, fetched by locator; texts
that only share a digest are told apart by their bytes.

Defined cases: null text counts as empty; empty and blank texts equal each other; rows with the same id
are rows of their own; a null id loses ties against any id; of rows alike in all of this the first by
address stays; an empty table gives an empty result; columns other than doc_id and text play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.llm.common import WHITE, located, without
from regloom.session import materialise, scratch_dir

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Without this each state task sets aside several MB of disk before it holds a row.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

# Orders the rows of a group; the first one stays.
RANK = "struct(-n AS shorter, doc_id IS NULL AS nameless, doc_id, f, r)"


def keyed(rows: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """Address, id, length, normalised text and digest of ``located`` documents.

    ``digest_bytes`` shortens the digest that keys the state, for tests of the byte check.
    """
    text = F.coalesce(F.col("d.text"), F.lit(""))
    plain = rows.select(
        "f", "r", F.col("d.doc_id").cast("long").alias("doc_id"), F.length(text).cast("long").alias("n"),
        F.translate(text, WHITE, "").alias("bare"),
    )
    sha = F.unhex(F.sha2(F.col("bare"), 256))
    return plain.withColumn("sha", sha).withColumn("digest", F.substring("sha", 1, digest_bytes))


def run_state(spark: SparkSession, keys_path: str, schema, checkpoint: str, out: str) -> None:
    """Bring the state up to date with all keys below ``keys_path``; each batch writes the state rows
    it changed to ``out/batch=N``.  A later call with the same checkpoint goes on where this one ended."""
    session = spark.newSession()
    for key, value in STATE.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    state = (
        session.readStream.schema(schema).parquet(keys_path).groupBy("digest")
        .agg(F.count("*").alias("group_size"), F.expr(f"min({RANK})").alias("keep"))
    )

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = state.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).foreachBatch(land).start().awaitTermination()


def read_state(spark: SparkSession, out: str) -> DataFrame:
    """The newest state of each digest."""
    schema = "digest binary, group_size long, keep struct<shorter long, nameless boolean, doc_id long, f long, r long>, batch int"
    return (
        spark.read.schema(schema).parquet(out).groupBy("digest")
        .agg(F.max(F.struct("batch", "group_size", "keep")).alias("s"))
        .select("digest", "s.group_size", "s.keep")
    )


def groups(docs: DataFrame, digest_bytes: int = 32) -> tuple[DataFrame, DataFrame]:
    """``located`` documents, and for each of their addresses: doc_id, sha, the rank of the row that
    stays (``keep``) and ``group_size``."""
    spark = docs.sparkSession
    rows = located(docs, "op2-docs")
    # Files on disk are what the stream reads; an empty table needs no stream.
    keys = materialise(keyed(rows, digest_bytes).drop("bare"), "op2-keys")
    if keys.isEmpty():
        return rows, keys.withColumn("keep", F.expr(RANK)).withColumn("group_size", F.lit(0).cast("long"))
    home = scratch_dir(spark, "op2-state")
    run_state(spark, keys.inputFiles()[0].rpartition("/")[0], keys.schema, f"{home}/checkpoint", f"{home}/out")
    state = materialise(read_state(spark, f"{home}/out"), "op2-groups")

    # Full bytes of all rows behind a repeated digest.  Equal texts of one task meet before the shuffle.
    hit = keys.join(state.where("group_size > 1").select("digest"), "digest").select("f", "r", "digest")
    bare = F.translate(F.coalesce("d.text", F.lit("")), WHITE, "").alias("bare")
    texts = rows.join(hit, ["f", "r"]).select("digest", bare)
    shared = materialise(
        texts.groupBy("digest", "bare").count().groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1"),
        "op2-collisions",
    )
    agreed = keys.join(state, "digest")
    if shared.isEmpty():
        return rows, agreed
    # Rows behind a digest of several texts are grouped by the texts themselves.
    again = keyed(rows, digest_bytes).join(shared.select("digest"), "digest", "left_semi")
    own = again.groupBy("digest", "bare").agg(F.count("*").alias("group_size"), F.expr(f"min({RANK})").alias("keep"))
    apart = again.join(own, ["digest", "bare"]).select(*agreed.columns)
    return rows, agreed.join(shared.select("digest"), "digest", "left_anti").unionByName(apart)


KEPT = "f = keep.f AND r = keep.r"


def exact_dedup(docs: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    _, members = groups(docs, digest_bytes)
    return members.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", F.expr(KEPT).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents without those that are copies of one that stays."""
    rows, members = groups(docs)
    return without(rows, members.where(f"NOT ({KEPT})"), "op2-dropped")
