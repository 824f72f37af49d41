"""A corpus pipeline of five of the operators; each stage takes (spark, docs, sf_dir) and works on all it is given.

Defined cases, from the operators' own: without labels of both kinds no document is rejected unless the share of label 1 is below the threshold; of
equal texts the longest original stays, then the smallest id; of near copies the smallest id, null ids last; null, empty and blank
texts are equal to each other, so one of them stays; a document without an id can be rejected, dropped or packed like any other; empty
tables give empty results; other columns pass through to the last stage, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regloom.llm import decontaminate, exact_dedup, packing, quality_cnn, simhash_tiles
from regloom.llm.common import table
from regloom.llm.queries import tokenizer_path
from regloom.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_cnn.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_tiles.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", clean), ("pack", pack)]

# SQL can express neither the classifier nor the fingerprints nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
