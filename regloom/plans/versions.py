"""Mapping rules by version: each file is mapped with the rules its jurisdiction, format and version name."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.plans.compiler import cdm_columns, named
from regloom.plans.model import CDM
from regloom.plans.rules import MappingRules

RULES_ROOT = "cdm_mapping_rules"
KEY = "rules_key"


def load_rule_book(spark: SparkSession, root: str) -> dict[str, MappingRules]:
    """All rule files below ``root``, by their key (``rules_key``): configuration, a small file each."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").option("wholetext", "true")
    found = files.text(f"{root.rstrip('/')}/{RULES_ROOT}").select(F.url_decode("_metadata.file_path").alias("path"), "value").collect()
    return {RULES_ROOT + r["path"].rsplit(RULES_ROOT, 1)[1]: MappingRules.from_dict(json.loads(r["value"])) for r in found}


def used_rules(files: DataFrame, book: Mapping[str, MappingRules], key: str = KEY) -> dict[str, MappingRules]:
    """The part of the book that some file asks for; at most a key for each of its rule sets is brought to the driver."""
    asked = {r[0] for r in files.where(F.col(key).isin(list(book))).select(key).distinct().collect()}
    return {k: rules for k, rules in book.items() if k in asked}


def map_by_version(
    rows: DataFrame, book: Mapping[str, MappingRules], metadata: Mapping[str, Column | str | None] | None = None,
    model=CDM, key: str = KEY, keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine): rows mapped with the rules that their column ``key`` names, and rows that name none that are known.

    Each rule set is compiled once, and one projection over one scan picks the compiled columns by the key: no shuffle, and no scan a
    version.  Nested values come as JSON text, as their shapes differ from version to version.  Records are stamped with the
    label of their rules.  The quarantine has the key and the row as JSON.
    """
    book = dict(sorted(book.items()))
    columns = [c for c in rows.columns if c != key and c not in keep]
    choices: dict[str, Column] = {}
    for rules_key, rules in book.items():
        stamps = {**(metadata or {}), "cdm_mapping_rules": rules.label}
        mapped = cdm_columns(rows, rules, stamps, model, columns)
        schema = rows.select(*mapped).schema
        for c, f in zip(mapped, schema.fields, strict=True):
            text = F.to_json(c) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string")
            applies = F.col(key) == F.lit(rules_key)
            choices[f.name] = choices[f.name].when(applies, text) if f.name in choices else F.when(applies, text)
    known = F.coalesce(F.col(key).isin(list(book)), F.lit(False)) if book else F.lit(False)
    records = rows.where(known).select(*[c.alias(n) for n, c in choices.items()], *[named(c) for c in keep])
    lost = rows.where(~known).select(named(key), *[named(c) for c in keep], F.to_json(F.struct(*[named(c) for c in columns])).alias("row"))
    return records, lost
