"""File metadata: provenance labels, stamping, backfill."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.functions.dates import iso_text
from regloom.functions.keys import source_table
from regloom.functions.text import base_name
from regloom.plans.layout import Layout
from regloom.plans.rules import MappingRules

# The metadata stamped on a record, in order.
METADATA_FIELDS = (
    "source_name",
    "fetched_by",
    "fetched_at",
    "parsed_by",
    "parsed_at",
    "cdm_mapping_rules",
    "cdm_mapped_by",
    "cdm_mapped_at",
    "hash",
    "source_timestamp",
)
# ``periodicity`` is a model column too; it is stamped when a file supplies it.
OPTIONAL_FIELDS = ("periodicity",)


def render_metadata(meta: DataFrame, prefix: str | None = None) -> dict[str, Column]:
    """Metadata columns as they are stamped: ``source_name`` falls back to
    ``fetched_file`` (which is not stamped itself), times become ISO text, keys
    the model does not know are left out, missing ones are null."""
    names = {f.name: f.dataType for f in meta.schema.fields}

    def at(name: str) -> Column:
        c = F.col(f"{prefix}.{name}" if prefix else name)
        return iso_text(c) if isinstance(names[name], (T.TimestampType, T.TimestampNTZType)) else c

    out = {}
    for name in METADATA_FIELDS + tuple(n for n in OPTIONAL_FIELDS if n in names):
        c = at(name) if name in names else F.lit(None).cast("string")
        if name == "source_name" and "fetched_file" in names:
            c = F.coalesce(c, F.when(at("fetched_file") != "", at("fetched_file")))
        out[name] = c
    return out


def parse_labels(layout: Layout, jurisdiction: str, parsed_at: str) -> dict[str, str]:
    """Labels a parsed file carries. The clock is passed in, so runs repeat."""
    return {"parsed_by": layout.parsed_by, "parsed_at": parsed_at, "target": source_table(jurisdiction)}


def mapping_labels(rules: MappingRules, mapped_by: str, mapped_at: str) -> dict[str, str]:
    return {"cdm_mapping_rules": rules.label, "cdm_mapped_by": mapped_by, "cdm_mapped_at": mapped_at}


def join_file_metadata(rows: DataFrame, files: DataFrame, on: str = "path", alias: str = "_file") -> DataFrame:
    """Each row with its file's metadata as one struct column ``alias``."""
    packed = files.select(F.col(on), F.struct(*[c for c in files.columns if c != on]).alias(alias))
    return rows.join(packed, on, "left")


def is_metadata_set(columns: Iterable[str], metadata: Mapping | None) -> bool:
    """Does a record with these columns carry every metadata key?"""
    if not metadata:
        raise ValueError("metadata is required")
    columns = list(columns)
    return bool(columns) and all(k in columns for k in metadata)


def stamp_metadata(df: DataFrame, metadata: Mapping[str, Column | str | None]) -> DataFrame:
    """Fill metadata columns that are missing or null; values present stay."""
    stamps = {}
    for name, value in metadata.items():
        value = value if isinstance(value, Column) else F.lit(value).cast("string")
        stamps[name] = F.coalesce(F.col(f"`{name}`"), value) if name in df.columns else value
    return df.withColumns(stamps)


def backfill(
    files: DataFrame, field: str, value: str | None = None, overwrite: bool = False, key: str = "path"
) -> DataFrame:
    """Set a metadata field where it is missing or empty, or everywhere with
    ``overwrite``.  ``source_name`` takes the file's own name; an empty value
    changes nothing.  ``changed`` tells which rows a real run would touch."""
    current = F.col(field) if field in files.columns else F.lit(None).cast("string")
    if field == "source_name":
        new = base_name(F.col(key))
    else:
        new = F.lit(value or None).cast("string")
    takes = new.isNotNull() & (F.lit(overwrite) | current.isNull() | (current == ""))
    kept = [c for c in files.columns if c != field]
    return files.select(*kept, F.when(takes, new).otherwise(current).alias(field), takes.alias("changed"))


def backfill_dry_run(files: DataFrame, field: str, value: str | None = None, overwrite: bool = False, key="path") -> DataFrame:
    """Only the rows a backfill would change."""
    return backfill(files, field, value, overwrite, key).filter("changed").drop("changed")
