"""The common company model: 26 columns, and the parts of it other jobs need."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import types as T

# The model's columns in order.
CDM_FIELDS = (
    "company_number",
    "name",
    "jurisdiction_code",
    "current_status",
    "company_type",
    "incorporation_date",
    "dissolution_date",
    "registry_url",
    "officers",
    "registered_address",
    "mailing_address",
    "headquarters_address",
    "company_identifiers",
    "all_attributes",
    "previous_names",
    "periodicity",
    "fetched_by",
    "fetched_at",
    "parsed_by",
    "parsed_at",
    "cdm_mapping_rules",
    "cdm_mapped_by",
    "cdm_mapped_at",
    "source_name",
    "hash",
    "source_timestamp",
)

# Columns that hold nested values, as JSON text at rest.
CDM_JSON_FIELDS = (
    "incorporation_date",
    "dissolution_date",
    "officers",
    "registered_address",
    "mailing_address",
    "headquarters_address",
    "company_identifiers",
    "all_attributes",
    "previous_names",
)

# Timestamp columns of the lake tables.
CDM_TIMESTAMP_FIELDS = ("fetched_at", "parsed_at", "cdm_mapped_at")


@dataclass(frozen=True)
class TargetModel:
    """Any ordered set of target columns; ``CDM`` is the shipped one."""

    fields: tuple[str, ...]

    def __contains__(self, name: str) -> bool:
        return name in self.fields

    def position(self, name: str) -> int:
        return self.fields.index(name)


def target_model(fields: Iterable[str] | type[Enum] | TargetModel) -> TargetModel:
    """A model from field names, or from an enum whose values are the names."""
    if isinstance(fields, TargetModel):
        return fields
    if isinstance(fields, type) and issubclass(fields, Enum):
        return TargetModel(tuple(f.value for f in fields))
    return TargetModel(tuple(fields))


CDM = TargetModel(CDM_FIELDS)


def validate_field_exists(name: str) -> bool:
    return name in CDM


def lake_schema() -> T.StructType:
    """Schema of the staging tables: JSON columns as text, three timestamps."""
    return T.StructType(
        [
            T.StructField(f, T.TimestampType() if f in CDM_TIMESTAMP_FIELDS else T.StringType())
            for f in CDM_FIELDS
        ]
    )


def timestamp_fields(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampType)]
