"""Mapping rules: which source column goes where in the target model."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from enum import Enum
from typing import Any

from pyspark.sql import SparkSession

from regloom.plans.layout import read_config


class Strategy(Enum):
    COPY = ""
    LITERAL = "literal"
    REGEX = "regex"
    ADD = "add"
    FIND_REGEX_PARENT = "find_regex_parent"


class ValueType(Enum):
    PLAIN = ""
    LIST = "list"
    DICT = "dict"
    DATE = "date"


@dataclass(frozen=True)
class MappingRule:
    cdm_field: str
    source_field: str | None = None
    cdm_parent: str | None = None
    value_type: ValueType = ValueType.PLAIN
    strategy: Strategy = Strategy.COPY
    pattern_group: str | int | None = None
    pattern: str | None = None
    literal_value: str | None = None
    date_format: str | None = None
    python_date_format: str | None = None

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> MappingRule:
        """Unknown keys are ignored; a missing ``cdm_field`` or an unknown
        strategy or value type is an error."""
        known = {f.name for f in fields(cls)}
        values = {k: v for k, v in raw.items() if k in known}
        if not isinstance(values.get("cdm_field"), str):
            raise ValueError(f"a mapping rule needs cdm_field: {dict(raw)}")
        if "value_type" in values:
            values["value_type"] = ValueType(values["value_type"])
        if "strategy" in values:
            values["strategy"] = Strategy(values["strategy"])
        return cls(**values)

    @property
    def group(self) -> str:
        return str(self.pattern_group)


@dataclass(frozen=True)
class MappingRules:
    rules: Mapping[str, MappingRule]
    meta: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> MappingRules:
        meta = raw.get("meta_data")
        if not meta or "file_name" not in meta:
            raise ValueError("mapping rules need meta_data.file_name")
        rules = {name: MappingRule.from_dict(rule) for name, rule in raw["rules"].items()}
        return cls(rules, dict(meta))

    @property
    def label(self) -> str:
        return f"{self.meta.get('file_name')}:{self.meta.get('version')}"

    def by_field(self, name: str) -> list[MappingRule]:
        return [r for r in self.rules.values() if r.cdm_field == name]

    def parent_of(self, rule: MappingRule) -> MappingRule:
        """The rule that declares ``rule.cdm_parent``: a top-level one if it comes
        first, else the one of the same pattern group."""
        declared = self.by_field(rule.cdm_parent)
        if not declared:
            raise ValueError(f"{rule.cdm_parent} is not defined in the mapping rules")
        for candidate in declared:
            if candidate.cdm_parent is None or candidate.group == rule.group:
                return candidate
        raise ValueError(f"no parent rule for {rule.cdm_field} in group {rule.pattern_group}")

    def date_fields(self) -> list[str]:
        """Target columns that hold dates, each once, in rule order."""
        dated = [r for r in self.rules.values() if r.value_type is ValueType.DATE]
        return list(dict.fromkeys(r.cdm_parent or r.cdm_field for r in dated))

    def date_formats(self) -> list[str]:
        found = [r.python_date_format for r in self.rules.values() if r.python_date_format]
        return list(dict.fromkeys(found))


def load_rules(path: str, spark: SparkSession | None = None) -> MappingRules:
    return MappingRules.from_dict(read_config(path, spark))
