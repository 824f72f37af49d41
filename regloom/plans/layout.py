"""Fixed-width layouts: named fields at 1-based inclusive positions."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Field:
    name: str
    start: int
    end: int

    @property
    def length(self) -> int:
        return self.end - self.start + 1


@dataclass(frozen=True)
class Layout:
    fields: tuple[Field, ...]
    meta: Mapping[str, Any] = field(default_factory=dict, hash=False)

    def __post_init__(self):
        for f in self.fields:
            if f.start < 1 or f.end < f.start:
                raise ValueError(f"field {f.name}: positions {f.start}-{f.end} are not 1-based inclusive")

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def parsed_by(self) -> str:
        return f"{self.meta.get('file_name')}_{self.meta.get('version')}"

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> Layout:
        fields = tuple(Field(f["name"], int(f["start"]), int(f["end"])) for f in raw["fields"])
        return cls(fields, dict(raw.get("meta_data") or {}))

    @classmethod
    def from_widths(cls, widths: Iterable[tuple[str | None, int]], **meta: Any) -> Layout:
        """Fields laid end to end; a name of None is a gap."""
        fields, at = [], 1
        for name, width in widths:
            if name is not None:
                fields.append(Field(name, at, at + width - 1))
            at += width
        return cls(tuple(fields), meta)


def read_config(path: str, spark: SparkSession | None = None) -> dict[str, Any]:
    """A small JSON configuration file, from any file system Spark can read."""
    if spark is not None:
        text = spark.read.text(path, wholetext=True).head()[0]
    else:
        with open(path, encoding="utf-8") as f:
            text = f.read()
    return json.loads(text)


def load_layout(path: str, spark: SparkSession | None = None) -> Layout:
    return Layout.from_dict(read_config(path, spark))
