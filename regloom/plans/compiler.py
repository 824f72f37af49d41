"""Mapping rules compiled to one ``select`` of native expressions.

Rules and column names are both known before a row is read, so every decision
that depends on them is taken once, here: which rule a column obeys, which group
label its name carries, and where its value lands.  What is left for the
executors is a tree of ``struct``, ``coalesce`` and ``when``.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.functions.dates import date_struct
from regloom.functions.text import non_empty
from regloom.plans.model import CDM, TargetModel, target_model
from regloom.plans.rules import MappingRule, MappingRules, Strategy, ValueType

log = logging.getLogger(__name__)

PLAIN_STRATEGIES = (Strategy.COPY, Strategy.ADD)


@dataclass(frozen=True)
class Target:
    """Where a column's value lands. ``path`` starts with a model column; with
    ``grouped`` its second step is a group label."""

    path: tuple[str, ...]
    grouped: bool = False


@dataclass(frozen=True)
class Write:
    column: str
    target: Target
    rule: MappingRule


@dataclass
class CompiledMapping:
    """Result of compiling: writes in column order, literals, and warnings."""

    writes: list[Write] = field(default_factory=list)
    literals: list[tuple[Target, MappingRule]] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    def warn(self, text: str) -> None:
        self.warnings.append(text)
        log.warning(text)


def rule_for(column: str, rules: MappingRules) -> MappingRule | None:
    """The rule a source column obeys: the first one naming it exactly, else the
    single pattern rule matching the start of its name."""
    for rule in rules.rules.values():
        if rule.source_field and rule.source_field == column:
            return rule
    matching = [
        rule
        for rule in rules.rules.values()
        if rule.pattern is not None
        and rule.strategy in (Strategy.REGEX, Strategy.FIND_REGEX_PARENT)
        and re.match(rule.pattern, column)
    ]
    if len(matching) > 1:
        fields = ", ".join(r.cdm_field for r in matching)
        raise ValueError(f"column {column!r} matches more than one pattern rule ({fields})")
    return matching[0] if matching else None


def _label(rule: MappingRule, column: str) -> str | None:
    """Group label: what the pattern captures from the column name."""
    found = re.match(rule.pattern, column) if rule.pattern else None
    return found.group(1) if found and found.re.groups else None


def target_of(rule: MappingRule, column: str, rules: MappingRules, model: TargetModel) -> Target | str:
    """The rule's target for this column, or the reason why it writes nothing."""
    if rule.strategy is Strategy.LITERAL:
        return "a literal rule reads no column"
    if rule.strategy is Strategy.REGEX:
        if rule.pattern is None or rule.cdm_parent is None:
            raise ValueError(f"regex rule {rule.cdm_field!r} needs pattern and cdm_parent")
        return _grouped_target(rule, _label(rule, column), rules, model)
    if rule.strategy is Strategy.FIND_REGEX_PARENT:
        if not rule.pattern_group or not rule.cdm_parent:
            raise ValueError(f"find_regex_parent rule {rule.cdm_field!r} needs pattern_group and cdm_parent")
        if rule.cdm_parent in model:
            return "it declares a nested value and holds none itself"
        return _grouped_target(rule, _label(rule, column) or rule.group, rules, model)
    return _plain_target(rule, rules, model)


def _grouped_target(
    rule: MappingRule, label: str | None, rules: MappingRules, model: TargetModel
) -> Target | str:
    parent = rules.parent_of(rule)
    if parent.cdm_field in model:
        if not label:
            return "its pattern captures no group label"
        return Target((parent.cdm_field, label, rule.cdm_field), grouped=True)
    if parent.cdm_parent is None or parent.cdm_parent not in model:
        raise ValueError(f"rule {rule.cdm_field!r}: parent {rule.cdm_parent!r} hangs below no model column")
    rules.parent_of(parent)
    if parent.strategy in PLAIN_STRATEGIES:
        return Target((parent.cdm_parent, parent.cdm_field, rule.cdm_field))
    return Target((parent.cdm_parent, label or parent.group, parent.cdm_field, rule.cdm_field), grouped=True)


def _plain_target(rule: MappingRule, rules: MappingRules, model: TargetModel) -> Target | str:
    if rule.cdm_parent is None:
        if rule.cdm_field not in model:
            return f"{rule.cdm_field!r} is not a column of the target model"
        return Target((rule.cdm_field,))
    parent = rules.parent_of(rule)
    if rule.cdm_parent in model:
        return Target((rule.cdm_parent, rule.cdm_field))
    if parent.cdm_parent is None or parent.cdm_parent not in model:
        return f"parent {rule.cdm_parent!r} hangs below no model column"
    rules.parent_of(parent)
    if parent.strategy is Strategy.FIND_REGEX_PARENT:
        return Target((parent.cdm_parent, parent.group, parent.cdm_field, rule.cdm_field), grouped=True)
    return Target((parent.cdm_parent, parent.cdm_field, rule.cdm_field))


def compile_rules(
    columns: Sequence[str], rules: MappingRules, model: TargetModel = CDM
) -> CompiledMapping:
    compiled = CompiledMapping()
    for column in columns:
        rule = rule_for(column, rules)
        if rule is None:
            continue
        target = target_of(rule, column, rules, model)
        if isinstance(target, str):
            compiled.warn(f"column {column!r} is not mapped by rule {rule.cdm_field!r}: {target}")
            continue
        top_level_name = rule.strategy in PLAIN_STRATEGIES and rule.cdm_field in model
        if rule.cdm_parent is not None and top_level_name:
            compiled.warn(f"rule {rule.cdm_field!r} has the name of a model column but writes below {target.path[0]!r}")
        compiled.writes.append(Write(column, target, rule))
    for rule in rules.rules.values():
        if rule.strategy is Strategy.LITERAL:
            target = _literal_target(rule, compiled.writes, rules, model)
            if isinstance(target, str):
                compiled.warn(f"literal rule {rule.cdm_field!r} is not applied: {target}")
            else:
                compiled.literals.append((target, rule))
    _check_tree(compiled)
    return compiled


def _literal_target(
    rule: MappingRule, writes: Sequence[Write], rules: MappingRules, model: TargetModel
) -> Target | str:
    if rule.pattern_group:
        tops = [w.target.path[0] for w in writes if w.target.grouped and w.target.path[1] == rule.pattern_group]
        if not tops:
            return f"no column belongs to group {rule.pattern_group!r}"
        top = rule.cdm_parent if rule.cdm_parent in tops else min(tops, key=model.position)
        return Target((top, rule.pattern_group, rule.cdm_field), grouped=True)
    if rule.cdm_parent:
        parent = rules.parent_of(rule)
        if parent.cdm_field not in model:
            return f"parent {rule.cdm_parent!r} is not a column of the target model"
        return Target((parent.cdm_field, rule.cdm_field))
    if rule.cdm_field not in model:
        return f"{rule.cdm_field!r} is not a column of the target model"
    return Target((rule.cdm_field,))


def _check_tree(compiled: CompiledMapping) -> None:
    """No path may be both a value and a parent of values."""
    paths = {w.target.path for w in compiled.writes} | {t.path for t, _ in compiled.literals}
    for path in paths:
        for cut in range(1, len(path)):
            if path[:cut] in paths:
                raise ValueError(f"{'.'.join(path[:cut])} is mapped both as a value and as the parent of {path[-1]!r}")


class _Cells:
    """Source cells as expressions: value, and whether the cell holds anything.
    Each expression is built once, however many targets refer to it."""

    def __init__(self, schema: T.StructType):
        self.types = {f.name: f.dataType for f in schema.fields}
        self.known: dict[tuple, Column] = {}

    def raw(self, name: str) -> Column:
        return self._once(("raw", name), lambda: named(name))

    def value(self, name: str) -> Column:
        raw = self.raw(name)
        return self._once(("value", name), lambda: non_empty(raw)) if self.is_text(name) else raw

    def is_text(self, name: str) -> bool:
        return isinstance(self.types[name], T.StringType)

    def any_present(self, names: Sequence[str]) -> Column:
        """Does any of the cells hold a value? Stops at the first that does."""
        tests = [
            f"{_sql_name(n)} <> ''" if self.is_text(n) else f"{_sql_name(n)} IS NOT NULL"
            for n in dict.fromkeys(names)
        ]
        if not tests:
            return F.lit(False)
        return self._once(("any", *tests), lambda: F.expr(f"coalesce({' OR '.join(tests)}, false)"))

    def _once(self, key: tuple, make) -> Column:
        if key not in self.known:
            self.known[key] = make()
        return self.known[key]

    def as_written(self, write: Write, as_text: bool) -> Column:
        value = self.value(write.column)
        rule = write.rule
        dated = rule.value_type is ValueType.DATE and rule.strategy in PLAIN_STRATEGIES
        if dated:
            if not rule.python_date_format:
                raise ValueError(f"date rule {rule.cdm_field!r} needs python_date_format")
            value = F.when(
                value.isNotNull(), date_struct(value.cast("string"), rule.date_format, rule.python_date_format)
            )
        if as_text:
            nested = dated or isinstance(
                self.types[write.column], (T.StructType, T.ArrayType, T.MapType)
            )
            value = F.to_json(value) if nested else value.cast("string")
        return value

    def kind(self, write: Write) -> str:
        if write.rule.value_type is ValueType.DATE and write.rule.strategy in PLAIN_STRATEGIES:
            return "date"
        return self.types[write.column].simpleString()


def _leaf(
    cells: _Cells,
    writes: Sequence[Write],
    literal: Column | None,
    gate: Column,
    group_columns: Sequence[str],
    stamped: Column | None,
) -> Column:
    """One value from all that write it."""
    mixed = len({cells.kind(w) for w in writes}) > 1
    as_text = mixed or ((literal is not None or stamped is not None) and bool(writes))
    if literal is not None and not group_columns:
        return F.when(gate, literal)  # re-applied on each cell, so it beats every copy
    values = [cells.as_written(w, as_text) for w in writes]
    if not group_columns:
        nested = bool(writes) and len(writes[0].target.path) > 1
        # Inside a parent the last write stays; a top-level column keeps the first.
        ordered = list(reversed(values)) if nested else values
        return F.coalesce(*([stamped] if stamped is not None else []), *ordered)
    if literal is None:
        return F.coalesce(*reversed(values))
    # A group's literal is set once, right after the cell that opens the group;
    # only cells after that one overwrite it.
    later = []
    for write, value in zip(writes, values):
        before = group_columns[: group_columns.index(write.column)]
        if before:
            later.append(F.when(cells.any_present(before), value))
    return F.coalesce(*reversed(later), literal)


def _assemble(
    cells: _Cells,
    top: str,
    compiled: CompiledMapping,
    gate: Column,
    stamped: Column | None,
) -> Column:
    writes = [w for w in compiled.writes if w.target.path[0] == top]
    literals = {t.path: r for t, r in compiled.literals if t.path[0] == top}
    paths = list(dict.fromkeys([w.target.path for w in writes] + list(literals)))

    def group_columns(label: str) -> list[str]:
        return [w.column for w in writes if w.target.grouped and w.target.path[1] == label]

    grouped_labels = {w.target.path[1] for w in writes if w.target.grouped}

    def value(path: tuple[str, ...]) -> Column:
        own = [w for w in writes if w.target.path == path]
        in_group = len(path) > 2 and path[1] in grouped_labels
        literal = F.lit(literals[path].literal_value).cast("string") if path in literals else None
        members = group_columns(path[1]) if in_group and literal is not None else []
        return _leaf(cells, own, literal, gate, members, stamped if len(path) == 1 else None)

    def present(prefix: tuple[str, ...]) -> Column:
        below = [w.column for w in writes if w.target.path[: len(prefix)] == prefix]
        seen = cells.any_present(below)
        opened_by_literal = any(
            p[: len(prefix)] == prefix and not (len(p) > 2 and p[1] in grouped_labels) for p in literals
        )
        return (seen | gate) if opened_by_literal else seen

    def build(prefix: tuple[str, ...]) -> Column:
        depth = len(prefix)
        if prefix in paths:
            return value(prefix)
        names = list(dict.fromkeys(p[depth] for p in paths if p[:depth] == prefix))
        nested = F.struct(*[build(prefix + (n,)).alias(n) for n in names])
        return F.when(present(prefix), nested)

    nested_value = build((top,))
    if stamped is not None and (top,) not in paths:
        # A stamped text wins over nested values, which then become text as well.
        return F.coalesce(stamped, F.to_json(nested_value))
    return nested_value


def map_to_cdm(
    df: DataFrame,
    rules: MappingRules,
    metadata: Mapping[str, Column | str | None] | None = None,
    model=CDM,
    source_columns: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Map source rows to the target model: one projection, no shuffle, no UDF.

    ``metadata`` values (constants or columns) are laid over the empty model
    before mapping: a copy does not replace them, a literal does.  Metadata keys
    outside the model become extra columns.  ``keep`` columns pass through.
    """
    columns = list(source_columns) if source_columns is not None else [c for c in df.columns if c not in keep]
    return df.select(*cdm_columns(df, rules, metadata, model, columns), *[named(c) for c in keep])


def cdm_columns(
    df: DataFrame, rules: MappingRules, metadata: Mapping[str, Column | str | None] | None, model, columns: Sequence[str]
) -> list[Column]:
    """The columns of the target model, then further metadata, as expressions over the source ``columns`` of ``df``."""
    model = target_model(model)
    compiled = compile_rules(columns, rules, model)
    cells = _Cells(df.select(*[named(c) for c in columns]).schema)
    gate = cells.any_present(columns)
    stamps = {k: _constant(v) for k, v in (metadata or {}).items()}
    touched = {w.target.path[0] for w in compiled.writes} | {t.path[0] for t, _ in compiled.literals}

    out = []
    for name in model.fields:
        stamped = stamps.get(name)
        if name in touched:
            c = _assemble(cells, name, compiled, gate, stamped)
        elif stamped is not None:
            c = stamped
        else:
            c = F.lit(None).cast("string")
        out.append(c.alias(name))
    extra = [v.alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in stamps.items() if k not in model]
    return [*out, *extra]


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    return F.col(_sql_name(name))


def _constant(value) -> Column | None:
    if value is None or isinstance(value, Column):
        return value
    return F.lit(value)
