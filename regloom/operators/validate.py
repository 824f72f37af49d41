"""Date validity and the split into valid and quarantined rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.functions.dates import KNOWN_FORMATS, let, parses
from regloom.functions.text import non_empty

ROUTE = "_route"
ENTRY = "struct<value:string,python_date_format:string>"


def _entry_ok(value: Column, fmt: Column, no_data_ok: bool, formats: Sequence[str]) -> Column:
    value, fmt = non_empty(value), non_empty(fmt)
    ok = F.when(value.isNotNull() & fmt.isNotNull(), F.coalesce(parses(value, fmt, formats), F.lit(False)))
    if no_data_ok:
        ok = ok.when(value.isNull() & fmt.isNull(), F.lit(True))
    return ok.otherwise(F.lit(False))


def _struct_entries(c: Column, kind: T.StructType, format_name: str, no_data_ok: bool, formats) -> list[tuple]:
    """(present, valid) of each entry, in the order the entries are written."""
    entries = []
    for f in kind.fields:
        child = c.getField(f.name)
        names = f.dataType.names if isinstance(f.dataType, T.StructType) else []
        if "value" in names or format_name in names:
            value = child.getField("value") if "value" in names else F.lit(None).cast("string")
            fmt = child.getField(format_name) if format_name in names else F.lit(None).cast("string")
            valid = _entry_ok(value, fmt, no_data_ok, formats)
        else:
            valid = F.lit(False)
        entries.append((child.isNotNull(), valid))
    return entries


def _text_entries(c: Column, format_name: str, first_only: bool) -> Column:
    """Array of (object, value, fmt) of JSON text, in text order."""
    parsed = F.map_values(F.from_json(c, "map<string,string>"))
    kind = f"struct<value:string,{format_name}:string>"

    def entry(raw: Column) -> Column:
        is_object = F.coalesce(F.ltrim(raw).startswith("{"), F.lit(False))
        return F.struct(is_object.alias("object"), F.from_json(raw, kind).alias("entry"))

    found = F.transform(F.slice(parsed, 1, 1) if first_only else parsed, entry)
    return F.transform(
        found,
        lambda e: F.struct(
            e.getField("object").alias("object"),
            e.getField("entry").getField("value").alias("value"),
            e.getField("entry").getField(format_name).alias("fmt"),
        ),
    )


def is_date_valid(
    df: DataFrame,
    name: str,
    no_data_ok: bool = False,
    mode: str = "first",
    format_name: str = "python_date_format",
    formats: Sequence[str] = KNOWN_FORMATS,
) -> Column:
    """Validity of a date column: a struct or map of date entries, or JSON text.

    ``mode="first"`` lets the first written entry decide; ``"all"`` asks every
    entry.  A missing column value is valid only with ``no_data_ok``.
    """
    if mode not in ("first", "all"):
        raise ValueError(f"mode is 'first' or 'all', not {mode!r}")
    c = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, T.StructType):

        def judged_struct(c: Column) -> Column:
            entries = _struct_entries(c, kind, format_name, no_data_ok, formats)
            if mode == "first":
                decided = F.coalesce(*[F.when(present, valid) for present, valid in entries])
            else:
                seen, every = F.lit(False), F.lit(True)
                for present, valid in entries:
                    seen, every = seen | present, every & (~present | valid)
                decided = seen & every
            return F.when(c.isNull(), F.lit(no_data_ok)).otherwise(F.coalesce(decided, F.lit(no_data_ok)))

        # Named once: a filter pushed below the mapping copies the column's expression once, not once per test.
        return let(c, judged_struct)
    if isinstance(kind, T.StringType):
        array, empty = _text_entries(c, format_name, mode == "first"), c == ""
    elif isinstance(kind, T.MapType):
        array = F.transform(
            F.map_values(c),
            lambda e: F.struct(
                e.isNotNull().alias("object"), e.getField("value").alias("value"), e.getField(format_name).alias("fmt")
            ),
        )
        empty = F.size(c) == 0
    else:
        raise ValueError(f"column {name!r} of type {kind.simpleString()} holds no dates")

    def ok(e: Column) -> Column:
        return e.getField("object") & _entry_ok(e.getField("value"), e.getField("fmt"), no_data_ok, formats)

    # Judged inside a lambda, so an entry is decoded once and not once per test.
    if mode == "first":
        decided = F.get(F.transform(F.slice(array, 1, 1), ok), F.lit(0))
    else:
        judged = F.transform(array, ok)
        decided = F.exists(judged, lambda v: v.isNotNull()) & F.forall(judged, lambda v: v)
    return F.when(c.isNull() | empty, F.lit(no_data_ok)).otherwise(F.coalesce(decided, F.lit(False)))


def rows_valid(df: DataFrame, date_fields: Sequence[str], **options) -> Column:
    """True where every date field is valid."""
    ok = F.lit(True)
    for name in date_fields:
        ok = ok & is_date_valid(df, name, **options)
    return ok


def with_route(df: DataFrame, date_fields: Sequence[str], no_data_ok: bool = True, **options) -> DataFrame:
    """Adds ``_route``: ``valid`` or ``invalid``."""
    ok = rows_valid(df, date_fields, no_data_ok=no_data_ok, **options)
    return df.withColumn(ROUTE, F.when(ok, F.lit("valid")).otherwise(F.lit("invalid")))


def split_by_dates(
    df: DataFrame, date_fields: Sequence[str], no_data_ok: bool = True, computed: bool = False, **options
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows), as plain filters on the date columns, so that further filters and
    pruning reach the scan.  To write both, prefer ``write_routes``: it computes the rows once.

    ``computed`` is for frames whose date columns a mapping has still to make.  A plain filter would be pushed
    below the mapping with a copy of its date expressions; this one stays above it, and so do later filters.
    """
    ok = rows_valid(df, date_fields, no_data_ok=no_data_ok, **options)
    if not computed:
        return df.filter(ok), df.filter(~ok)
    # The id is never negative, so the value does not change; but Spark moves no filter below it.
    judged = df.withColumn(ROUTE, F.when(F.monotonically_increasing_id() >= 0, ok))
    return judged.filter(F.col(ROUTE)).drop(ROUTE), judged.filter(~F.col(ROUTE)).drop(ROUTE)


def route_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy(ROUTE).agg(F.count("*").alias("rows"))
