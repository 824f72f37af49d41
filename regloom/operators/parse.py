"""Fixed-width lines to columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.functions.hashing import row_hash
from regloom.functions.text import WHITESPACE_SQL, clean_line, is_plain, split_lines
from regloom.plans.layout import Field, Layout

LINE, BYTES, PLAIN, UNQUOTED = "__line", "__bytes", "__plain", "__unquoted"


def _decoded(raw: Column) -> Column:
    """Lines inside one line of the text reader, decoded as UTF-8."""
    return split_lines(F.make_valid_utf8(raw))


def explode_lines(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per line, also breaking at the boundaries the text reader ignores.
    Undecodable bytes become U+FFFD."""
    return df.select(F.explode(_decoded(F.col(value))).alias(value), *keep)


def _stretches(layout: Layout) -> list[tuple[int, int, list[Field]]]:
    """Neighbouring fields in runs of about the square root of their number."""
    fields = sorted(layout.fields, key=lambda f: f.start)
    size = max(1, math.isqrt(len(fields)))
    runs = [fields[i : i + size] for i in range(0, len(fields), size)]
    return [(run[0].start, max(f.end for f in run), run) for run in runs]


def parse_fixed_width(
    lines: DataFrame,
    layout: Layout,
    add_hash: bool = True,
    value: str = "value",
    keep: Sequence[str] = (),
    decode: bool = False,
) -> DataFrame:
    """Clean, slice, strip and hash each line: narrow, no shuffle, no UDF.

    A line of printable ASCII has one byte per character, so its fields are cut
    from the bytes at a fixed offset.  Cutting characters instead walks the text
    from its start; a line that needs it is first cut into stretches, so a field is
    walked to from the start of its stretch.

    ``decode`` is for lines straight from the text reader: they are decoded and
    broken like ``explode_lines`` does, at no cost for plain lines.
    """
    flagged = lines.select(F.col(value).alias(LINE), is_plain(F.col(value)).alias(PLAIN), *keep)
    if decode:
        whole = F.when(F.col(PLAIN), F.array(F.col(LINE))).otherwise(_decoded(F.col(LINE)))
        flagged = flagged.select(F.explode(whole).alias(LINE), PLAIN, *keep)
    cleaned = flagged.select(clean_line(F.col(LINE)).alias(LINE), PLAIN, *keep)

    # SQL text rather than column calls: a layout has close to a hundred fields.
    stretches, fields = [], {}
    for i, (start, end, run) in enumerate(_stretches(layout)):
        stretches.append(f"CASE WHEN NOT {PLAIN} THEN substring({LINE}, {start}, {end - start + 1}) END AS __s{i}")
        for f in run:
            by_byte = f"CAST(substring({BYTES}, {f.start}, {f.length}) AS STRING)"
            by_char = f"substring(__s{i}, {f.start - start + 1}, {f.length})"
            fields[f.name] = (
                f"CASE WHEN {PLAIN} THEN trim({by_byte}) ELSE btrim(trim({by_char}), {WHITESPACE_SQL}) END AS `{f.name}`"
            )
    unquoted = f"{PLAIN} AND NOT contains({LINE}, '\\'') AND NOT contains({LINE}, '\\\\') AS {UNQUOTED}"
    prepared = cleaned.selectExpr(f"CAST({LINE} AS BINARY) AS {BYTES}", PLAIN, unquoted, *stretches, *keep)
    sliced = prepared.selectExpr(*[fields[n] for n in layout.names], PLAIN, UNQUOTED, *keep)
    names = [f"`{n}`" for n in layout.names]
    if not add_hash:
        return sliced.select(*names, *keep)
    hashed = row_hash(names, printable=F.col(PLAIN), plain=F.col(UNQUOTED))
    return sliced.select(*names, hashed.alias("hash"), *keep)


def render_fixed_width(df: DataFrame, layout: Layout, value: str = "value") -> DataFrame:
    """The opposite of parsing: columns padded into lines (test and sample data)."""
    parts, at = [], 1
    for f in sorted(layout.fields, key=lambda f: f.start):
        if f.start > at:
            parts.append(f"space({f.start - at})")
        parts.append(f"rpad(coalesce(`{f.name}`, ''), {f.length}, ' ')")
        at = f.end + 1
    return df.selectExpr(f"concat({', '.join(parts)}) AS {value}")
