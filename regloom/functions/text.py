"""Line cleaning and stripping with Python's definition of white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points of every character for which Python's str.isspace()
# holds.
WHITESPACE_CODES = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
WHITESPACE = "".join(map(chr, WHITESPACE_CODES))
WHITESPACE_SQL = "'" + "".join(f"\\u{c:04X}" for c in WHITESPACE_CODES) + "'"

# Code points of the line boundaries of str.splitlines() that
# Spark's text reader does not break at.
LINE_BREAK_CODES = [0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x85, 0x2028, 0x2029]
EXTRA_LINE_BREAKS = "[" + "".join(map(chr, LINE_BREAK_CODES)) + "]"

# A line of printable ASCII: one byte per character, blank the only white space.
NOT_PLAIN = "[^ -~]"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def clean_line(c: Column) -> Column:
    """Drop every double quote and NUL.  Happens before slicing, so what follows
    a dropped character moves left."""
    dirty = F.contains(c, F.lit('"')) | F.contains(c, F.lit("\x00"))
    return F.when(dirty, F.regexp_replace(c, '["\x00]', "")).otherwise(c)


def is_plain(c: Column) -> Column:
    return ~c.rlike(NOT_PLAIN)


def non_empty(c: Column) -> Column:
    """The value, or null where it is the empty string."""
    return F.when(c != "", c)


def split_lines(c: Column) -> Column:
    """Array of the lines inside one text-reader line."""
    return F.when(c.rlike(EXTRA_LINE_BREAKS), F.split(c, EXTRA_LINE_BREAKS)).otherwise(F.array(c))


def base_name(c: Column) -> Column:
    return F.regexp_extract(c, "([^/]*)$", 1)


def stem(c: Column) -> Column:
    """Base name up to its first dot."""
    return F.substring_index(base_name(c), ".", 1)
