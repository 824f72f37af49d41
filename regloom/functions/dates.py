"""Lenient dates: what Python's strptime accepts, as native expressions.

Formats are constants of the mapping rules, so each becomes one regular
expression when the plan is built.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What each strptime directive accepts, longest choice first.
DIRECTIVES = {
    "d": r"3[0-1]|[1-2]\d|0[1-9]|[1-9]| [1-9]",
    "m": r"1[0-2]|0[1-9]|[1-9]",
    "Y": r"\d\d\d\d",
    "y": r"\d\d",
    "b": "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec",
    "B": "january|february|march|april|may|june|july|august|september|october|november|december",
    "H": r"2[0-3]|[0-1]\d|\d",
    "M": r"[0-5]\d|\d",
    "S": r"[0-5]\d|\d",
    "f": r"\d{1,6}",
}
# The date_format letters that print what strftime prints.
PRINTED = {"d": "dd", "m": "MM", "Y": "yyyy", "y": "yy", "b": "MMM", "B": "MMMM"}
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]+"

# Formats of the shipped rule sets, the file-time formats and the common others.
KNOWN_FORMATS = ("%m%d%Y", "%d %b %Y", "%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%Y%m%d", "%Y-%m-%dT%H:%M:%S")

DATE_STRUCT = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("python_date_format", T.StringType()),
    ]
)


@dataclass(frozen=True)
class DateFormat:
    """A strptime format taken apart: a Java pattern and its directives in order."""

    source: str
    prefix: str
    tokens: tuple[tuple[str, str], ...]  # ("text", literal) or ("field", directive)
    groups: tuple[str, ...]

    @property
    def pattern(self) -> str:
        return self.prefix + r"\z"


def parse_format(fmt: str) -> DateFormat:
    tokens: list[tuple[str, str]] = []
    groups: list[str] = []
    pattern = ""

    def text(literal: str) -> None:
        if tokens and tokens[-1][0] == "text":
            literal = tokens.pop()[1] + literal
        tokens.append(("text", literal))

    for token in re.findall(r"%.|\s+|[^%\s]+|%$", fmt):
        if token == "%%":
            text("%")
            pattern += "%"
        elif token.startswith("%"):
            name = token[1:]
            if name not in DIRECTIVES:
                raise ValueError(f"date directive {token!r} of {fmt!r} is not supported")
            if name in groups:
                raise ValueError(f"date directive {token!r} is repeated in {fmt!r}")
            groups.append(name)
            tokens.append(("field", name))
            pattern += f"({DIRECTIVES[name]})"
        elif token.isspace():
            text(token)
            pattern += BLANKS
        else:
            text(token)
            pattern += re.sub(r"([\\.^$*+?(){}\[\]|])", r"\\\1", token)
    # Atomic: strptime takes the first way to match and only then looks whether
    # anything is left over; it never backtracks to use up the whole text.
    return DateFormat(fmt, rf"(?i)\A(?>{pattern})", tuple(tokens), tuple(groups))


class _Parsed:
    """Fields of one text column under one format."""

    def __init__(self, c: Column, fmt: DateFormat):
        self.c, self.fmt = c, fmt

    def raw(self, name: str) -> Column:
        return F.regexp_extract(self.c, self.fmt.pattern, self.fmt.groups.index(name) + 1)

    def padded(self, name: str) -> Column:
        return F.lpad(F.trim(self.raw(name)), 2, "0")

    def year(self) -> Column:
        if "Y" in self.fmt.groups:
            return self.raw("Y")
        if "y" in self.fmt.groups:
            short = self.raw("y")
            return F.when(short == "", "").otherwise(
                F.concat(F.when(short >= "69", F.lit("19")).otherwise(F.lit("20")), short)
            )
        return F.lit("1900")

    def month(self) -> Column:
        if "m" in self.fmt.groups:
            return self.padded("m")
        for name in ("b", "B"):
            if name in self.fmt.groups:
                at = F.instr(F.lit(MONTHS), F.lower(F.substring(self.raw(name), 1, 3)))
                return F.lpad(((at + F.lit(2)) / 3).cast("int").cast("string"), 2, "0")
        return F.lit("01")

    def day(self) -> Column:
        return self.padded("d") if "d" in self.fmt.groups else F.lit("01")

    def date(self) -> Column:
        """The date, or null when the text does not parse."""
        if "Y" in self.fmt.groups and set(self.fmt.groups) <= {"Y", "m", "d"}:
            return self._numeric_date()
        year = self.year()
        parsed = F.concat(year, F.lit("-"), self.month(), F.lit("-"), self.day()).try_cast("date")
        return F.when(self.c.rlike(self.fmt.pattern) & (year != "0000"), parsed)

    def _numeric_date(self) -> Column:
        """One replacement turns a match into ``year-month-day~rest``.  Any other
        text becomes ``--~``, as then all groups are empty."""

        def group(name: str) -> str:
            return f"${self.fmt.groups.index(name) + 1}" if name in self.fmt.groups else "01"

        rest = f"${len(self.fmt.groups) + 1}"
        either = rf"{self.fmt.prefix}((?s:.*))\z|\A(?s:.*)\z"
        iso = F.regexp_replace(self.c, either, f"{group('Y')}-{group('m')}-{group('d')}~{rest}")
        parsed = F.replace(F.substring_index(iso, "~", 1), F.lit(" "), F.lit("")).try_cast("date")
        used_up = F.instr(iso, "~") == F.char_length(iso)
        return F.when(used_up & ~F.startswith(iso, F.lit("0000")), parsed)

    def normalised(self) -> Column:
        """The text printed back, or unchanged where it does not parse."""
        parsed = self.date()
        if set(self.fmt.groups) <= set(PRINTED):
            pattern = ""
            for kind, token in self.fmt.tokens:
                pattern += PRINTED[token] if kind == "field" else "'" + token.replace("'", "''") + "'"
            return F.coalesce(F.date_format(parsed, pattern), self.c)
        return F.when(parsed.isNotNull(), self.rendered()).otherwise(self.c)

    def rendered(self) -> Column:
        parts = []
        for kind, token in self.fmt.tokens:
            if kind == "text":
                parts.append(F.lit(token))
            elif token == "b":
                parts.append(F.initcap(self.raw("b")))
            elif token == "B":
                parts.append(F.initcap(self.raw("B")))
            elif token == "Y":
                parts.append(self.raw("Y"))
            elif token == "f":
                parts.append(F.rpad(self.raw("f"), 6, "0"))
            else:
                parts.append(self.padded(token))
        return F.concat(*parts)


def to_lenient_date(c: Column, fmt: str) -> Column:
    """DateType value of ``c`` under a strptime format, null where it fails."""
    return _Parsed(c, parse_format(fmt)).date()


def normalise_date(c: Column, fmt: str) -> Column:
    """Text printed back in its own format (zero-padded); unchanged where it does
    not parse, so that validation can route the row later."""
    return _Parsed(c, parse_format(fmt)).normalised()


def date_struct(c: Column, date_format: str | None, python_date_format: str) -> Column:
    return F.struct(
        normalise_date(c, python_date_format).alias("value"),
        F.lit(date_format).cast("string").alias("format"),
        F.lit(python_date_format).alias("python_date_format"),
    )


def parses(value: Column, fmt: Column, formats: Sequence[str] = KNOWN_FORMATS) -> Column:
    """Does ``value`` parse under the format its own row names?

    ``formats`` are the formats known when the plan is built, each one compiled;
    any other is compiled from the row (``date_by_row``).
    """
    result = None
    for known in dict.fromkeys(formats):
        ok = to_lenient_date(value, known).isNotNull()
        result = F.when(fmt == known, ok) if result is None else result.when(fmt == known, ok)
    other = date_by_row(value, fmt).isNotNull()
    return result.otherwise(other) if result is not None else other


# Directives of row-named formats beyond those a plan-time format may have; they do not set the date.
LOOSE = {
    "a": "mon|tue|wed|thu|fri|sat|sun",
    "A": "monday|tuesday|wednesday|thursday|friday|saturday|sunday",
    "p": "am|pm",
    "I": r"1[0-2]|0[1-9]|[1-9]",
    "j": r"36[0-6]|3[0-5]\d|[1-2]\d\d|0[1-9]\d|00[1-9]|[1-9]\d|0[1-9]|[1-9]",
    "z": r"[+-]\d\d:?[0-5]\d(?::?[0-5]\d(?:\.\d{1,6})?)?|(?-i:Z)",
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def date_by_row(value: Column, fmt: Column) -> Column:
    """Date of ``value`` under the strptime format in ``fmt``; null where it does not parse or the format is none.

    The format is turned into a pattern with one named group per directive, text being quoted.  A directive that is
    unknown or repeated makes a bad format, which nothing parses under, as in Python.
    """
    known = {**DIRECTIVES, **LOOSE}
    # %% stands for itself; it is set aside so that what follows it is not read as a directive.
    plain = F.replace(fmt, F.lit("%%"), F.lit("\x00"))

    def pattern_of(plain: Column) -> Column:
        asked = F.regexp_extract_all(plain, F.lit("(?s)%(.?)"), F.lit(1))
        good = (F.size(F.array_distinct(asked)) == F.size(asked)) & F.forall(asked, lambda x: x.isin(*known))
        quoted = F.regexp_replace(plain, r"([\\.^$*+?(){}\[\]|])", r"\\$1")
        spaced = F.regexp_replace(quoted, BLANKS, F.lit(BLANKS.replace("\\", "\\\\")))
        choices = F.array(*(F.struct(F.lit(f"%{x}").alias("a"), F.lit(f"(?<{_GROUPS[x]}>{c})").alias("b")) for x, c in known.items()))
        named = F.aggregate(choices, spaced, lambda text, x: F.replace(text, x["a"], x["b"]))
        # Directives that are not there become empty groups, so that every name can be asked for.
        absent = F.array_join(F.transform(F.array_except(F.array(*map(F.lit, "YymbBd")), asked), lambda x: F.concat(F.lit("(?<g"), x, F.lit(">)"))), "")
        return F.when(good, F.concat(F.lit(r"(?i)\A(?>"), F.replace(named, F.lit("\x00"), F.lit("%")), F.lit(")"), absent, F.lit(r"\z")))

    def fields_of(pattern: Column) -> Column:
        printed = F.regexp_replace(value, pattern, F.lit("${gY}~${gy}~${gm}~${gb}${gB}~${gd}"))
        return F.when(F.rlike(value, pattern), F.split(printed, "~"))

    def date_of(parts: Column) -> Column:
        year, short, month, name, day = (F.get(parts, F.lit(i)) for i in range(5))
        named = F.lpad(((F.instr(F.lit(MONTHS), F.lower(F.substring(name, 1, 3))) + 2) / 3).cast("int").cast("string"), 2, "0")
        century = F.when(short >= "69", F.lit("19")).otherwise(F.lit("20"))
        text = F.concat_ws(
            "-",
            F.when(year != "", year).when(short != "", F.concat(century, short)).otherwise("1900"),
            F.when(month != "", F.lpad(month, 2, "0")).when(name != "", named).otherwise("01"),
            F.when(day != "", F.lpad(F.trim(day), 2, "0")).otherwise("01"),
        )
        return F.when(parts.isNotNull() & (year != "0000"), text.try_cast("date"))

    return let(plain, lambda p: let(pattern_of(p), lambda q: let(fields_of(q), date_of)))


# Group names, which are letters and digits only.
_GROUPS = {letter: f"g{letter}" for letter in (*DIRECTIVES, *LOOSE)}


# A zone offset as strptime's %z accepts it.
ZONE = r"(?:[+-]\d\d:?[0-5]\d(?::?[0-5]\d(?:\.\d{1,6})?)?|(?-i:Z))"
_CLOCK = rf"({DIRECTIVES['H']}):({DIRECTIVES['M']}):({DIRECTIVES['S']})"
TIMESTAMP_PATTERN = (
    rf"(?i)\A(\d\d\d\d)-({DIRECTIVES['m']})-({DIRECTIVES['d']})"
    rf"(?:T{_CLOCK}(?:\.\d{{1,6}}{ZONE}?|Z)?|{BLANKS}{_CLOCK})\z"
)


def normalise_timestamp(c: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` for ISO forms with or without fraction and zone,
    and for ``date time``.  The fraction is cut and an offset dropped without
    conversion; text of any other form stays as it is."""

    def part(i: int) -> Column:
        return F.lpad(F.trim(F.regexp_extract(c, TIMESTAMP_PATTERN, i)), 2, "0")

    def clock(i: int) -> Column:
        return F.concat(part(i), F.lit(":"), part(i + 1), F.lit(":"), part(i + 2))

    year = F.regexp_extract(c, TIMESTAMP_PATTERN, 1)
    day = F.concat(year, F.lit("-"), part(2), F.lit("-"), part(3))
    with_t = F.regexp_extract(c, TIMESTAMP_PATTERN, 4) != ""
    text = F.concat(day, F.lit("T"), F.when(with_t, clock(4)).otherwise(clock(7)), F.lit("Z"))
    ok = c.rlike(TIMESTAMP_PATTERN) & (year != "0000") & day.try_cast("date").isNotNull()
    return F.when(ok, text).otherwise(c)


ISO_SECONDS = "%Y-%m-%dT%H:%M:%S"


def iso_text(c: Column) -> Column:
    """A timestamp as ISO text in whole seconds."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def parse_iso(c: Column) -> Column:
    """Timestamp of ISO text in whole seconds, null where it does not parse."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss"))
