"""The 22-character row hash.

The hash is defined over the text Python prints for a tuple of strings:
SHA-256, URL-safe Base64, then every second character.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's repr() escapes: controls, format, surrogates, private use,
# unassigned, and all separators but the blank.
UNPRINTABLE = r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}]|[\p{Zs}&&[^ ]]"


def _escape_char(ch: Column) -> Column:
    code = F.ascii(ch)
    digits = F.lower(F.hex(code))
    return (
        F.when(~ch.rlike(UNPRINTABLE), ch)
        .when(code < 0x100, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
        .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
        .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
    )


def _escaped(text: Column) -> Column:
    """Line breaks and tabs by plain replacement; character by character only where
    something rarer is left."""
    common = text
    for char, code in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        common = F.replace(common, F.lit(char), F.lit(code))
    # Bound to a lambda variable, so the text is built once.
    rare = F.transform(
        F.array(common),
        lambda t: F.when(
            t.rlike(UNPRINTABLE), F.array_join(F.transform(F.split(t, ""), _escape_char), "")
        ).otherwise(t),
    )
    return F.get(rare, F.lit(0))


def _quoted(c: str) -> str:
    """SQL text of Python's quoting: single quotes, double ones if the value has
    a single quote and no double one."""
    body = rf"replace({c}, '\\', '\\\\')"
    return (
        f"CASE WHEN {c} IS NULL THEN 'None' "
        rf"WHEN NOT contains({c}, '\'') THEN concat('\'', {body}, '\'') "
        rf"""WHEN NOT contains({c}, '"') THEN concat('"', {body}, '"') """
        rf"ELSE concat('\'', replace({body}, '\'', '\\\''), '\'') END"
    )


def tuple_text(
    cols: Sequence[str], printable: Column | None = None, plain: Column | None = None
) -> Column:
    """Python's text of the tuple of ``cols``, column names or SQL expressions.

    Two boolean columns may spare work where they are true: ``printable`` rows
    hold only printable characters, so nothing but quotes and backslashes needs
    care; ``plain`` rows hold none of those either and no null, so one concat does.
    """
    end = ",)" if len(cols) == 1 else ")"
    joined = F.expr(f"concat('(', concat_ws(', ', {', '.join(_quoted(c) for c in cols)}), '{end}')")
    # Quotes and commas are printable, so escaping may run once over the whole text.
    odd = joined.rlike(UNPRINTABLE)
    if printable is not None:
        odd = ~printable & odd
    text = F.when(odd, _escaped(joined)).otherwise(joined)
    if plain is None:
        return text
    simple = F.expr(rf"concat('(\'', concat_ws('\', \'', {', '.join(cols)}), '\'{end}')")
    return F.when(plain, simple).otherwise(text)


def short_hash(text: Column) -> Column:
    digest = F.base64(F.unhex(F.sha2(text, 256)))
    return F.translate(F.regexp_replace(digest, "(.).", "$1"), "+/", "-_")


def row_hash(cols: Sequence[str], printable: Column | None = None, plain: Column | None = None) -> Column:
    return short_hash(tuple_text(cols, printable, plain))
