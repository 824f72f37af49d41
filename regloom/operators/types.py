"""Types that hold the values of two loads, and the cells that fit none."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)
DAYS = (T.DateType, T.TimestampType, T.TimestampNTZType)
MOST_DIGITS = 38
EXACT_DIGITS = 15  # decimal digits every double keeps
PLAIN = r"^[+-]?([0-9]*)[.]?([0-9]*)$"


def named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def digits(kind: T.DataType) -> tuple[int, int]:
    """Digits before and after the point that a whole or decimal type has room for."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}[type(kind)], 0


def promoted(a: T.DataType, b: T.DataType) -> T.DataType:
    """Where two types meet: whole numbers, then decimals, then doubles, then text.  Dates meet timestamps; all else is text."""
    if a == b:
        return a
    if isinstance(a, WHOLE) and isinstance(b, WHOLE):
        return max(a, b, key=digits)
    exact = (*WHOLE, T.DecimalType)
    if isinstance(a, exact) and isinstance(b, exact):
        before, after = (max(pair) for pair in zip(digits(a), digits(b), strict=True))
        return T.DecimalType(before + after, after) if before + after <= MOST_DIGITS else T.StringType()
    if isinstance(a, (*exact, *FLOATING)) and isinstance(b, (*exact, *FLOATING)):
        return T.DoubleType()
    if isinstance(a, DAYS) and isinstance(b, DAYS) and T.DateType() in (a, b):
        return b if a == T.DateType() else a
    return T.StringType()


def fits(c: Column, kind: T.DataType) -> Column:
    """Does a text have a value in a type that says all the text says?  Null fits every type."""
    ok = c.try_cast(kind).isNotNull()
    bare = F.btrim(c)
    if isinstance(kind, T.DecimalType):
        # Written plainly, and no digit after the point beyond the scale.
        after = F.char_length(F.rtrim(F.regexp_extract(bare, PLAIN, 2), F.lit("0")))
        ok = ok & bare.rlike(PLAIN) & (after <= kind.scale)
    elif isinstance(kind, FLOATING):
        mantissa = F.regexp_replace(F.regexp_replace(F.lower(bare), "e.*$", ""), "[^0-9]", "")
        ok = ok & (F.char_length(F.regexp_replace(mantissa, "^0+", "")) <= EXACT_DIGITS)
    elif isinstance(kind, T.DateType):
        ok = ok & ~F.contains(c, F.lit(":"))  # a time of day is more than a date
    return c.isNull() | F.coalesce(ok, F.lit(False))


def _text_types(df: DataFrame, texts: Mapping[str, T.DataType]) -> dict[str, T.DataType]:
    """For text columns that go into columns of other types: the narrowest type, from the column's on, that takes most values.

    One pass over those columns counts the values that fit each type, and the digits of those written as plain numbers.
    """
    options: dict[str, list[T.DataType]] = {}
    asked: list[Column] = []
    for name, kind in texts.items():
        c, bare = named(name), F.btrim(named(name))
        wider = []
        if isinstance(kind, WHOLE):
            wider = [k for k in (T.IntegerType(), T.LongType()) if digits(k) > digits(kind)]
        elif isinstance(kind, T.DateType):
            wider = [T.TimestampType()]
        elif isinstance(kind, T.FloatType):
            kind = T.DoubleType()
        options[name] = [kind, *wider]
        asked += [F.count_if(fits(c, k)) for k in options[name]]
        plain = bare.rlike(PLAIN) & bare.rlike("[0-9]")
        before = F.char_length(F.regexp_replace(F.regexp_extract(bare, PLAIN, 1), "^0+", ""))
        after = F.char_length(F.rtrim(F.regexp_extract(bare, PLAIN, 2), F.lit("0")))
        asked += [F.count_if(c.isNull() | plain), F.max(F.when(plain, before)), F.max(F.when(plain, after)), F.count_if(fits(c, T.DoubleType()))]
    counted = iter(df.agg(*[c.alias(str(i)) for i, c in enumerate(asked)]).first())
    found = {}
    for name, kinds in options.items():
        counts = [(next(counted), k) for k in kinds]
        plain, before, after, doubles = (next(counted) for _ in range(4))
        if isinstance(kinds[0], (*WHOLE, T.DecimalType)):
            held = digits(kinds[-1])
            scale = max(held[1], after or 0)
            if max(held[0], before or 0) + scale <= MOST_DIGITS:
                counts.append((plain, T.DecimalType(MOST_DIGITS, scale)))
            if sum(digits(kinds[0])) <= EXACT_DIGITS:  # what the column holds stays exact
                counts.append((doubles, T.DoubleType()))
        most = max(n for n, _ in counts)
        found[name] = next(k for n, k in counts if n == most)
    return found


def fitting_types(df: DataFrame, wanted: Mapping[str, T.DataType]) -> dict[str, T.DataType]:
    """For columns of ``df`` and the types of the columns they are to go into, the types that hold both.

    Declared types meet by ``promoted``.  For text that goes into another type, its values decide; those that fit
    no type are cells for quarantine.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = {n: k for n, k in wanted.items() if isinstance(kinds[n], T.StringType) and not isinstance(k, T.StringType)}
    found = {n: promoted(k, kinds[n]) for n, k in wanted.items() if n not in texts}
    return found | (_text_types(df, texts) if texts else {})


def loses_digits(df: DataFrame, names: list[str]) -> list[str]:
    """Those of some whole or decimal columns with a value that a double would change."""
    if not names:
        return []
    changed = [F.count_if(named(n) != named(n).cast("double").cast(df.schema[n].dataType)).alias(str(i)) for i, n in enumerate(names)]
    return [n for n, k in zip(names, df.agg(*changed).first(), strict=True) if k]


def unfit_cells(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """``(column, type, text, row)``: the text cells that fit their column's type not, each with its row as JSON."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = {n: k for n, k in types.items() if isinstance(kinds[n], T.StringType) and not isinstance(k, T.StringType)}
    cells = [
        F.when(~fits(named(n), k), F.struct(F.lit(n).alias("column"), F.lit(k.simpleString()).alias("type"), named(n).alias("text")))
        for n, k in texts.items()
    ]
    none = F.array().cast("array<struct<column:string,type:string,text:string>>")
    bad = F.array_compact(F.array(*cells)) if cells else none
    rows = df.select(bad.alias("cells"), F.to_json(F.struct("*")).alias("row")).where(F.size("cells") > 0)
    return rows.select(F.explode("cells").alias("c"), "row").select("c.*", "row")
