"""Object keys and table names derived from columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regloom.functions.dates import parse_iso
from regloom.functions.text import non_empty, stem

# Content types, their short names, and the folder names rules use.
CONTENT_TYPES = {
    "json": "application/json",
    "json_lines": "application/jsonlines",
    "csv": "text/csv",
    "parquet": "application/x-parquet",
}
RULE_FOLDERS = {"json": "json", "json_lines": "jsonlines", "csv": "csv", "parquet": "parquet"}

# Known jurisdictions.
JURISDICTIONS = ("us_fl", "im")


def content_type(name: str) -> str:
    """Short name of a content type given by name (any case) or MIME text."""
    lowered = name.lower()
    for short, mime in CONTENT_TYPES.items():
        if lowered in (short, mime):
            return short
    raise ValueError(f"{name} is not a valid content type")


def check_jurisdiction(code: str) -> str:
    if code not in JURISDICTIONS:
        raise ValueError(f"unknown jurisdiction {code!r}")
    return code


def known_jurisdiction(code: Column) -> Column:
    """Whether a column holds the code of a known jurisdiction, written as it is; false for null."""
    return F.coalesce(code.isin(*JURISDICTIONS), F.lit(False))


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def rules_key(jurisdiction, fmt, version=None) -> Column:
    """Key of a rule file; all arguments may be columns or constants."""
    code = F.lower(_col(jurisdiction))
    short = F.lower(_col(fmt))
    folder = F.when(short == "json_lines", F.lit("jsonlines")).otherwise(short)
    release = F.coalesce(non_empty(_col(version).cast("string")), F.lit("latest"))
    return F.concat(
        F.lit("cdm_mapping_rules/"), code, F.lit("/"), folder, F.lit("/"), release,
        F.lit("/cdm_mapping_"), code, F.lit(".json"),
    )


def layout_key(jurisdiction) -> Column:
    code = F.lower(_col(jurisdiction))
    return F.concat(F.lit("fixed_width_field_def/"), code, F.lit("/latest/"), code, F.lit(".json"))


def target_key(
    prefix, timestamp=None, file_key=None, fmt: str = "csv", index=None,
    add_file_name_as_prefix: bool = False, suffix=None, filename=None, now: Column | None = None,
) -> Column:
    """``prefix/Y/M/D/[stem/]stem[_index][_suffix].ext``, month and day not padded."""
    ts = _col(timestamp).cast("timestamp")
    ts = F.coalesce(ts, now if now is not None else F.current_timestamp())
    key_stem = F.coalesce(stem(non_empty(_col(file_key).cast("string"))), F.lit("anon"))
    given = F.substring_index(non_empty(_col(filename).cast("string")), ".", 1)
    number = _col(index).cast("long")
    tail = non_empty(_col(suffix).cast("string"))
    parts = [
        F.concat_ws(
            "/",
            _col(prefix),
            F.year(ts).cast("string"),
            F.month(ts).cast("string"),
            F.dayofmonth(ts).cast("string"),
            *([key_stem] if add_file_name_as_prefix else []),
            F.coalesce(given, key_stem),
        ),
        F.when(number >= 0, F.concat(F.lit("_"), number.cast("string"))).otherwise(F.lit("")),
        F.when(tail.isNotNull(), F.concat(F.lit("_"), tail)).otherwise(F.lit("")),
        F.lit("." + content_type(fmt)),
    ]
    return F.concat(*parts)


def as_timestamp(c: Column, kind: str) -> Column:
    """Timestamp of a file time kept as ``epoch`` seconds, ``iso`` text, ``timestamp``,
    or ``text`` that holds either of the first two."""
    if kind == "epoch":
        return F.timestamp_seconds(c)
    if kind == "iso":
        return parse_iso(c)
    if kind == "text":
        return F.coalesce(F.timestamp_seconds(c.try_cast("long")), parse_iso(c))
    return c


def raw_key(target_path, name, timestamp: Column, kind: str = "timestamp", now: Column | None = None) -> Column:
    """``target/YYYY/MM/DD/name``, padded.  A missing or zero time means now."""
    known = as_timestamp(timestamp, kind)
    if kind in ("epoch", "text"):
        known = F.when(~timestamp.cast("string").isin("0", ""), known)
    day = F.date_format(F.coalesce(known, now if now is not None else F.current_timestamp()), "yyyy/MM/dd")
    return F.concat(_col(target_path), F.lit("/"), day, F.lit("/"), _col(name))


def source_table(jurisdiction: str) -> str:
    return f"src_{jurisdiction}"


def staging_table(jurisdiction: str, valid: bool = True) -> str:
    return f"stg_{jurisdiction}" if valid else f"stg_{jurisdiction}_invalid"
