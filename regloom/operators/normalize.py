"""Relational tables from company records: a base table and child tables.

Works on mapped rows (nested columns) and on rows read back from a lake table
(JSON text) alike.  Every table is a narrow projection or ``explode``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.functions.dates import KNOWN_FORMATS, date_by_row, let, to_lenient_date
from regloom.functions.text import non_empty
from regloom.session import materialise

OFFICER = ("name", "position", "street_address", "city", "state", "zip5", "zip4")
ADDRESS = ("street_address_1", "street_address_2", "locality", "region", "zip5", "zip4")
ATTRIBUTES = (
    "jurisdiction_of_origin",
    "registry_type",
    "presence_of_charges",
    "is_in_liquidation",
    "receivers_appointed",
    "documents",
    "liquidator",
    "receiver",
)


def join_street(line_1: Column, line_2: Column) -> Column:
    """Both address lines with ", "; null when both are empty."""
    return non_empty(F.concat_ws(", ", non_empty(line_1), non_empty(line_2)))


def join_zip(zip5: Column, zip4: Column) -> Column:
    return non_empty(F.concat_ws("-", non_empty(zip5), non_empty(zip4)))


def _kind(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _member(holder: Column, kind: T.StructType, name: str) -> Column:
    return holder.getField(name).cast("string") if name in kind.names else F.lit(None).cast("string")


def _record(holder: Column, kind: T.StructType, names: Sequence[str]) -> Column:
    return F.struct(*[_member(holder, kind, n).alias(n) for n in names])


def _text_schema(names: Sequence[str]) -> str:
    return "struct<" + ",".join(f"`{n}`:string" for n in names) + ">"


def grouped_records(df: DataFrame, name: str, names: Sequence[str]) -> Column:
    """Array of ``(label, attributes…)`` of a grouped column."""
    c, kind = F.col(name), _kind(df, name)
    if isinstance(kind, T.StructType):
        groups = [f for f in kind.fields if isinstance(f.dataType, T.StructType)]
        packed = [
            F.when(
                c.getField(f.name).isNotNull(),
                F.struct(
                    F.lit(f.name).alias("label"),
                    *[_member(c.getField(f.name), f.dataType, n).alias(n) for n in names],
                ),
            )
            for f in groups
        ]
        return F.array_compact(F.array(*packed)) if packed else _no_records(names)
    if isinstance(kind, T.StringType):
        entries = F.map_entries(F.from_json(c, f"map<string,{_text_schema(names)}>"))
        return F.transform(
            entries,
            lambda e: F.struct(e.getField("key").alias("label"), *[e.getField("value").getField(n).alias(n) for n in names]),
        )
    return _no_records(names)


def _records(names: Sequence[str]) -> str:
    return f"array<{_text_schema(('label', *names))}>"


def _no_records(names: Sequence[str]) -> Column:
    return F.lit(None).cast(_records(names))


def listed_records(df: DataFrame, name: str, names: Sequence[str]) -> Column:
    """Array of attribute records of a list column."""
    c, kind = F.col(name), _kind(df, name)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return F.transform(c, lambda e: _record(e, kind.elementType, names))
    if isinstance(kind, T.StringType):
        listed = F.when(F.startswith(F.ltrim(c), F.lit("[")), c)
        return F.from_json(listed, f"array<{_text_schema(names)}>")
    return F.lit(None).cast(f"array<{_text_schema(names)}>")


def attribute_record(df: DataFrame, name: str, names: Sequence[str]) -> Column:
    """One attribute record of a plain nested column."""
    c, kind = F.col(name), _kind(df, name)
    if isinstance(kind, T.StructType):
        return _record(c, kind, names)
    return F.from_json(c.cast("string"), _text_schema(names))


def first_date(df: DataFrame, name: str, formats: Sequence[str] = KNOWN_FORMATS) -> Column:
    """Date of the first written entry of a date column; null where it has none
    or the text does not parse."""
    c, kind = F.col(name), _kind(df, name)
    if isinstance(kind, T.StructType):
        dated = [f.name for f in kind.fields if isinstance(f.dataType, T.StructType) and "value" in f.dataType.names]
        if not dated:
            return F.lit(None).cast("date")
        entry = F.coalesce(*[c.getField(n) for n in dated])
    else:
        parsed = F.from_json(c.cast("string"), "map<string,struct<value:string,python_date_format:string>>")
        entry = F.get(F.map_values(parsed), F.lit(0))

    def date_of(entry: Column) -> Column:
        value, fmt = entry.getField("value"), entry.getField("python_date_format")
        found = F.when(F.lit(False), F.lit(None).cast("date"))
        for known in formats:
            found = found.when(fmt == known, to_lenient_date(value, known))
        return found.otherwise(date_by_row(value, fmt))

    return let(entry, date_of)


def _one_row_each(df: DataFrame, records: Column, alias: str) -> DataFrame:
    """``explode`` that infers no filter.  An inferred "array is not empty" would be
    pushed below the mapping, which copies the whole record expression into the
    filter once per attribute."""
    exploded = df.select("company_number", F.explode_outer(records).alias(alias))
    return exploded.filter(F.col(alias).isNotNull())


def company_table(df: DataFrame, formats: Sequence[str] = KNOWN_FORMATS) -> DataFrame:
    address, kind = F.col("registered_address"), _kind(df, "registered_address")
    if isinstance(kind, T.StructType):
        address = F.coalesce(*[address.getField(n).cast("string") for n in kind.names])
    return df.select(
        "company_number",
        "name",
        "jurisdiction_code",
        "current_status",
        "company_type",
        first_date(df, "incorporation_date", formats).alias("incorporation_date"),
        first_date(df, "dissolution_date", formats).alias("dissolution_date"),
        "registry_url",
        address.alias("registered_address"),
        F.col("fetched_at").try_cast("timestamp").alias("retrieved_at"),
    )


def officer_rows(df: DataFrame) -> DataFrame:
    """One row per officer, from groups (``officers.1``) or a list of agents."""
    agents = F.transform(
        listed_records(df, "officers", ("Agent", "Address")),
        lambda a: F.struct(
            F.lit(None).cast("string").alias("label"),
            a.getField("Agent").alias("name"),
            F.lit(None).cast("string").alias("position"),
            a.getField("Address").alias("street_address"),
            *[F.lit(None).cast("string").alias(n) for n in OFFICER[3:]],
        ),
    )
    groups = grouped_records(df, "officers", OFFICER)
    exploded = _one_row_each(df, F.coalesce(groups, agents), "o")
    return exploded.select("company_number", "o.*")


def officer_table(df: DataFrame) -> DataFrame:
    return officer_rows(df).select("company_number", "name", "position")


def officer_address_table(df: DataFrame) -> DataFrame:
    rows = officer_rows(df).select(
        "company_number",
        F.col("name").alias("officer_name"),
        "street_address",
        F.col("city").alias("locality"),
        F.col("state").alias("region"),
        join_zip(F.col("zip5"), F.col("zip4")).alias("postal_code"),
    )
    return rows.filter(F.coalesce("street_address", "locality", "region", "postal_code").isNotNull())


def address_tables(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The addresses of several columns as rows, with the column's name as ``source``: one pass over the records."""

    def tagged(name: str) -> Column:
        found = F.coalesce(grouped_records(df, name, ADDRESS), F.array().cast(_records(ADDRESS)))
        return F.transform(found, lambda a: F.struct(F.lit(name).alias("source"), a.alias("a")))

    exploded = _one_row_each(df, F.concat(*map(tagged, names)), "s")
    return exploded.select(
        "company_number",
        F.col("s.source").alias("source"),
        join_street(F.col("s.a.street_address_1"), F.col("s.a.street_address_2")).alias("street_address"),
        F.col("s.a.locality").alias("locality"),
        F.col("s.a.region").alias("region"),
        join_zip(F.col("s.a.zip5"), F.col("s.a.zip4")).alias("postal_code"),
    )


def address_table(df: DataFrame, name: str) -> DataFrame:
    """``mailing_address`` or ``headquarters_address`` as rows."""
    return address_tables(df, [name]).drop("source")


def identifier_table(df: DataFrame) -> DataFrame:
    uid = attribute_record(df, "company_identifiers", ("uid",)).getField("uid")
    code = attribute_record(df, "all_attributes", ("identifier_system_code",)).getField("identifier_system_code")
    record = F.struct(code.alias("identifier_system_code"), uid.alias("uid"))
    rows = _one_row_each(df, F.when(uid.isNotNull(), F.array(record)), "i")
    return rows.select("company_number", "i.*")


def attribute_table(df: DataFrame) -> DataFrame:
    record = attribute_record(df, "all_attributes", ATTRIBUTES)
    present = F.when(F.col("all_attributes").isNotNull(), F.array(record))
    rows = _one_row_each(df, present, "r")
    return rows.select(
        "company_number",
        *[F.col(f"r.{n}").alias("receiver_appointed" if n == "receivers_appointed" else n) for n in ATTRIBUTES],
    )


def previous_name_table(df: DataFrame) -> DataFrame:
    listed = listed_records(df, "previous_names", ("Name", "Status"))
    exploded = _one_row_each(df, listed, "p")
    return exploded.select("company_number", F.col("p.Name").alias("previous_name"), F.col("p.Status").alias("status"))


def normalize_company(df: DataFrame, formats: Sequence[str] = KNOWN_FORMATS) -> dict[str, DataFrame]:
    """All tables by name.  The records are written to the scratch folder when this is called, so they are parsed and
    mapped once and each table reads only the columns it is made of."""
    df = materialise(df, "records")
    return {
        "company": company_table(df, formats),
        "officer": officer_table(df),
        "officer_address": officer_address_table(df),
        "mailing_address": address_table(df, "mailing_address"),
        "headquarters_address": address_table(df, "headquarters_address"),
        "company_identifier": identifier_table(df),
        "all_attributes": attribute_table(df),
        "previous_names": previous_name_table(df),
    }


# The columns and the company type of the shared view.
SHARED_COLUMNS = ("company_number", "name", "jurisdiction_code", "current_status", "company_type", "incorporation_date")


def share_view(df: DataFrame, company_type: str = "FLAL", columns: Sequence[str] = SHARED_COLUMNS) -> DataFrame:
    """The rows and columns another account may see."""
    return df.filter(F.col("company_type") == company_type).select(*columns)
