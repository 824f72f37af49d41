"""JSON encoding at the sink, column alignment, evolving append."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.operators.types import FLOATING, WHOLE, digits, fits, fitting_types, loses_digits, named, unfit_cells

NESTED = (T.StructType, T.ArrayType, T.MapType)


def encode_json(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nested columns as JSON text; scalars untouched.  Null members vanish."""
    names = set(columns) if columns is not None else set(df.columns)
    return df.select(
        *[
            F.to_json(F.col(f"`{f.name}`")).alias(f.name)
            if f.name in names and isinstance(f.dataType, NESTED)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed nulls for target columns the frame lacks; drops and casts nothing."""
    missing = [f for f in schema.fields if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


# Partition column of the load a row came with, and names made from a table's.
LOAD = "_load"
CELLS, NEXT = "{}_cells", "{}__next"


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _reads_as(old: T.DataType, new: T.DataType) -> bool:
    """Do Parquet files with the old type read right in a column of the new one?"""
    small = isinstance(old, WHOLE) and not isinstance(old, T.LongType)
    if isinstance(new, T.DecimalType) and isinstance(old, (*WHOLE, T.DecimalType)):
        before, after = digits(old)
        return digits(new)[0] >= before + isinstance(old, T.LongType) and digits(new)[1] >= after
    if isinstance(new, T.DoubleType):
        return small or isinstance(old, T.FloatType)
    return isinstance(old, WHOLE) and isinstance(new, WHOLE)


def settle_table(spark: SparkSession, table: str) -> None:
    """Finish or undo a widening that was interrupted."""
    made = NEXT.format(table)
    if spark.catalog.tableExists(made):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {made}")
        else:
            spark.sql(f"ALTER TABLE {made} RENAME TO {table}")


def widen_columns(spark: SparkSession, table: str, types: Mapping[str, T.DataType]) -> None:
    """Give columns of a table wider types.

    A table of Parquet files at a place of its own keeps its files where those read right in the new types, as whole numbers do in
    wider ones: only its entry in the catalog changes.  Any other is rewritten, an external one next to its old place, whose
    files stay.  The new table is made under another name and takes the old one's place at the end; ``settle_table``
    finishes or undoes that if it is interrupted.
    """
    details, parts, made = _details(spark, table), _partitions(spark, table), NEXT.format(table)
    old = spark.table(table).schema
    fields = [T.StructField(f.name, types.get(f.name, f.dataType)) for f in old.fields]
    external, fmt = details.get("Type") == "EXTERNAL", details.get("Provider", "parquet").lower()
    if external and fmt == "parquet" and all(_reads_as(old[n].dataType, k) for n, k in types.items()):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
        spark.sql(f"CREATE TABLE {made} ({columns}) USING parquet{by} LOCATION '{details['Location']}'")
        if parts:
            spark.sql(f"MSCK REPAIR TABLE {made}")
    else:
        writer = spark.table(table).select(*[named(f.name).cast(f.dataType).alias(f.name) for f in fields]).write.format(fmt)
        if parts:
            writer = writer.partitionBy(*parts)
        if external:
            writer = writer.option("path", f"{details['Location'].rstrip('/')}-{uuid.uuid4().hex}")
        writer.saveAsTable(made)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {made} RENAME TO {table}")


def _without_rounding(spark: SparkSession, df: DataFrame, have: Mapping, table: str | None, old: Mapping, types: dict) -> dict:
    """The types, but text where whole numbers or decimals in the table or frame would lose digits as doubles."""
    exact = (*WHOLE, T.DecimalType)

    def at_risk(kind: T.DataType) -> bool:
        return isinstance(kind, exact) and sum(digits(kind)) > 15

    doubles = [n for n, k in types.items() if isinstance(k, FLOATING)]
    frame = {have[n]: n for n in doubles if at_risk(df.schema[have[n]].dataType)}
    bad = {frame[n] for n in loses_digits(df, list(frame))}
    if table:
        bad |= set(loses_digits(spark.table(table), [n for n in doubles if at_risk(old[n])]))
    return {n: T.StringType() if n in bad else k for n, k in types.items()}


def _write(df: DataFrame, table: str, dynamic: bool) -> None:
    if not dynamic:
        df.write.insertInto(table)
        return
    # insertInto takes no options; the setting is put back whatever happens.
    spark, name = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(name, before)


def clear_partition(spark: SparkSession, table: str, column: str, value: str) -> None:
    """Leave a partition without rows, files included."""
    kept = [f for f in spark.table(table).schema.fields if f.name != column]
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in kept)
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (`{column}` = '{quoted}') SELECT {nothing} WHERE 1 = 0")


def append_evolving(
    df: DataFrame, table: str, path: str | None = None, schema: T.StructType | None = None,
    partition_by: Sequence[str] = (), fmt: str = "parquet", load: str | None = None,
) -> None:
    """Append to a table, creating it if absent (at ``path`` if given, with the types of ``schema`` for the columns it
    names).  Columns only the frame has are added to the table, columns only the table has are written as null; names
    are compared as the session does.

    Types may differ.  A column is widened until it holds what the table and the frame have (``fitting_types``, ``widen_columns``):
    whole numbers to wider ones, to decimals, to doubles, and to text where the frame's type is another.  Text that goes into a column of
    numbers, dates or truth values widens it as far as its values ask; a cell that fits none is written as null and goes to the table
    ``{table}_cells`` with its column, text and row.  No other value is ever changed.  The frame is read again for the types and for
    the cells if text meets another type, so it should come from files.

    With ``load``, rows carry that name in the partition column ``_load``, and appending a load again replaces what it
    had written.  In a table partitioned by other columns the partitions the frame holds are replaced.  Errors surface to the
    caller; nothing is marked done on failure.
    """
    spark = df.sparkSession
    exact_names = spark.conf.get("spark.sql.caseSensitive") == "true"

    def key(name: str) -> str:
        return name if exact_names else name.lower()

    encoded = encode_json(df)
    if load is not None:
        encoded, partition_by = encoded.withColumn(LOAD, F.lit(load)), [LOAD]
    settle_table(spark, table)
    exists = spark.catalog.tableExists(table)
    target = spark.table(table).schema if exists else schema or T.StructType()
    have = {key(f.name): f.name for f in encoded.schema.fields}
    old = {key(f.name): f.dataType for f in target.fields if key(f.name) in have}
    wanted = {have[n]: k for n, k in old.items() if encoded.schema[have[n]].dataType != k and have[n] not in partition_by}
    types = {key(n): k for n, k in fitting_types(encoded, wanted).items()}
    names = {key(f.name): f.name for f in target.fields}
    if exists:
        own = {names[n]: k for n, k in types.items()}
        source = {names[n]: have[n] for n in types}
        own = _without_rounding(spark, encoded, source, table, {names[n]: k for n, k in old.items()}, own)
        types = {key(n): k for n, k in own.items()}
        wider = {n: k for n, k in own.items() if k != target[n].dataType}
        if wider:
            widen_columns(spark, table, wider)
    new = [f for f in encoded.schema.fields if key(f.name) not in old] if exists else []
    if new:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")

    def fitted(source: str, kind: T.DataType):
        c = named(source)
        if encoded.schema[source].dataType == kind:
            return c
        if isinstance(encoded.schema[source].dataType, T.StringType):
            return F.when(fits(c, kind), c.try_cast(kind))
        return c.cast(kind)

    cells = unfit_cells(encoded.drop(*([LOAD] if load is not None else [])), {have[n]: k for n, k in types.items()})
    if not exists:
        typed = [fitted(f.name, types.get(key(f.name), f.dataType)).alias(f.name) for f in encoded.schema.fields]
        writer = encoded.select(*typed).write.format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        (writer if path is None else writer.option("path", path)).saveAsTable(table)
    else:
        parts = _partitions(spark, table)
        if partition_by and [key(p) for p in parts] != [key(p) for p in partition_by]:
            raise ValueError(f"{table} is partitioned by {parts}, not by {list(partition_by)}")
        aligned = [
            fitted(have[key(f.name)], f.dataType).alias(f.name) if key(f.name) in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spark.table(table).schema.fields
        ]
        if load is not None and encoded.isEmpty():
            clear_partition(spark, table, LOAD, load)
        else:
            _write(encoded.select(*aligned), table, bool(partition_by))
    _append_cells(spark, cells, table, types, encoded, have, load)


def _append_cells(spark, cells: DataFrame, table: str, types: Mapping, encoded: DataFrame, have: Mapping, load: str | None) -> None:
    """Cells that fit nothing, in a table of their own; a repeated load replaces its cells."""
    texts = [n for n, k in types.items() if isinstance(encoded.schema[have[n]].dataType, T.StringType) and not isinstance(k, T.StringType)]
    kept = CELLS.format(table)
    if not texts:
        if load is not None and spark.catalog.tableExists(kept):
            clear_partition(spark, kept, LOAD, load)
        return
    if not spark.catalog.tableExists(kept) and cells.isEmpty():
        return
    marked = cells.withColumn(LOAD, F.lit(load or ""))
    if not spark.catalog.tableExists(kept):
        marked.write.format("parquet").partitionBy(LOAD).saveAsTable(kept)
    elif load is None:
        marked.write.insertInto(kept)
    elif cells.isEmpty():
        clear_partition(spark, kept, LOAD, load)
    else:
        _write(marked, kept, dynamic=True)


def append_quarantine(invalid: DataFrame, table: str, load: str | None = None) -> bool:
    """Append rejected rows, if there are any."""
    if invalid.isEmpty():
        return False
    append_evolving(invalid, table, load=load)
    return True
