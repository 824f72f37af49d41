"""Row numbers, chunks and prefix samples over a whole frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.session import materialise

# Sizes of the tuning samples.
SAMPLE_SIZES = (1_000, 2_000, 5_000, 10_000, 20_000, 50_000, 100_000, 200_000, 500_000, 1_000_000)
CHUNK_ROWS = 2_500


def number_rows(df: DataFrame, order_by: Sequence[str], name: str = "row_index") -> DataFrame:
    """Adds a global 0-based row number in ``order_by`` order, or as the rows are stored if there is none.

    A window without partition keys would pull every row into one task.  Here the
    rows are range-sorted once and materialised; a row's number is its place in
    its own partition plus the rows of the partitions before it.  Ties are broken
    by a per-row id, so one hot key is still cut into several ranges.  The numbered rows
    are written to the scratch folder when this is called.
    """
    tie, part, place = "__tie", "__part", "__place"
    ordered = df.withColumn(tie, F.monotonically_increasing_id()).orderBy(*order_by, tie).drop(tie) if order_by else df
    # Sorted partitions keep their order when the id is taken; its upper bits are
    # the partition, its lower 33 bits the place inside it.
    row_id = F.monotonically_increasing_id()
    placed = ordered.withColumn(place, row_id)
    placed = placed.withColumn(part, F.shiftright(place, 33)).withColumn(
        place, F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    )
    fixed = materialise(placed, "numbered")
    counts = fixed.groupBy(part).agg(F.count("*").alias("n"))
    # One row per partition: at most some thousands.
    before = F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(part, F.coalesce(before, F.lit(0)).alias("offset"))
    return (
        fixed.join(F.broadcast(offsets), part)
        .withColumn(name, F.col("offset") + F.col(place))
        .drop(part, place, "offset")
    )


def with_chunk_index(
    df: DataFrame, size: int = CHUNK_ROWS, order_by: Sequence[str] = (), name: str = "chunk_index"
) -> DataFrame:
    """Adds the 0-based number of the ``size``-row chunk a row falls into."""
    if size < 1:
        raise ValueError("chunk size must be positive")
    numbered = number_rows(df, order_by, "__row")
    return numbered.withColumn(name, F.floor(F.col("__row") / size).cast("long")).drop("__row")


# Places an approximate percentile may be off by, as a share of all rows: one in its accuracy.
ACCURACY = 10_000


def _leading_rows(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows that are sure to hold the first ``n`` by ``column``: those up to a percentile that lies beyond them by twice
    the error it may have.  Text has no percentile; there all rows are kept.

    Percentiles are taken over doubles.  Values that a double may round (longs, decimals, timestamps) are compared as doubles
    too, where rounding keeps their order, so no row falls behind a cut that was rounded down.
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType)):
        return df
    value = F.col(column)
    if isinstance(kind, (T.LongType, T.DecimalType, T.TimestampType)):
        value = value.cast("double")
    total = F.count(column)
    share = df.agg(total.alias("n"), F.percentile_approx(value, [i / ACCURACY for i in range(0, ACCURACY + 1, 10)], ACCURACY).alias("cuts"))
    place = F.least(F.ceil((F.lit(float(n)) / F.col("n") + 2 / ACCURACY) * (ACCURACY / 10)), F.lit(ACCURACY // 10)).cast("int")
    # A scalar subquery, so that nothing runs while the plan is built; it is null only if the whole column is.
    cut = share.select(F.get("cuts", place)).scalar()
    return df.filter(F.col(column).isNull() | (value <= cut))


def head_samples(
    df: DataFrame, order_by: Sequence[str], sizes: Sequence[int] = SAMPLE_SIZES, keep_row: str | None = None
) -> dict[int, DataFrame]:
    """The first n rows for each size.  Rows are numbered once for all sizes, and
    only the rows that can be among the first are sorted.  ``keep_row`` names a column for their numbers."""
    if not sizes or min(sizes) < 1:
        raise ValueError("sample sizes must be positive")
    numbered = number_rows(_leading_rows(df, order_by[0], max(sizes)), order_by, "__row")
    heads = {n: numbered.filter(F.col("__row") < n) for n in sizes}
    return {n: head.withColumnRenamed("__row", keep_row) if keep_row else head.drop("__row") for n, head in heads.items()}


def sample_path(path: str, size: int) -> str:
    return path.replace(".csv", f"_{size}.csv")
