"""CSV files cut into blocks, though their cells may hold line breaks.

A reader that meets line breaks in cells has to know whether a line starts inside a cell, and so reads a file from its
start, in one task.  Here the text reader cuts files into blocks as it does with any text, and each block is read under both
assumptions: that its first line starts outside a cell, and that it starts inside one.  A line turns either state into a state, so a
block as a whole is a map from two states to two states.  Maps are composed along each file (a window over one row a
block), which tells the state every block really starts in and where the record it may start within began.  Lines that are
whole records stay where they are, and the lines of a record with breaks are joined where they follow each other; only records
that go on in another block, or batch of lines, are brought together by a shuffle: two a batch at most.

The cells of a record are told apart by Spark's own parser.  Files are scanned once: the blocks with both readings are written to the
scratch folder, as are the joined records, and the first records, which name the columns, are taken from there.

Cells are quoted as by most tools: a cell that starts with a quote ends at the next quote that is not doubled.  A quote
elsewhere is text.  Lines end with a line feed, or carriage return and line feed.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.session import materialise

MARKED = (
    "path string, block long, place long, value string, in0 boolean, in1 boolean, after0 boolean, after1 boolean,"
    " start0 long, start1 long, head boolean"
)


def open_cell(sep: str, quote: str) -> re.Pattern:
    """Matches a line, started outside a cell, that ends within a quoted one.  Runs once over a line, without backtracking."""
    s, q = re.escape(sep), re.escape(quote)
    inside = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
    cell = f"(?:{q}{inside}{q}[^{s}]*+|[^{q}{s}][^{s}]*+|)"
    return re.compile(rf"(?:{cell}{s})*+{q}{inside}\Z", re.DOTALL)


def mark_lines(lines: DataFrame, sep: str, quote: str) -> DataFrame:
    """Lines ``(path, f, block, value)``, in the order their scan has them, with what either assumption makes of them:

    whether a line starts (``in``) and ends (``after``) inside a cell, and the place of the line that started its record, -1 if
    that is in an earlier block.  ``head`` marks the first line of a file that is not empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opens, known = open_cell(sep, quote), None
        for batch in batches:
            f, block = batch["f"].to_numpy(), batch["block"].to_numpy()
            new = np.flatnonzero(np.concatenate([[True], (f[1:] != f[:-1]) | (block[1:] != block[:-1])])) if len(f) else []
            for start, end in zip(new, [*new[1:], len(f)], strict=True):
                if (f[start], block[start]) != known:
                    known, place, states, last, headless = (f[start], block[start]), 0, [False, True], [-1, -1], block[start] == 0
                part, n = batch.slice(start, end - start), int(end - start)
                quoted = np.flatnonzero(pc.match_substring(part["value"], quote).to_numpy(zero_copy_only=False))
                before = np.empty((2, n + 1), bool)
                at = 0
                for i in quoted.tolist():
                    line = part["value"][i].as_py()
                    before[:, at : i + 1] = np.array(states)[:, None]
                    ends = [opens.match(line) is not None, opens.match(quote + line) is not None]
                    states = [ends[int(s)] for s in states]
                    at = i + 1
                before[:, at:] = np.array(states)[:, None]
                places = np.arange(place, place + n)
                starts = [np.maximum(np.maximum.accumulate(np.where(before[h, :-1], -1, places)), last[h]) for h in (0, 1)]
                last = [int(s[-1]) for s in starts]
                head = np.zeros(n, bool)
                if headless:
                    filled = np.flatnonzero(~np.isin(np.asarray(part["value"]), ["", "\r", "\ufeff"]))
                    if len(filled):
                        head[filled[0]], headless = True, False
                place += n
                arrays = [
                    part["path"], part["block"], pa.array(places), part["value"], *(pa.array(before[h, :-1]) for h in (0, 1)),
                    *(pa.array(before[h, 1:]) for h in (0, 1)), *(pa.array(s) for s in starts), pa.array(head),
                ]
                names = ["path", "block", "place", "value", "in0", "in1", "after0", "after1", "start0", "start1", "head"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return lines.select("path", "f", "block", "value").mapInArrow(run, MARKED)


def block_states(marked: DataFrame) -> DataFrame:
    """``(path, block, inside, carried)``: whether a block starts inside a cell, and the block and place of the last record
    that started before it."""
    ends = [F.max_by(f"after{h}", "place").alias(f"a{h}") for h in (0, 1)]
    blocks = marked.groupBy("path", "block").agg(*ends, *[F.max(f"start{h}").alias(f"l{h}") for h in (0, 1)])
    along = Window.partitionBy("path").orderBy("block")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    # A block swaps the states, keeps them, or ends in the same one from either: then that and the swaps since count.
    swaps = blocks.withColumn("swaps", F.sum(F.when(F.expr("a0 AND NOT a1"), 1).otherwise(0)).over(so_far))
    fixed = F.when(F.expr("a0 = a1"), F.struct("a0", "swaps"))
    ended = swaps.withColumn("fixed", F.last(fixed, ignorenulls=True).over(so_far)).withColumn(
        "ends", F.expr("CASE WHEN fixed IS NULL THEN swaps % 2 = 1 ELSE fixed.a0 <> ((swaps - fixed.swaps) % 2 = 1) END")
    )
    known = ended.withColumn("inside", F.coalesce(F.lag("ends").over(along), F.lit(False)))
    own = F.expr("CASE WHEN inside THEN l1 ELSE l0 END")
    started = F.when(own >= 0, F.struct(F.col("block").alias("block"), own.alias("place")))
    return known.select("path", "block", "inside", F.last(started, ignorenulls=True).over(earlier).alias("carried"))


JOINED = "path string, of_block long, of_place long, block long, place long, head boolean, record string, whole boolean"


def join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a record that follow each other, as one row: the record (``whole``), or a piece of it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch["path"].dictionary_encode().indices.to_numpy(), *(pc.fill_null(batch[c], -1).to_numpy() for c in ("of_block", "of_place", "block"))])
        place = batch["place"].to_numpy()
        first = np.flatnonzero(np.concatenate([[True], (at[:, 1:] != at[:, :-1]).any(axis=0) | (place[1:] != place[:-1] + 1)]))
        end = np.append(first[1:], len(place))
        starts_in, ends_in, head = (batch[c].to_numpy(zero_copy_only=False) for c in ("starts_in", "ends_in", "head"))
        lines = pa.ListArray.from_arrays(pa.array(np.append(first, len(place)), pa.int32()), batch["value"])
        kept = batch.select(["path", "of_block", "of_place", "block", "place"]).take(pa.array(first))
        more = [pa.array(np.logical_or.reduceat(head, first)), pc.binary_join(lines, "\n"), pa.array(~starts_in[first] & ~ends_in[end - 1])]
        yield pa.RecordBatch.from_arrays([*kept.columns, *more], [*kept.schema.names, "head", "record", "whole"])


def records_of(marked: DataFrame) -> DataFrame:
    """``(path, head, record)``: the records of marked lines."""
    # Written first: a row a block, whose size is known when the join is planned, so that lines need not move.
    placed = marked.join(materialise(block_states(marked), "csv-states"), ["path", "block"])
    read = placed.selectExpr(
        "path", "block", "place", "value", "head", "carried",
        "CASE WHEN inside THEN in1 ELSE in0 END AS starts_in", "CASE WHEN inside THEN after1 ELSE after0 END AS ends_in",
        "CASE WHEN inside THEN start1 ELSE start0 END AS start",
    )
    single = read.where("NOT starts_in AND NOT ends_in").select("path", "head", F.col("value").alias("record"))
    broken = read.where("starts_in OR ends_in").selectExpr(
        "path", "head", "block", "place", "value", "starts_in", "ends_in", "CASE WHEN start >= 0 THEN block ELSE carried.block END AS of_block",
        "CASE WHEN start >= 0 THEN start ELSE carried.place END AS of_place",
    )
    joined = materialise(broken.mapInArrow(join_lines, JOINED), "csv-joined")
    pieces = F.sort_array(F.collect_list(F.struct("block", "place", "record")))
    across = joined.where("NOT whole").groupBy("path", "of_block", "of_place").agg(F.bool_or("head").alias("head"), pieces.alias("pieces"))
    across = across.select("path", "head", F.array_join("pieces.record", "\n").alias("record"))
    found = single.unionByName(joined.where("whole").select("path", "head", "record")).unionByName(across)
    ended = F.when(F.endswith("record", F.lit("\r")), F.left("record", F.char_length("record") - 1)).otherwise(F.col("record"))
    bare = F.when(F.col("head"), F.ltrim(ended, F.lit("\ufeff"))).otherwise(ended)
    return found.select("path", "head", bare.alias("record")).where("record <> ''")


def csv_records(spark: SparkSession, paths: Sequence[str], sep: str, quote: str, options: dict) -> DataFrame:
    """``(path, head, record)`` of CSV files, each scanned once when this is called."""
    lines = spark.read.options(**options).option("lineSep", "\n").text(list(paths))
    meta = F.col("_metadata")
    scanned = lines.select(
        meta["file_path"].alias("path"), F.xxhash64(meta["file_path"]).alias("f"), meta["file_block_start"].alias("block"), "value"
    )
    return records_of(materialise(mark_lines(scanned, sep, quote), "csv-lines"))


def cells(record: str, sep: str, quote: str) -> tuple[str, ...]:
    return tuple(next(csv.reader(io.StringIO(record, newline=""), delimiter=sep, quotechar=quote), ()))


def read_csv_records(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | None, options: dict, path_column: str | None = None
) -> DataFrame:
    """CSV rows as text, columns matched by name, file by file; a column a file lacks is null."""
    sep, quote = options.get("sep", ","), options["quote"]
    listing = {k: v for k, v in options.items() if k in ("recursiveFileLookup", "pathGlobFilter", "modifiedBefore", "modifiedAfter")}
    parsing = {k: v for k, v in options.items() if k not in listing and k != "header"} | {"multiLine": "true"}
    records = csv_records(spark, paths, sep, quote, listing)
    heads = records.where("head").select("path", F.col("record").alias("header"))
    # As many rows as there are different headers.
    if options["header"] == "true":
        found = {r["header"]: cells(r["header"], sep, quote) for r in heads.select("header").distinct().orderBy("header").collect()}
        rows = records.where("NOT head")
    else:
        first = heads.select(F.min("header").alias("header")).first()["header"]
        n = len(schema.fields) if schema is not None else len(cells(first or "", sep, quote))
        found, rows = {"": tuple(schema.names if schema is not None else (f"_c{i}" for i in range(n)))}, records
    names = list(dict.fromkeys(n for header in found.values() for n in header))

    def parsed(header: tuple[str, ...]) -> Column:
        kind = ", ".join(f"c{i} STRING" for i in range(len(header)))
        row = F.from_csv("record", kind, parsing)
        at = {n: i for i, n in reversed(list(enumerate(header)))}
        return F.struct(*[(row[f"c{at[n]}"] if n in at else F.lit(None).cast("string")).alias(f"v{i}") for i, n in enumerate(names)])

    if not found or not names:
        nothing = T.StructType([T.StructField(n, T.StringType()) for n in (schema.names if schema is not None else [])])
        table = spark.createDataFrame([], nothing).withColumn("__path", F.lit(None).cast("string"))
    else:
        if len(found) == 1:
            values = parsed(next(iter(found.values())))
        else:
            rows = rows.join(heads, "path")
            branches = [(F.col("header") == F.lit(h), parsed(header)) for h, header in found.items()]
            values = F.when(*branches[0])
            for branch in branches[1:]:
                values = values.when(*branch)
        table = rows.select(F.col("path").alias("__path"), values.alias("v"))
        table = table.select(*[F.col(f"v.v{i}").alias(n) for i, n in enumerate(names)], "__path")
    kept = [] if path_column is None else [F.col("__path").alias(path_column)]
    if schema is None:
        return table.select(*[F.col("`" + n.replace("`", "``") + "`") for n in table.columns if n != "__path"], *kept)
    out = []
    for f in schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`") if f.name in table.columns else F.lit(None)
        out.append(c.cast(f.dataType).alias(f.name))
    return table.select(*out, *kept)
