"""Audit of how the sources of a language differ in the words they use, from count-level bitmaps.

Terms are runs of letters (ASCII letters lower-cased, other characters as they are).  A language keeps the terms that
enough of its documents hold.  For each group (a language and source) the terms with the same count are one bitmap: a
bit for each term, 64 terms a block, terms in order of frequency, so that terms of similar counts share blocks.

For two groups, the bitmaps of counts i and j of a block are joined by AND; its population count is the number of terms
with count i here and j there, the joint cell (i, j), and each cell is multiplied by the one difference
f = abs(p(i) - q(j)) all its terms have.  Cells with a zero are not stored.  They follow by complement: with ``n(i)`` terms of
count i in the first group, cell (i, 0) is n(i) less the joint cells (i, j) of all j, likewise (0, j), and (0, 0) is what is left
of the vocabulary.  So the sum over all terms is a sum over joint cells of f(i, j) - f(i, 0) - f(0, j) + f(0, 0), plus n(i) f(i, 0),
n(j) f(0, j) and the rest times f(0, 0).

Shares are integers (``scale`` times the smoothed share, rounded down, plus one) from decimal division, so all sums are exact.
Terms are counted in tasks before the shuffle.  Joins are on (language, block) or on the language, with a group's numbers of
one row; a block holds at most 64 levels of a group.  The number of pairs is the square of the sources of a language, as is the result.

Defined cases: null text, language and source are empty; rows with the same id are documents of their own; a group without kept
terms takes part with the share of a term it lacks; a language that keeps no term has pairs of value 0 and no terms; a
language with one source has no pairs; very long texts are counted piece by piece; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regloom.llm.common import utf8
from regloom.operators.rows import number_rows
from regloom.session import materialise

HELD = 400_000  # counts a task holds before it sends them on
DOCUMENT = 1 << 40  # what a document adds to a term's number; its occurrences are below
PIECE = 1 << 22  # bytes of a text that are counted at a time
BITS = 64
COUNTS = "lang string, source string, term string, n long, docs long"

# Letters stay, A-Z lower-cased; all other ASCII characters part terms.  Bytes of other characters stay.
_FOLD = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms_of(text: bytes) -> Counter[bytes]:
    """How often a text holds each term."""
    folded, found, at = text.translate(_FOLD), Counter(), 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE) if len(folded) - at > PIECE else -1
        end = len(folded) if end < 0 else end
        # Only ASCII white space is left to split at: all of it has become blanks.
        found.update(folded[at:end].split(b" "))
        at = end
    found.pop(b"", None)
    return found


def count_terms(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of each term in each group, and for each group a row
    without a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, int]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms in held.items():
                names = [None, *(t.decode("utf-8", "replace") for t in terms)]
                n, numbers = len(names), np.array([0, *terms.values()], np.int64)
                columns = [
                    pa.array([lang] * n), pa.array([source] * n), pa.array(names, pa.string()),
                    pa.array(numbers % DOCUMENT), pa.array(numbers // DOCUMENT),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
            held.clear()

        for batch in batches:
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), utf8(batch["text"]), strict=True):
                known = held.setdefault((lang, source), {})
                before = len(known)
                for term, n in terms_of(text).items():
                    known[term] = known.get(term, 0) + n + DOCUMENT
                size += len(known) - before + 1
                if size >= HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = plain.mapInArrow(run, COUNTS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str, size: str, smooth: int, scale: int) -> Column:
    """1 + floor(scale (n + smooth) / (total + smooth size)), exact; null without any term."""
    return F.expr(
        f"CASE WHEN {size} > 0 THEN 1 + (CAST({scale} AS DECIMAL(20, 0)) * CAST({n} + {smooth} AS DECIMAL(18, 0)))"
        f" div CAST({total} + {smooth} * {size} AS DECIMAL(20, 0)) END"
    )


def differ(a: str, b: str) -> str:
    return f"abs({a} - {b})"


def divergence(docs: DataFrame, least_docs: int = 30, smooth: int = 5, scale: int = 1_000_000_000, top: int = 50) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far each source is from each other source of its language (``pair``), and
    the ``top`` terms it uses more than its language does (``term``)."""
    counted = materialise(count_terms(docs), "terms")
    named = counted.where(F.col("term").isNotNull())
    kept = named.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    placed = number_rows(kept.drop("docs"), ["lang", F.desc("in_lang"), "term"], "place")
    langs = placed.groupBy("lang").agg(F.count("*").alias("size"), F.sum("in_lang").alias("lang_total"))
    used = materialise(named.drop("docs").join(placed, ["lang", "term"]), "kept-terms")

    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    groups = counted.where(F.col("term").isNull()).select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "present", "size", "lang_total")])
    stats = materialise(groups.withColumn("p0", share("0L", "total", "size", smooth, scale)), "groups")

    # One bitmap a group, block and count.
    block, bit = F.floor(F.col("place") / BITS).alias("block"), (F.col("place") % BITS).cast("int")
    flags = used.select("lang", "source", "n", block, bit.alias("bit"))
    bitmaps = flags.groupBy("lang", "source", "block", "n").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    numbers = stats.select("lang", "source", "total", "size", "p0")
    levels = bitmaps.join(numbers, ["lang", "source"]).withColumn("p", share("n", "total", "size", smooth, scale))
    levels = materialise(levels.select("lang", "source", "block", "bits", "p", "p0"), "levels")

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*[F.col(c) if c in ("lang", "block") else F.col(c).alias(prefix + c) for c in df.columns])

    joint = side(levels, "a_").join(side(levels, "b_"), ["lang", "block"]).where("a_source < b_source AND (a_bits & b_bits) <> 0")
    f = f"{differ('a_p', 'b_p')} - {differ('a_p', 'b_p0')} - {differ('a_p0', 'b_p')} + {differ('a_p0', 'b_p0')}"
    cells = joint.groupBy("lang", "a_source", "b_source").agg(F.expr(f"sum(bit_count(a_bits & b_bits) * ({f}))").alias("v"))

    # n(i) f(i, 0): all terms of a level against the other group's share of a term it lacks.
    sizes = levels.groupBy("lang", "source", "p").agg(F.expr("sum(bit_count(bits))").alias("n"))
    others = side(stats.select("lang", "source", "p0", "present", "size"), "b_")
    edges = side(sizes, "a_").join(others, "lang").where("a_source <> b_source")
    edges = edges.groupBy("lang", "a_source", "b_source").agg(F.expr(f"sum(a_n * {differ('a_p', 'b_p0')})").alias("v"))

    both = side(stats.select("lang", "source", "p0", "present", "size"), "a_").join(others, "lang").where("a_source <> b_source")
    rest = both.select("lang", "a_source", "b_source", F.expr(f"coalesce((a_size - a_present - b_present) * {differ('a_p0', 'b_p0')}, 0L)").alias("v"))

    # Cells and edges count for both orders of a pair.
    ends = F.array(F.struct("a_source", "b_source"), F.struct(F.col("b_source").alias("a_source"), F.col("a_source").alias("b_source")))
    found = edges.unionByName(cells).select("lang", "v", F.explode(ends).alias("e")).select("lang", "e.a_source", "e.b_source", "v")
    parts = rest.unionByName(found)
    pairs = parts.groupBy("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item")).agg(F.sum("v").alias("value"))

    shared = used.join(stats.select("lang", "source", "total", "size", "lang_total"), ["lang", "source"])
    shared = shared.withColumns({"p": share("n", "total", "size", smooth, scale), "q": share("in_lang", "lang_total", "size", smooth, scale)})
    terms = shared.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("p - q").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    first = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    all_pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return all_pairs.select(*columns).unionByName(first.select(*columns))
