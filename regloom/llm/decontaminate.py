"""Benchmark decontamination by SimHash over item-sized windows, in DataFrame operations only.

Words are lower-cased and split at ASCII white space; shingles are five words (all words of an item that has fewer).
Only windows that share a shingle with the benchmark can be similar to an item, so windows of an item's length are laid
where one of its shingles occurs, lined up with it.  Each window's SimHash is looked up among the items of that length: its 64
bits are cut into ``RADIUS + 1`` blocks, and fingerprints within the radius must agree on one of them.  Pairs
within the radius are verified by the similarity of their weighted shingles, each weighing as often as it occurs:
sum of lesser counts / sum of greater counts, at least ``SIMILARITY``.

Expected distance at a similarity of 0.8 is 10 of 64 bits with a deviation of 3; the radius lies over three deviations above.

Defined cases: null, empty and blank texts and items match nothing; items of the same id are matched one by one and
reported by their best; a null id is reported as null; a document repeated row by row is reported once; windows
are cut at the ends of a text; empty tables give an empty result; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.llm.common import words_of
from regloom.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
# Benchmark shingles that are broadcast at most, 24 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
# Bytes that any other table of items takes at most where it is broadcast, what a row takes besides its text, and the text of a key.
BROADCAST_BYTES = 16 << 20
ROW_BYTES = 100
KEY_BYTES = 64


def hashed(words: str, at: str, width: int) -> str:
    """SQL for the hash of ``width`` words from position ``at`` of the array of word hashes ``words``."""
    return f"xxhash64({', '.join(f'get({words}, {at} + {i})' for i in range(width))})"


def shingles(words: str, width: Column | int) -> Column:
    """All shingles of an array of words, as text."""
    last = F.size(words) - width
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(words, i + 1, width), " "))
    return F.when(last >= 0, runs).otherwise(F.array().cast("array<string>"))


def simhash(hashes: str) -> Column:
    """Bit b is set if over half of the hashes have it set."""
    count = f"aggregate({hashes}, 0, (n, h) -> n + int(shiftright(h, b) & 1))"
    return F.expr(f"aggregate(sequence(0, 63), 0L, (fp, b) -> fp | if(2 * {count} > size({hashes}), shiftleft(1L, b), 0L))")


def blocks(fp: str, number: int) -> Column:
    """The bits of a fingerprint in ``number`` blocks that cover all 64."""
    cuts = [64 * i // number for i in range(number + 1)]
    parts = (f"struct({i} AS block, shiftrightunsigned({fp}, {a}) & {2 ** (b - a) - 1}L AS bits)" for i, (a, b) in enumerate(zip(cuts, cuts[1:])))
    return F.explode(F.expr(f"array({', '.join(parts)})"))


def prepared(benchmark: DataFrame) -> DataFrame:
    """Distinct items: text ``key``, words, length, shingle width, shingles and fingerprint."""
    items = benchmark.select(words_of(F.lower("text")).alias("words")).where("size(words) > 0").distinct()
    items = items.select(
        F.sha2(F.array_join("words", " "), 256).alias("key"), "words", F.size("words").alias("n"),
        F.least(F.size("words"), F.lit(SHINGLE)).alias("width"),
    )
    items = items.withColumn("grams", shingles("words", F.col("width")))
    return items.withColumn("fp", simhash("transform(grams, g -> xxhash64(g))"))


def beside(items: DataFrame, rows: int, text: int) -> DataFrame:
    """A table of items as one side of a join with windows: broadcast if its ``rows`` and their ``text`` bytes are few, else shuffled.

    Spark's own threshold is not asked: it knows the size of compressed files, which says little of the rows that are exploded from
    them, and would broadcast windows as well.
    """
    return F.broadcast(items) if rows * ROW_BYTES + text <= BROADCAST_BYTES else items.hint("merge")


def windows(docs: DataFrame, items: DataFrame, widths: list[int]) -> DataFrame:
    """Item-sized windows of the documents that share a shingle with an item, lined up with it: doc_id, text (a hash),
    start, n, width and words."""
    own = items.select("n", "width", F.posexplode(F.expr("transform(words, w -> xxhash64(w))")).alias("offset", "h0"), F.expr("transform(words, w -> xxhash64(w))").alias("wh"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text"), words_of(F.lower("text")).alias("words"))
    source = source.select("*", F.expr("transform(words, w -> xxhash64(w))").alias("wh"))
    source = source.select("doc_id", "text", "words", "wh", F.posexplode("wh").alias("at", "h0"))
    laid = None
    for width in widths:
        marks = own.where((F.col("width") == width) & (F.col("offset") + width <= F.col("n")))
        marks = marks.select(F.expr(hashed("wh", "offset", width)).alias("h"), "offset", "n").distinct()
        marks = materialise(marks, "op1-marks")
        marks = F.broadcast(marks) if marks.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else marks.hint("merge")
        placed = source.where(F.col("at") + width <= F.size("wh")).withColumn("h", F.expr(hashed("wh", "at", width)))
        found = placed.join(marks, "h").select(
            "doc_id", "text", F.greatest(F.col("at") - F.col("offset"), F.lit(0)).alias("start"),
            F.least(F.col("at") - F.col("offset") + F.col("n"), F.size("words")).alias("stop"), "n", F.lit(width).alias("width"), "words",
        )
        found = found.select("doc_id", "text", "start", "n", "width", F.expr("slice(words, start + 1, stop - start)").alias("words"))
        laid = found if laid is None else laid.unionByName(found)
    return laid.dropDuplicates(["doc_id", "text", "start", "n", "width", "words"])


def leaks(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """Verified pairs: doc_id, text (a hash), key (of the item's text), start, n, similarity."""
    items = materialise(prepared(benchmark), "op1-items")
    sizes = items.groupBy("width").agg(
        F.count("*").alias("items"), F.sum(F.size("grams")).alias("grams"),
        F.sum(F.expr("aggregate(grams, 0L, (n, g) -> n + octet_length(g))")).alias("text"),
    ).collect()
    widths = sorted(r["width"] for r in sizes)  # at most SHINGLE values
    if not widths:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("text"), F.lit("").alias("key"), F.lit(0).alias("start"), F.lit(0).alias("n"), F.lit(0.0).alias("similarity")).limit(0)
    laid = windows(docs, items, widths).select("*", shingles("words", F.col("width")).alias("grams"))
    laid = laid.withColumn("fp", simhash("transform(grams, g -> xxhash64(g))"))
    laid = materialise(laid.drop("words").withColumn("w", F.xxhash64("doc_id", "text", "start", "n")), "op1-windows")
    number = radius + 1
    theirs = items.select("key", "n", F.col("fp").alias("item_fp"), blocks("fp", number).alias("b")).select("key", "n", "item_fp", "b.*")
    ours = laid.select("w", "doc_id", "text", "start", "n", "fp", blocks("fp", number).alias("b")).select("w", "doc_id", "text", "start", "n", "fp", "b.*")
    n_items = sum(r["items"] for r in sizes)
    theirs = beside(theirs, number * n_items, number * n_items * KEY_BYTES)
    near = ours.join(theirs, ["n", "block", "bits"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    near = near.select("w", "doc_id", "text", "start", "n", "key").distinct()
    gram = F.explode("grams").alias("gram")
    ours = laid.select("doc_id", "text", "start", "n", gram, F.size("grams").alias("size")).groupBy("doc_id", "text", "start", "n", "size", "gram").agg(F.count("*").alias("own"))
    theirs = items.select("key", gram, F.size("grams").alias("item_size")).groupBy("key", "item_size", "gram").agg(F.count("*").alias("other"))
    theirs = beside(theirs, sum(r["grams"] for r in sizes), sum(r["grams"] * KEY_BYTES + r["text"] for r in sizes))
    # Null ids must meet as well: the join is on the null-safe row key.  Both sides grow with the documents.
    same = [near[c].eqNullSafe(ours[c]) for c in ("doc_id", "text", "start", "n")]
    shared = near.join(ours.hint("merge"), same).select(near["doc_id"], near["text"], near["start"], near["n"], "key", "size", "gram", "own")
    shared = shared.join(theirs, ["key", "gram"]).groupBy("doc_id", "text", "start", "n", "key", "size", "item_size").agg(F.sum(F.least("own", "other")).alias("both"))
    value = F.col("both") / (F.col("size") + F.col("item_size") - F.col("both"))
    return shared.withColumn("similarity", value).where(F.col("similarity") >= similarity).select("doc_id", "text", "key", "start", "n", "similarity")


def contamination(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, similarity, window_start, window_words."""
    found = leaks(docs, benchmark, radius, similarity)
    best = found.groupBy("doc_id", "key").agg(F.max(F.struct("similarity", (-F.col("start")).alias("later"), "n")).alias("b"))
    words = words_of(F.lower("text"))
    named = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.sha2(F.array_join(words, " "), 256).alias("key"))
    rows = benchmark.count()
    pairs = best.join(beside(named, rows, rows * KEY_BYTES), "key").groupBy("doc_id", "item_id").agg(F.max("b").alias("b"))
    return pairs.select(
        "doc_id", "item_id", F.col("b.similarity").alias("similarity"), (-F.col("b.later")).cast("long").alias("window_start"),
        F.col("b.n").cast("long").alias("window_words"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item."""
    # Written first: Spark knows their size when it plans the join.
    bad = materialise(leaks(docs, benchmark).select("doc_id", F.col("text").alias("text_hash")).distinct(), "op1-bad")
    rows = docs.select(F.struct("*").alias("d"))
    same = rows["d.doc_id"].cast("long").eqNullSafe(bad["doc_id"]) & (F.xxhash64(rows["d.text"]) == bad["text_hash"])
    return rows.join(bad, same, "left_anti").select("d.*")
