"""Importance resampling towards a target: documents that read like the target are drawn more often.

Texts are lower-cased in ASCII and cut into words by an untrained pre-tokenizer (a regular expression, nothing learned),
which returns each word with its offsets.  Windows of one to ``longest`` words are pairs of offsets, a start and an end; the
text between them, words joined by one blank, is a feature, and its CRC-32 modulo ``buckets`` the bucket it is counted in.
A bucket's gain is the smoothed log ratio of its share in the target to its share in the documents, in thousandths; a
document weighs as much as the gains of its features in sum.  Gumbel noise drawn from the id turns the highest scores into a
sample without replacement.

Texts are tokenized once: the buckets of a document's features are written as packed numbers, and both the histogram and the
weights are taken from those.  A task sums its histogram before the shuffle.  What reaches the driver, and every task, is
one number a bucket.  Scores are ranked by a range sort, not in one task, and no document is sent to the driver.

Defined cases: null, empty and blank texts have no features, weight 0 and are not drawn unless ``least_words`` is 0; a null id
draws its noise from the empty text and comes first among ties; rows with the same id are rows of their own, and equal
scores of equal ids rank by their number of features, smallest first; without documents the result is empty; without target texts all
shares in the target are equal.  Long texts are cut between words, so a task holds one text and the offsets of one piece.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from regloom.llm.common import slices, utf8
from regloom.operators.rows import number_rows
from regloom.session import materialise

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
PIECE = 1 << 20  # bytes of a text that are tokenized at a time
KNOWN = 1 << 18  # features whose buckets a task remembers

_WORD_BYTE = bytes(b in range(0x30, 0x3A) or b in range(0x61, 0x7B) or b >= 0x80 for b in range(256))
PACKED = "doc_id long, words long, packed binary"


class Buckets(dict):
    """Feature to bucket, remembered.  Forgets all when full: a feature's bucket does not depend on what is known."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        if len(self) >= KNOWN:
            self.clear()
        found = self[feature] = zlib.crc32(feature.encode()) % self.buckets
        return found


def pieces(text: bytes) -> Iterator[str]:
    """The text in pieces that end between words."""
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and _WORD_BYTE[text[end]]:
            end += 1
        yield text[at:end].decode("utf-8", "replace")
        at = end


def featurize(text: bytes, splitter, known: Buckets, longest: int) -> tuple[int, list[int]]:
    """Number of words, and the bucket of every window of up to ``longest`` words."""
    n, found, carried = 0, [], ""
    for piece in pieces(text.lower()):  # bytes.lower() changes A-Z only
        split = splitter.pre_tokenize_str(piece)
        n += len(split)
        found += [known[word] for word, _ in split]
        if longest == 1 or not split:
            continue
        # The words between single blanks, after the last words of the piece before, with the offsets each has there.
        joined = " ".join([*carried.split(), *(word for word, _ in split)])
        old = len(carried.split())
        ends = np.cumsum([len(word) + 1 for word in joined.split(" ")]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        for k in range(2, longest + 1):
            first = max(0, old - k + 1)
            windows = zip(starts[first : len(starts) - k + 1].tolist(), ends[first + k - 1 :].tolist(), strict=True)
            found += [known[joined[start:end]] for start, end in windows]
        keep = min(longest - 1, len(starts))
        carried = joined[starts[-keep] :]
    return n, found


def features(df: DataFrame, doc_id: str, longest: int, buckets: int) -> DataFrame:
    """``(doc_id, words, packed)``: the buckets of a text's features as 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        known = Buckets(buckets)
        for batch in batches:
            counts, packed = [], []
            for text in utf8(batch["text"]):
                n, found = featurize(text, splitter, known, longest)
                counts.append(n)
                packed.append(np.array(found, "<u4").tobytes())
            for start, end in slices([len(p) for p in packed], 1 << 24):
                ids = batch["doc_id"].slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(counts[start:end], pa.int64()), pa.array(packed[start:end], pa.binary())], ["doc_id", "words", "packed"]
                )

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), "text").mapInArrow(run, PACKED)


def histogram(packed: DataFrame, buckets: int) -> np.ndarray:
    """Number of features in each bucket, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch["packed"]:
                held += np.bincount(np.frombuffer(value.as_buffer(), "<u4"), minlength=buckets)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], ["bucket", "n"])

    summed = packed.select("packed").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, object)
    for row in summed.collect():  # at most one row a bucket
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln(ratio of the smoothed shares)) of each bucket."""
    n = len(source)
    all_source, all_target = int(source.sum()) + n, int(target.sum()) + n
    return [
        math.floor(1000 * math.log(float(t + 1) * float(all_source) / (float(s + 1) * float(all_target))))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    ]


def weigh(packed: DataFrame, gain: list[int]) -> DataFrame:
    """``(doc_id, words, n_features, weight)``: the gains of each document's features in sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(gain, np.int64)
        for batch in batches:
            found = [np.frombuffer(value.as_buffer(), "<u4") for value in batch["packed"]]
            arrays = [
                batch["doc_id"], batch["words"],
                pa.array([len(f) for f in found], pa.int64()), pa.array([int(table[f].sum()) for f in found], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "words", "n_features", "weight"])

    return packed.mapInArrow(run, "doc_id long, words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, target_id: str = "item_id", longest: int = 1, buckets: int = BUCKETS,
    seed: int = 2024, least_words: int = 20, percent: int = 10,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every document; rank is null where a document is not drawn.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred are drawn, rounded down.
    """
    packed = materialise(features(docs, "doc_id", longest, buckets), "features")
    gain = gains(histogram(packed, buckets), histogram(features(target, target_id, longest, buckets), buckets))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / F.lit(2.0**32))))
    scored = weigh(packed, gain).withColumn("score", (F.col("weight") + noise).cast("long"))
    # Narrow rows, sorted by range: documents too short to be drawn come last.
    enough = F.col("words") >= least_words
    ranked = number_rows(scored, [F.when(enough, 0).otherwise(1), F.desc("score"), "doc_id", "n_features"], "place")
    n = scored.agg(F.expr(f"count_if(words >= {int(least_words)}) * {int(percent)} div 100").alias("n"))
    rank = F.when(enough & (F.col("place") < n.scalar()), F.col("place") + 1)
    return ranked.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))
