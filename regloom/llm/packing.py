"""Packing of tokenised documents into sequences of at most ``LENGTH`` tokens.

Documents are tokenised where they are read and cut every ``LENGTH`` tokens.  The pieces are dealt into random groups of
about ``GROUP`` pieces; each group is packed on its own by first-fit decreasing, with a tournament tree
over the bins' free room that finds the first bin with room enough in logarithmic time.  Only pieces' sizes travel; the ids
stay where they are cut, and ``sequences`` brings them together for writing.

Defined cases: null and empty texts have the closing id alone; rows with the same id are pieces of their own;
a null id stays null; long texts are encoded word by word and cut like any other; an empty table gives an empty
result.  Equal sizes are packed by doc_id, start and checksum.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.llm.common import utf8
from regloom.session import materialise

LENGTH = 4096
END = 2
GROUP = 4096  # pieces in a group, on average
CACHED = 800_000  # words whose ids a worker remembers
STOP = re.compile(rb"(?<=[A-Za-z0-9])[.,](?=[ \n])")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordIds:
    """Ids of white-space separated words, remembered as little-endian unsigned 32-bit bytes.

    The tokenizer lower-cases and splits at white space and between letters and signs before it merges, so a
    text's ids are its words' ids in order, with a comma or full stop that ends a word on its own.  Words of ASCII alone are
    remembered in lower case; others go to the tokenizer as they are, since it composes letters and marks before it lower-cases.
    """

    def __init__(self, path: str, cached: int = CACHED):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.cached = cached
        self.known: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        new = list(words)
        for i in range(0, len(new), 256):
            part = [w.decode() for w in new[i : i + 256]]
            coded = self.encoder.encode(" ".join(part), add_special_tokens=False)
            starts = np.cumsum([0] + [len(w) + 1 for w in part])
            bounds = np.searchsorted([a for a, _ in coded.offsets], starts) * 4
            held = np.array(coded.ids, "<u4").tobytes()
            for word, a, b in zip(new[i : i + 256], bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                self.known[word] = held[a:b]

    def of(self, text: bytes) -> bytes:
        # A special token's name is one in lower case only, so texts with anything like one stay as they are.
        if b"<|" in text:
            words = text.split()
        elif text.isascii():
            words = STOP.sub(rb" \g<0>", text.lower()).split()
        else:
            words = [w.lower() if w.isascii() else w for w in STOP.sub(rb" \g<0>", text).split()]
        out = []
        for i in range(0, len(words), 100_000):
            part = words[i : i + 100_000]
            ids = list(map(self.known.get, part))
            if None in ids:
                new = {w for w, x in zip(part, ids, strict=True) if x is None}
                if len(self.known) + len(new) > self.cached:
                    self.known, new = {}, set(part)
                self.learn(new)
                ids = map(self.known.__getitem__, part)
            out.append(b"".join(ids))
        return b"".join(out)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut(path: str, length: int, end: int, with_ids: bool):
    """Pieces of each document of the batches (doc_id, text)."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, closing = word_ids(path), np.array([end], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), utf8(batch["text"]), strict=True):
                ids = encoder.of(text) + closing
                for start in range(0, len(ids), 4 * length):
                    piece = ids[start : start + 4 * length]
                    for column, value in zip(out, (doc_id, start // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece), strict=True):
                        column.append(value)
            columns = [pa.array(c, pa.int64()) for c in out[:5]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in out[5]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return pieces


class Bins:
    """Free room of bins as a tournament tree: each inner node has the larger of its children."""

    def __init__(self, most: int, room: int):
        self.leaves = 1 << max(0, (most - 1).bit_length())
        self.tree = [room] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin with room; the bin and the room it had."""
        tree, at = self.tree, 1
        while at < self.leaves:
            at *= 2
            if tree[at] < size:
                at += 1
        had = tree[at]
        tree[at] = had - size
        bin_ = at - self.leaves
        while at > 1:
            at //= 2
            tree[at] = max(tree[2 * at], tree[2 * at + 1])
        return bin_, had


def first_fit_decreasing(sizes: list[int], room: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each size; ``sizes`` must not rise.  There is a bin for each size, so one always fits."""
    bins, found, offset = Bins(len(sizes), room), [], []
    for size in sizes:
        at, had = bins.place(size)
        found.append(at)
        offset.append(room - had)
    return found, offset


def pack_group(length: int):
    def pack(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
        found, offset = first_fit_decreasing(pieces["length"].tolist(), length)
        return pieces.drop(columns="bucket").assign(sequence_id=pieces["bucket"] * (1 << 32) + np.array(found), offset=offset)

    return pack


def pack(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, group: int = GROUP, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = PIECES + (", ids array<int>" if with_ids else "")
    pieces = materialise(texts.mapInArrow(cut(path, length, end, with_ids), schema), "op6-pieces")
    # Random groups; rows alike in everything are parted by the row they stand in, so no group is hot.
    buckets = max(1, -(-pieces.count() // group))
    meta = pieces.metadataColumn("_metadata")
    deal = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", meta["file_path"], meta["row_index"]), F.lit(buckets))
    dealt = pieces.withColumn("bucket", deal)
    return dealt.groupBy("bucket").applyInPandas(pack_group(length), f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, for pieces packed ``with_ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
