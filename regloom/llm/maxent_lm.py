"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

A word's hash gives it a class, one of 32, and a subclass, one of 32 within the class.  The probability of a word in its context is that of
its class, times that of its subclass given the class, times its share of the subclass.  Class and subclass each have a softmax
over 32 logits, so the word itself is predicted to ten bits by the context, whatever its frequency, and all adds up to one.

Both softmaxes have the same features: the previous word, the two previous words, the word before the previous one (a skip),
and the words of the text up to the last multiple of ``SPAN`` (skips of any length).  For a feature and a value, the feature function is the log ratio of the value's
smoothed share after that feature to its share overall.  The n-gram and skip features are hashed into rows of counts, one table for each of
them and either softmax (``rows_for``: rows grow with the counted tokens, up to ``MOST_ROWS``); the subclass's rows are hashed with the class.
The maximum-entropy weights, one for each feature and for each power of two of the counts behind it, are trained by distributed
gradient updates over all training documents: every task descends over its share of them, each token's own count taken out of the rows, and
the weights move by the tasks' mean change, weighted by their tokens.

Counts cover all training documents.  Word counts grow with the corpus: the most frequent words go to every task, ``HEAD`` at most, all
others are counted and looked up through shuffles.  Tables are summed by blocks of rows, in two steps, and sent to tasks with a byte a
cell, 25 MB in all at most; a task makes 100 MB of feature functions of them.  Texts are split and encoded by Arrow, and scored in numpy batches of ``CHUNK`` spans.

Words are told apart by 64-bit hashes.  Two of a corpus' distinct words collide with a probability of about their number squared over
4e19 (one in forty for a billion words); they would share a count.

Defined cases: null, empty and blank texts have the end token alone; words unknown to the training documents share one
place in each subclass; rows with the same id are scored one by one; a null id is never held out and, being
null, trains like others; without training documents every count is zero; an empty table gives an empty result; a text of any
length is scored whole, batch by batch, with its counts so far carried along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.llm.common import raw, remainder, slices
from regloom.session import materialise

FOLDS, HELD = 7, 2
HEAD = 1 << 17
CLASSES = 32  # and subclasses of each
LEAVES = CLASSES * CLASSES
NGRAMS = 3  # features that are hashed: one word back, two words back, the second back alone
KINDS = NGRAMS + 1  # and the text so far
TABLES = 2 * NGRAMS
LEAST_ROWS, MOST_ROWS = 1 << 10, 1 << 17  # of a table, powers of two
LEVELS = 24  # powers of two of a row's count
SMOOTH = np.array([4, 4, 4, 8], np.float32)  # counts that the overall shares weigh in a row
START_WEIGHT = 0.4
SLICE = 1 << 21  # bytes of text handled together
COUNTED = 8 << 20  # bytes of text whose words are counted together
SPAN = 128  # tokens of a text that see the same text so far: what came before the first of them
CHUNK = 32  # spans in a batch, and in a gradient update
SEED = 7
RATE = 0.3
BLOCK = 1024  # rows of a table that travel together
SALTS = 16
LOG10 = 1 / math.log(10)

_C1, _C2, _C3, _C4 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


@dataclass
class Tokens:
    """Tokens of some texts in order: indices into distinct 64-bit hashes, and how many each text has, the end token included.
    Its hash is zero, which no word has."""

    hashes: np.ndarray
    index: np.ndarray
    n: np.ndarray


def encode(texts: pa.Array) -> Tokens:
    """Words of A-Z lower-cased texts between ASCII white space, each text closed by the end token."""
    # Copied, because lower-casing reads slices of some arrays wrongly.
    texts = pa.concat_arrays([texts.cast(pa.string()).fill_null("")])
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy()
    filled = pc.not_equal(flat, "")  # a blank at a text's end parts off an empty word
    kept = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    words = np.diff(kept[offsets])
    found = flat.filter(filled).dictionary_encode()
    ends, data = raw(found.dictionary)
    each = map(data.tobytes().__getitem__, map(slice, ends[:-1].tolist(), ends[1:].tolist()))
    distinct = len(found.dictionary)
    hashes = np.zeros(distinct + 1, np.uint64)
    hashes[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, each, repeat(SEED)), np.uint64, distinct)
    hashes[:-1][hashes[:-1] == 0] = 1
    index = np.full(int(words.sum()) + len(words), distinct, np.int64)
    index[np.arange(int(words.sum())) + np.repeat(np.arange(len(words)), words)] = found.indices.to_numpy()
    return Tokens(hashes, index, words + 1)


def encoded(batch: pa.RecordBatch, most: int | None = None) -> Iterator[tuple[int, int, Tokens]]:
    texts = batch["text"]
    for a, b in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), most or SLICE):
        yield a, b, encode(texts.slice(a, b - a))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * _C1
    x = (x ^ (x >> np.uint64(29))) * _C2
    return x ^ (x >> np.uint64(32))


def leaf_of(hashes: np.ndarray) -> np.ndarray:
    """Class and subclass of words, as one number of ten bits."""
    return (mixed(hashes + np.uint64(77)) >> np.uint64(54)).astype(np.int64)


def rows_for(tokens: int) -> int:
    """Rows of a table: half as many as training tokens, as a power of two within bounds."""
    return min(MOST_ROWS, max(LEAST_ROWS, 1 << max(0, (int(tokens) // 2).bit_length() - 1)))


def words_before(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the previous word and of the one before it, at each token; before a text there are end tokens."""
    h = t.hashes[t.index]
    start = np.cumsum(t.n) - t.n
    one = np.concatenate([[np.uint64(0)], h[:-1]])
    one[start] = 0
    two = np.concatenate([[np.uint64(0)], one[:-1]])
    two[start] = 0
    return one, two


def contexts(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """A hash of what each of the n-gram features is at each token."""
    first = mixed(one + np.uint64(1))
    return np.stack([first, mixed(first ^ (two * _C3)), mixed(two + np.uint64(0x51ED270B))])


def table_rows(where: np.ndarray, leaf: np.ndarray, rows: int) -> np.ndarray:
    """Rows of all tables (the class's, then the subclass's) that are active at each token, numbered through."""
    bits, class_bits = rows.bit_length() - 1, CLASSES.bit_length() - 1
    top = leaf // CLASSES
    with_class = mixed(where ^ (top.astype(np.uint64) + np.uint64(1)) * _C4) >> np.uint64(64 - bits + class_bits)
    # Each class has its share of a subclass table, so a row has one class.
    second = with_class.astype(np.int64) + top * (rows >> class_bits)
    found = np.concatenate([(where >> np.uint64(64 - bits)).astype(np.int64), second])
    return found + (np.arange(TABLES) * rows)[:, None]


# --- counting ---


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, t in encoded(batch, COUNTED):
            counts = np.bincount(t.index, minlength=len(t.hashes))
            yield pa.RecordBatch.from_arrays([pa.array(t.hashes.view(np.int64)), pa.array(counts)], ["h", "c"])


def count_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each leaf's words, one more for each word."""
    held = np.zeros(LEAVES, np.int64)
    for batch in batches:
        np.add.at(held, leaf_of(batch["h"].to_numpy().view(np.uint64)), batch["c"].to_numpy() + 1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEAVES)), pa.array(held)], ["leaf", "mass"])


PART = "block long, salt int, cells binary, at binary, more binary"


def packed(block: int, salt: int, counts: np.ndarray) -> tuple:
    """A block of counts with a byte a cell; what is beyond a byte comes as places and numbers."""
    large = np.flatnonzero(counts > 255)
    return block, salt, np.minimum(counts, 255).astype(np.uint8).tobytes(), large.astype("<i4").tobytes(), (counts[large] - 255).astype("<i8").tobytes()


def unpacked(cells, at, more) -> np.ndarray:
    counts = np.frombuffer(cells.as_buffer(), np.uint8).astype(np.int64)
    counts[np.frombuffer(at.as_buffer(), "<i4")] += np.frombuffer(more.as_buffer(), "<i8")
    return counts


def parts_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
        ["block", "salt", "cells", "at", "more"],
    )


def count_rows(rows: int):
    """How often each value follows each row's contexts in a task's texts, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = np.zeros(TABLES * rows * CLASSES, np.int32)
        for batch in batches:
            for _, _, t in encoded(batch):
                every, before = leaf_of(t.hashes)[t.index], words_before(t)
                for i in range(0, len(every), CHUNK * SPAN):
                    leaf, (one, two) = every[i : i + CHUNK * SPAN], (x[i : i + CHUNK * SPAN] for x in before)
                    at = table_rows(contexts(one, two), leaf, rows) * CLASSES
                    at[:NGRAMS] += leaf // CLASSES
                    at[NGRAMS:] += leaf % CLASSES
                    np.add.at(table, at.reshape(-1), np.int32(1))
        salt = TaskContext.get().partitionId() % SALTS
        size = BLOCK * CLASSES
        used = [b for b in range(len(table) // size) if table[b * size : (b + 1) * size].any()]
        for i in range(0, len(used), 64):
            yield parts_of([packed(b, salt, table[b * size : (b + 1) * size]) for b in used[i : i + 64]])

    return run


def add_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the parts of each block and salt; they come sorted, and one sum is held at a time."""
    known, total = None, None
    for batch in batches:
        for block, salt, *part in zip(batch["block"].to_pylist(), batch["salt"].to_pylist(), batch["cells"], batch["at"], batch["more"], strict=True):
            if (block, salt) != known:
                if known is not None:
                    yield parts_of([packed(*known, total)])
                known, total = (block, salt), unpacked(*part)
            else:
                total += unpacked(*part)
    if known is not None:
        yield parts_of([packed(*known, total)])


def added(parts: DataFrame) -> DataFrame:
    return parts.repartition("block", "salt").sortWithinPartitions("block", "salt").mapInArrow(add_parts, PART)


QUANTIZED = "block long, cells binary, scale binary, total binary"


def quantize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with a byte a cell: counts themselves in rows where all fit, else in equal steps."""
    for batch in batches:
        out = []
        for block, *part in zip(batch["block"].to_pylist(), batch["cells"], batch["at"], batch["more"], strict=True):
            counts = unpacked(*part).reshape(BLOCK, CLASSES)
            scale = np.maximum(counts.max(axis=1) / 255, 1)
            cells = np.rint(counts / scale[:, None]).astype(np.uint8)
            out.append((block, cells.tobytes(), scale.astype("<f4").tobytes(), counts.sum(axis=1).astype("<f4").tobytes()))
        if out:
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), *[pa.binary()] * 3), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["block", "cells", "scale", "total"])


# --- the model ---


@dataclass
class Model:
    """What tasks need beside the weights: word counts of the head, masses of the leaves, tables of counts.  Sent once."""

    words: np.ndarray  # hashes of the head, sorted
    counts: np.ndarray
    mass: np.ndarray
    rows: int
    cells: np.ndarray  # a byte for each row and value
    scale: np.ndarray
    total: np.ndarray
    logs: np.ndarray | None = None
    weights: np.ndarray | None = None  # those that ``logs`` have been multiplied by

    def prepare(self, weights: np.ndarray | None = None) -> None:
        """Log shares of the leaves, and the feature function of every cell, times its weight if weights are given.  Made once
        by each worker: only counts travel."""
        if self.logs is None or (self.weights is not None and (weights is None or not np.array_equal(self.weights, weights))):
            self._find_logs()
        if weights is not None and self.weights is None:
            for at in range(0, len(self.logs), BLOCK):
                here, table = slice(at, at + BLOCK), at // self.rows
                self.logs[here] *= weights[table // NGRAMS, table % NGRAMS].astype(np.float32)[self.level[here]][:, None]
            self.weights = weights.copy()

    def _find_logs(self) -> None:
        mass = self.mass.reshape(CLASSES, CLASSES).astype(np.float64)
        each = mass.sum(axis=1)
        self.shares = [(each / each.sum()).astype(np.float32)[None, :], (mass / each[:, None]).astype(np.float32)]
        self.log_shares = [np.log(s) for s in self.shares]
        logs = np.empty(self.cells.shape, np.float32) if self.logs is None else self.logs
        for at in range(0, len(self.cells), BLOCK):
            here, table = slice(at, at + BLOCK), at // self.rows
            share = self.shares[0] if table < NGRAMS else self.shares[1][np.arange(at, at + BLOCK) % self.rows // (self.rows // CLASSES)]
            logs[here] = log_ratio(self.cells[here] * self.scale[here][:, None], share, self.total[here][:, None], table % NGRAMS)
        self.level = level_of(self.total)
        self.logs, self.weights = logs, None

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Counts of words, zero where they are not in the head."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.counts[at], 0)


def log_ratio(counts, share, total, kind: int):
    """A value's smoothed share after a feature against its share overall, as a logarithm."""
    return np.log((counts / share + SMOOTH[kind]) / (total + SMOOTH[kind]))


class History:
    """Counts of all leaves over the text so far, for each span; spans of a text follow each other, in batches."""

    def __init__(self):
        self.doc, self.seen = -1, np.zeros(LEAVES, np.float32)

    def of(self, doc: np.ndarray, span: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """``doc`` is each span's text, ``span`` each token's span, counted from the batch's first."""
        counts = np.bincount(span * LEAVES + leaf, minlength=len(doc) * LEAVES).reshape(-1, LEAVES).astype(np.float32)
        before = np.cumsum(counts, axis=0) - counts
        starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        for start, end in zip(starts, [*starts[1:], len(doc)], strict=True):
            going = doc[start] == self.doc
            before[start:end] += (self.seen if going else 0) - before[start].copy()
        self.doc, self.seen = doc[-1], before[-1] + counts[-1]
        return before


@dataclass
class Batch:
    part: slice  # of the tokens
    leaf: np.ndarray
    rows: np.ndarray  # active rows of all tables
    so_far: list[tuple[np.ndarray, np.ndarray]]  # for either softmax, the text's functions and its counts
    which: list[np.ndarray]  # where each token's are in those


def batches_in(t: Tokens, model: Model) -> Iterator[Batch]:
    leaf = leaf_of(t.hashes)[t.index]
    one, two = words_before(t)
    spans = -(-t.n // SPAN)
    of = np.repeat(np.arange(len(t.n)), spans)  # text of each span
    place = np.arange(len(of)) - np.repeat(np.cumsum(spans) - spans, spans)
    first = np.append(np.repeat(np.cumsum(t.n) - t.n, spans) + place * SPAN, len(leaf))
    history = History()
    for i in range(0, len(of), CHUNK):
        j = min(i + CHUNK, len(of))
        part = slice(first[i], first[j])
        span = np.repeat(np.arange(j - i), np.diff(first[i : j + 1]))
        low = history.of(of[i:j], span, leaf[part]).reshape(-1, CLASSES, CLASSES)
        top = low.sum(axis=2)
        so_far = [
            (log_ratio(top, model.shares[0], top.sum(axis=1)[:, None], NGRAMS), top.sum(axis=1)),
            (log_ratio(low, model.shares[1], top[:, :, None], NGRAMS).reshape(-1, CLASSES), top.reshape(-1)),
        ]
        rows = table_rows(contexts(one[part], two[part]), leaf[part], model.rows)
        yield Batch(part, leaf[part], rows, so_far, [span, span * CLASSES + leaf[part] // CLASSES])


def level_of(total: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(total + 1).astype(np.int8), LEVELS - 1)


def row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)


def from_text(model: Model, softmax: int, b: Batch, weights: np.ndarray, out: np.ndarray) -> np.ndarray:
    """What a token's class and the text so far add to its unscaled log probabilities.  Both are found for spans, then dealt to tokens."""
    x, total = b.so_far[softmax]
    x = x * np.take(weights.astype(np.float32), level_of(total))[:, None]
    x = (x.reshape(-1, *model.log_shares[softmax].shape) + model.log_shares[softmax]).reshape(-1, CLASSES)
    return np.take(x, b.which[softmax], axis=0, out=out, mode="clip")


class Room:
    """Arrays of a batch's size that are used over and over."""

    def __init__(self, arrays: int):
        self.held = np.empty((arrays, CHUNK * SPAN, CLASSES), np.float32)

    def of(self, n: int) -> list[np.ndarray]:
        return [x[:n] for x in self.held]


# --- training ---

CHANGE = "seen long, change binary"


def slopes(model: Model, softmax: int, b: Batch, weights: np.ndarray, room: Room) -> Iterator[np.ndarray]:
    """For each kind the slope of the loss by its weights, a level each.

    The token itself is taken out of its rows, which have counted it.  What that changes in all values alike is left out: it
    changes no probability.
    """
    n = len(b.leaf)
    *found, z, x = room.of(n)
    value = b.leaf % CLASSES if softmax else b.leaf // CLASSES
    at = np.arange(n) * CLASSES + value
    share = np.take(model.shares[softmax], b.leaf if softmax else value)
    from_text(model, softmax, b, weights[NGRAMS], z)
    totals = np.take(model.total, b.rows[softmax * NGRAMS : (softmax + 1) * NGRAMS])
    levels, own = level_of(np.maximum(totals - 1, 0)), []
    for kind, (f, total, level) in enumerate(zip(found, totals, levels, strict=True)):
        np.take(model.logs, b.rows[softmax * NGRAMS + kind], axis=0, out=f, mode="clip")
        smooth = SMOOTH[kind]
        counted = (np.exp(np.take(f, at)) * (total + smooth) - smooth) * share
        own.append(log_ratio(np.maximum(np.rint(counted) - 1, 0), share, total, kind))
        np.put(f, at, own[-1])
        z += np.multiply(f, np.take(weights[kind].astype(np.float32), level)[:, None], out=x)
    # Unscaled; their size needs no guard, as functions and weights are bounded.
    chance = np.exp(z, out=z)
    scale = 1 / row_sums(chance)
    text, total = b.so_far[softmax]
    np.take(text, b.which[softmax], axis=0, out=x, mode="clip")
    own.append(np.take(x, at))
    for f, right, level in zip([*found, x], own, [*levels, np.take(level_of(total), b.which[softmax])], strict=True):
        yield np.bincount(level, row_sums(np.multiply(f, chance, out=f)) * scale - right, LEVELS)


def train_share(shared: Broadcast, weights: np.ndarray):
    """Each task's change of the weights times its tokens, and the tokens, as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        model.prepare()
        own, square, seen, room = weights.copy(), np.ones_like(weights), 0, Room(NGRAMS + 2)
        for batch in batches:
            for _, _, t in encoded(batch):
                for b in batches_in(t, model):
                    for softmax in (0, 1):
                        for kind, slope in enumerate(list(slopes(model, softmax, b, own[softmax], room))):
                            square[softmax, kind] += slope * slope
                            own[softmax, kind] -= RATE * slope / np.sqrt(square[softmax, kind])
                    seen += len(b.leaf)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([((own - weights) * seen).tobytes()])], ["seen", "change"])

    return run


def add_changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, change = 0, np.zeros(2 * KINDS * LEVELS)
    for batch in batches:
        for n, part in zip(batch["seen"].to_pylist(), batch["change"], strict=True):
            seen += n
            change += np.frombuffer(part.as_buffer())
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([change.tobytes()])], ["seen", "change"])


def head_of(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words, at most ``HEAD``: all from the least count on that leaves no more, to a sixteenth of a power of two."""
    step = F.floor(F.log2("c") * 16).alias("step")
    steps = counts.groupBy(step).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect()  # some hundreds
    held, least = 0, None
    for row in steps:
        held += row["n"]
        if held > HEAD:
            break
        least = row["step"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    frequent = counts.where(step >= least).toArrow()
    words, n = frequent["h"].to_numpy().view(np.uint64), frequent["c"].to_numpy()
    order = np.argsort(words)
    return words[order], n[order]


def fit(known: DataFrame, counts: DataFrame, tokens: int) -> tuple[Broadcast, np.ndarray]:
    """The model of training documents ``(doc_id, text)`` whose words are counted, and its weights (softmax, kind, level)."""
    mass = np.ones(LEAVES, np.int64)  # a place for unknown words
    leaves = counts.mapInArrow(count_leaves, "leaf long, mass long").groupBy("leaf").agg(F.sum("mass").alias("mass"))
    for row in leaves.collect():  # one row a leaf
        mass[row["leaf"]] += row["mass"]
    rows = rows_for(tokens)
    parts = added(known.select("text").mapInArrow(count_rows(rows), PART))
    sums = added(parts.withColumn("salt", F.lit(0).cast("int")))
    cells = np.zeros((TABLES * rows, CLASSES), np.uint8)
    scale, total = np.ones(TABLES * rows, np.float32), np.zeros(TABLES * rows, np.float32)
    for row in sums.mapInArrow(quantize, QUANTIZED).toLocalIterator():  # the tables' own size, whatever the corpus
        here = slice(row["block"] * BLOCK, (row["block"] + 1) * BLOCK)
        cells[here] = np.frombuffer(row["cells"], np.uint8).reshape(BLOCK, CLASSES)
        scale[here], total[here] = np.frombuffer(row["scale"], "<f4"), np.frombuffer(row["total"], "<f4")
    shared = known.sparkSession.sparkContext.broadcast(Model(*head_of(counts), mass, rows, cells, scale, total))
    weights = np.full((2, KINDS, LEVELS), START_WEIGHT)
    changes = known.select("text").mapInArrow(train_share(shared, weights), CHANGE)
    # A number for each weight: added up by some tasks, then by one.
    for row in changes.repartition(SALTS).mapInArrow(add_changes, CHANGE).repartition(1).mapInArrow(add_changes, CHANGE).collect():
        weights = weights + np.frombuffer(row["change"]).reshape(weights.shape) / row["seen"]
    return shared, weights


# --- scoring ---


SCORED = "doc_id long, held_out boolean, n_tokens long, known long, logs double, model double, tail array<long>"


def token_scores(t: Tokens, model: Model, weights: np.ndarray) -> np.ndarray:
    """Log10 of the probability of each token's class and subclass."""
    model.prepare(weights)
    out, room = np.zeros(len(t.index)), Room(2)
    for b in batches_in(t, model):
        z, x = room.of(len(b.leaf))
        for softmax in (0, 1):
            from_text(model, softmax, b, weights[softmax, NGRAMS], z)
            for at in b.rows[softmax * NGRAMS : (softmax + 1) * NGRAMS]:
                z += np.take(model.logs, at, axis=0, out=x, mode="clip")
            own = np.take(z, np.arange(len(z)) * CLASSES + (b.leaf % CLASSES if softmax else b.leaf // CLASSES))
            out[b.part] += own - np.log(row_sums(np.exp(z, out=z)))
    return out * LOG10


def score_batches(shared: Broadcast, weights: np.ndarray):
    """Per document what its head words and contexts give, and the hashes of its other words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        model.prepare(weights)
        inner = np.log10(model.mass.astype(np.float64))
        for batch in batches:
            ids, held = batch["doc_id"], batch["held_out"]
            for a, b, t in encoded(batch):
                start = np.cumsum(t.n) - t.n
                counts = model.find(t.hashes)
                known, logs = (counts > 0)[t.index], np.log10(np.maximum(counts, 0) + 1)[t.index]
                scores = token_scores(t, model, weights) + logs - inner[leaf_of(t.hashes)][t.index]
                others = np.concatenate([[0], np.cumsum(np.add.reduceat((~known).astype(np.int64), start))]).astype(np.int32)
                tail = pa.ListArray.from_arrays(pa.array(others), pa.array(t.hashes[t.index[~known]].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), held.slice(a, b - a), pa.array(t.n), pa.array(np.add.reduceat(known.astype(np.int64), start)),
                     pa.array(np.add.reduceat(logs, start)), pa.array(np.add.reduceat(scores, start)), tail],
                    ["doc_id", "held_out", "n_tokens", "known", "logs", "model", "tail"],
                )

    return run


def prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, int, int]:
    """All texts, the training documents, their word counts, and their numbers of tokens and distinct tokens."""
    held = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD, F.lit(False))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held_out"))
    known = texts.where(~F.col("held_out")).select("doc_id", "text")
    counts = known.select("text").mapInArrow(count_words, "h long, c long").where("c > 0").groupBy("h").agg(F.sum("c").alias("c"))
    counts = materialise(counts, "op7-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    return texts, known, counts, int(total), int(distinct)


def score_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    texts, known, counts, total, distinct = prepared(docs)
    scored = materialise(texts.mapInArrow(score_batches(*fit(known, counts, total)), SCORED), "op7-scored")
    place = scored.metadataColumn("_metadata")
    scored = scored.select("*", F.xxhash64(place["file_path"]).alias("f"), place["row_index"].alias("r"))
    # Equal words of a document are looked up once; rows of a rare word are few by construction.
    words = scored.select("f", "r", F.explode("tail").alias("h")).groupBy("f", "r", "h").agg(F.count("*").alias("times"))
    found = words.join(counts, "h").groupBy("f", "r").agg(
        F.sum("times").alias("tail_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("tail_logs")
    )
    out = scored.drop("tail").join(found, ["f", "r"], "left")
    tail, more = F.coalesce("tail_logs", F.lit(0.0)), F.coalesce("tail_known", F.lit(0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + more).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + tail - F.col("n_tokens") * math.log10(total + distinct + 1)).alias("base_score"),
        (F.col("model") + tail).alias("score"),
    )
