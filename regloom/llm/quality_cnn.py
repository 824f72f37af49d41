"""Quality classifier: a byte-level convolutional network in numpy.

Each byte of a text is embedded; learned filters of ``WIDTH`` bytes slide over the whole text in steps of ``STEP``.
A text is covered by overlapping chunks of two blocks of ``BLOCK`` bytes, each sharing a block with the next;
every filter is max-pooled in each chunk.  The chunks' mean and maximum are combined into one probability.
The network is fitted on a bounded sample of labelled documents (about ``SAMPLE`` per label, chosen by a hash of the id, and of those
the first in the order of that hash that have ``SAMPLE_BYTES`` of text together); every text, in the sample too, is read whole, and
scored in slices of ``SLICE`` bytes, so memory does not grow with a text.

Defined cases: null and empty texts are scored as one block of padding; labels that are null or whose document is
missing do not take part; of documents with the same id one teaches, the first by a hash of its text; without labels of both kinds every score is the share of label 1 (one half without any
labels); rows with the same id are scored one by one; a null id is not held out; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from regloom.llm.common import remainder, utf8
from regloom.session import materialise

FOLDS, HELD = 5, 0
THRESHOLD = 0.3
SAMPLE = 2000
SAMPLE_BYTES = 128 << 20
DIM, FILTERS, WIDTH, STEP, BLOCK = 8, 32, 8, 4, 512
PAD = 256
SLICE = 1 << 20
STEPS, BATCH, RATE = 500, 32, 0.01

Weights = dict[str, np.ndarray]


def padded(text: bytes) -> np.ndarray:
    """Whole blocks, with room for a window that starts in the last bytes."""
    n = -(-(len(text) + WIDTH - STEP) // BLOCK) * BLOCK
    out = np.full(n, PAD, np.int16)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out


def windows(codes: np.ndarray, w: Weights) -> np.ndarray:
    """Embedded windows, one every ``STEP`` bytes; the run has ``WIDTH - STEP`` bytes more than its windows begin in."""
    flat = w["embed"][codes].reshape(-1)
    view = np.lib.stride_tricks.as_strided(
        flat, ((len(codes) - WIDTH) // STEP + 1, WIDTH * DIM), (flat.itemsize * STEP * DIM, flat.itemsize)
    )
    return np.ascontiguousarray(view)


REACH = np.full(WIDTH - STEP, PAD, np.int16)


def block_peaks(codes: np.ndarray, lasts: np.ndarray, w: Weights) -> np.ndarray:
    """Largest answer of each filter in each block, ahead of the bias.

    ``lasts`` numbers the last window of each text: padding alone, and reaching into the next text, it is left out.
    """
    out = []
    codes = np.concatenate([codes, REACH])
    for i in range(0, len(codes) - len(REACH), SLICE):
        answers = windows(codes[i : i + SLICE + len(REACH)], w) @ w["filters"]
        first = i // STEP
        answers[lasts[(lasts >= first) & (lasts < first + len(answers))] - first] = -np.inf
        out.append(answers.reshape(-1, BLOCK // STEP, FILTERS).max(axis=1))
    return np.concatenate(out)


def pooled(peaks: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Mean and maximum over the overlapping chunks of one text."""
    chunks = np.maximum(peaks[:-1], peaks[1:]) if len(peaks) > 1 else peaks
    seen = np.tanh(chunks + bias)
    return np.concatenate([seen.mean(axis=0), seen.max(axis=0)])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_texts(texts: list[bytes], w: Weights) -> np.ndarray:
    """Probability of label 1 of each text."""
    if "constant" in w:
        return np.full(len(texts), float(w["constant"]))
    out = np.zeros(len(texts))
    start, held, codes = 0, 0, []
    for i, text in enumerate(texts):
        codes.append(padded(text))
        held += len(codes[-1])
        if held >= SLICE or i == len(texts) - 1:
            lasts = np.cumsum([len(c) // STEP for c in codes]) - 1
            peaks = block_peaks(np.concatenate(codes), lasts, w)
            at = 0
            for j, c in enumerate(codes):
                n = len(c) // BLOCK
                out[start + j] = pooled(peaks[at : at + n], w["bias"]) @ w["out"] + w["shift"][0]
                at += n
            start, held, codes = i + 1, 0, []
    return sigmoid(out)


def gradients(text: np.ndarray, label: float, w: Weights, g: Weights) -> None:
    """Add one text's gradient of the log loss to ``g``."""
    codes = np.concatenate([text, REACH])
    seen = windows(codes, w)
    answers = seen @ w["filters"]
    answers[-1] = -np.inf
    answers = answers.reshape(-1, BLOCK // STEP, FILTERS)
    place = answers.argmax(axis=1)
    peaks = np.take_along_axis(answers, place[:, None], axis=1)[:, 0]
    n = len(peaks)
    own = np.arange(max(1, n - 1))[:, None]
    # The block in which each chunk has its peak.
    block = own + (peaks[1:] > peaks[:-1]) if n > 1 else np.zeros((1, FILTERS), np.int64)
    act = np.tanh(np.take_along_axis(peaks, block, axis=0) + w["bias"])
    best = act.argmax(axis=0)
    lanes = np.arange(FILTERS)
    features = np.concatenate([act.mean(axis=0), act[best, lanes]])
    wrong = sigmoid(features @ w["out"] + w["shift"][0]) - label
    g["out"] += wrong * features
    g["shift"] += wrong
    d = np.repeat(wrong * w["out"][None, :FILTERS] / len(act), len(act), axis=0)
    d[best, lanes] += wrong * w["out"][FILTERS:]
    d *= 1 - act**2
    g["bias"] += d.sum(axis=0)
    row = block * (BLOCK // STEP) + np.take_along_axis(place, block, axis=0)
    lane = np.broadcast_to(lanes, row.shape)
    hit, rows = np.unique(row, return_inverse=True)
    sparse = np.zeros((len(hit), FILTERS), np.float32)
    np.add.at(sparse, (rows.reshape(-1), lane.reshape(-1)), d.reshape(-1))
    g["filters"] += seen[hit].T @ sparse
    at = hit[:, None] * STEP + np.arange(WIDTH)
    np.add.at(g["embed"], codes[at], (sparse @ w["filters"].T).reshape(len(hit), WIDTH, DIM))


def train(texts: list[bytes], labels: list[int], seed: int = 7) -> Weights:
    """Weights fitted by Adam; both labels weigh as much as they occur in the sample."""
    if len(set(labels)) < 2:
        return {"constant": np.array(labels[0] if labels else 0.5, np.float64)}
    rng = np.random.default_rng(seed)
    shape = {"embed": (PAD + 1, DIM), "filters": (WIDTH * DIM, FILTERS), "bias": (FILTERS,), "out": (2 * FILTERS,), "shift": (1,)}
    size = {"embed": 0.5, "filters": 0.2, "bias": 0.0, "out": 0.1, "shift": 0.0}
    w = {k: (rng.standard_normal(s) * size[k]).astype(np.float32) for k, s in shape.items()}
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    codes, order = [padded(t) for t in texts], np.zeros(0, np.int64)
    for step in range(1, STEPS + 1):
        if len(order) < BATCH:
            order = np.concatenate([order, rng.permutation(len(texts))])
        chosen, order = order[:BATCH], order[BATCH:]
        g = {k: np.zeros_like(v) for k, v in w.items()}
        for j in chosen:
            gradients(codes[j], labels[j], w, g)
        rate = RATE * (1 - step / (STEPS + 1))
        for k in w:
            grad = g[k] / len(chosen)
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.99 * second[k] + 0.01 * grad * grad
            w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return w


def sample(docs: DataFrame, labels: DataFrame, target: str, most: int = SAMPLE, max_bytes: int = SAMPLE_BYTES) -> list[tuple[bytes, int]]:
    """About ``most`` labelled texts of each value of ``target`` outside the held-out fold, by a hash of the id, and no more
    than have ``max_bytes`` together (one at least)."""
    own = labels.where(F.col(target).isin(0, 1) & (remainder(F.col("doc_id"), FOLDS) != HELD))
    own = own.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("y")).distinct()
    share = {r["y"]: r["n"] for r in own.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not share:
        return []
    # All 64 bits of the hash are drawn from, with a bound for each label: close to ``most`` ids of each at any size.
    least, top = -(1 << 63), (1 << 63) - 1
    bound = F.coalesce(*(F.when(F.col("y") == y, F.lit(min(top, least + (most << 64) // n))) for y, n in share.items()))
    drawn = own.withColumn("draw", F.xxhash64("doc_id")).where(F.col("draw") <= bound)
    # About 2 * most ids are left: a bounded broadcast.  Their texts are written, one an id, in one pass over the documents.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(drawn), "doc_id")
    one = texts.groupBy("doc_id", "y", "draw").agg(F.min(F.struct(F.xxhash64("text").alias("tie"), "text")).alias("t"))
    found = materialise(one.select("doc_id", "y", "draw", "t.text", F.coalesce(F.octet_length("t.text"), F.lit(0)).alias("size")), "quality-sample")
    # Only ids and sizes come to the driver before any text does.
    chosen, held = set(), 0
    for r in sorted(found.select("draw", "doc_id", "y", "size").collect()):
        held += r["size"]
        if held > max_bytes and chosen:
            break
        chosen.add((r["doc_id"], r["y"]))
    if not chosen:
        return []
    ids = F.broadcast(docs.sparkSession.createDataFrame(sorted(chosen), "doc_id long, y int"))
    rows = found.join(ids, ["doc_id", "y"]).select("doc_id", "y", "text").collect()
    return [((r["text"] or "").encode(), r["y"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["y"]))]


def scorer(w: Weights):
    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts(list(utf8(texts)), w))

    return score


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality") -> Weights:
    drawn = sample(docs, labels, target)
    return train([t for t, _ in drawn], [y for _, y in drawn])


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    score = scorer(fit(docs, labels))
    held = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD, F.lit(False))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the threshold."""
    score = scorer(fit(docs, labels))
    rows = docs.select(F.struct("*").alias("d"), score(docs["text"]).alias("score"))
    return rows.where(F.col("score") >= THRESHOLD).select("d.*")
