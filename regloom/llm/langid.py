"""Language identification in two levels: the family first, then one-versus-one linear machines within it.

Texts are counted as hashed byte trigrams of their letters, lower-cased, each a share of the text's trigrams.  A softmax
over families is fitted first; within each family a linear support vector machine is fitted for every pair of
languages, and the language with most votes wins, then the one with the greater margin.  Fitting takes a bounded sample
of labelled documents (about ``SAMPLE`` per language, fewer with more than ten languages, so that there are about ``SAMPLE_ROWS`` in all, by a
hash of the id, and twice as many at most where ids come again);
texts are counted whole, in slices, in the sample as in scoring, and only the sample's shares leave the tasks.

Defined cases: null texts and texts without a letter are `und` with score 0; documents with a null language do not
teach; a language in no family of the table is a family of its own; with one language there is nothing to tell apart
and it is always predicted, with none `und` is; rows with the same id are predicted one by one; a null id is not held
out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regloom.llm.common import remainder, utf8

FOLDS, HELD = 4, 2
SAMPLE = 600
SAMPLE_ROWS = 6000  # of all languages together, 64 KB each on the driver
BUCKETS = 1 << 14
SLICE = 1 << 20
# Families of common languages, by ISO 639-1 code.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "an ca co es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "indic": "bn gu hi kn mr ne pa si ur",
    "turkic": "az kk ky tk tr tt uz",
    "uralic": "et fi hu",
    "semitic": "ar he mt",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

# Letters of ASCII in lower case, bytes of other characters as they are, all else a blank.
CODES = np.full(256, 32, np.uint8)
CODES[97:123] = np.arange(97, 123)
CODES[65:91] = np.arange(97, 123)
CODES[128:] = np.arange(128, 256)


def trigrams(text: bytes) -> Iterator[np.ndarray]:
    """Buckets of a text's trigrams, a blank before and after it included, each trigram in one slice; those of blanks
    alone are left out."""
    whole = np.frombuffer(b" " + text + b" ", np.uint8)
    for i in range(0, len(whole) - 2, SLICE):
        data = CODES[whole[i : i + SLICE + 2]].astype(np.uint32)
        code = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
        code = code[(data[1:-1] != 32)]
        yield ((code * np.uint32(2654435761)) >> np.uint32(32 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def shares(text: bytes) -> np.ndarray:
    """The text's trigrams per bucket, scaled to unit length."""
    count = np.zeros(BUCKETS)
    for part in trigrams(text):
        count += np.bincount(part, minlength=BUCKETS)
    size = np.sqrt((count**2).sum())
    return (count / size if size else count).astype(np.float32)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_families(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Weights (bucket, family) of a softmax, by full-batch descent."""
    w = np.zeros((x.shape[1], n), np.float32)
    goal = np.eye(n, dtype=np.float32)[y]
    weight = (1 / np.bincount(y, minlength=n)[y] / n)[:, None].astype(np.float32)
    for step in range(150):
        w -= 40.0 / (1 + step / 50) * (x.T @ (weight * (softmax(x @ w) - goal)) + 1e-5 * w)
    return w


def fit_pair(x: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """A linear support vector machine: hinge loss, Pegasos steps over the whole sample."""
    w = np.zeros(x.shape[1], np.float32)
    weight = np.where(sign > 0, 0.5 / max(1, (sign > 0).sum()), 0.5 / max(1, (sign < 0).sum())).astype(np.float32)
    rate, loss = 1e-4, sign.astype(np.float32) * weight
    for step in range(1, 201):
        short = sign * (x @ w) < 1
        w = (1 - 1 / (step + 1)) * w + 1 / (rate * (step + 1)) * 0.05 * (x.T @ (loss * short))
    return w


class Model:
    """Families, and for each pair of languages of a family the weights that part them."""

    def __init__(self, x: np.ndarray, lang: list[str]):
        self.langs = sorted(set(lang))
        own = [FAMILY.get(code, code) for code in self.langs]
        self.families = sorted(set(own))
        family = np.array([self.families.index(f) for f in own], np.int64)
        y = np.array([self.langs.index(code) for code in lang], np.int64)
        self.members = [np.flatnonzero(family == f) for f in range(len(self.families))]
        self.pairs = [(int(a), int(b)) for m in self.members for a, b in combinations(m, 2)]
        columns = []
        if len(self.families) > 1:
            columns.append(fit_families(x, family[y], len(self.families)))
        for a, b in self.pairs:
            use = (y == a) | (y == b)
            columns.append(fit_pair(x[use], np.where(y[use] == a, 1.0, -1.0))[:, None])
        self.weights = np.concatenate(columns, axis=1).astype(np.float32) if columns else np.zeros((BUCKETS, 0), np.float32)

    def predict(self, text: bytes) -> tuple[str, float]:
        if len(self.langs) == 1:
            return self.langs[0], 1.0
        answers = shares(text) @ self.weights
        n = len(self.families) if len(self.families) > 1 else 0
        chance = softmax(answers[:n]) if n else np.ones(1)
        f = int(chance.argmax())
        votes, margin = {int(m): 0 for m in self.members[f]}, {int(m): 0.0 for m in self.members[f]}
        for (a, b), value in zip(self.pairs, answers[n:].tolist(), strict=True):
            if a in votes:
                votes[a if value >= 0 else b] += 1
                margin[a] += value
                margin[b] -= value
        best = max(votes, key=lambda m: (votes[m], margin[m], -m))
        sure = 1 / (1 + np.exp(-np.clip(margin[best], -30, 30))) if len(votes) > 1 else 1.0
        return self.langs[best], float(chance[f] * sure)


def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shares of whole texts, without those that are zero."""
    for batch in batches:
        found = [(np.flatnonzero(x).astype("<u2"), x) for x in map(shares, utf8(batch["text"]))]
        buckets = pa.array([at.tobytes() for at, _ in found], pa.binary())
        values = pa.array([x[at].astype("<f4").tobytes() for at, x in found], pa.binary())
        columns = [*(batch[c] for c in ("doc_id", "lang", "draw", "tie")), buckets, values]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "draw", "tie", "buckets", "values"])


def sample(docs: DataFrame, most: int = SAMPLE) -> tuple[np.ndarray, list[str]]:
    """Shares and language of about ``most`` documents of each language outside the held-out fold, by a hash of the id."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    own = own.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id"), FOLDS) != HELD))
    share = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not share:
        return np.zeros((0, BUCKETS), np.float32), []
    most = max(1, min(most, SAMPLE_ROWS // len(share)))
    least, top = -(1 << 63), (1 << 63) - 1
    bound = F.coalesce(*(F.when(F.col("lang") == k, F.lit(min(top, least + (most << 64) // n))) for k, n in share.items()))
    drawn = own.withColumn("draw", F.xxhash64("doc_id")).where(F.col("draw") <= bound).withColumn("tie", F.xxhash64("text"))
    schema = "doc_id long, lang string, draw long, tie long, buckets binary, values binary"
    taught = drawn.select("doc_id", "text", "lang", "draw", "tie").mapInArrow(teach, schema)
    # Each language has a bound of its own, applied in every task before rows meet.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "tie"))
    rows = taught.withColumn("place", place).where(F.col("place") <= 2 * most).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["lang"], r["tie"]))
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["buckets"], "<u2")] = np.frombuffer(r["values"], "<f4")
    return x, [r["lang"] for r in rows]


def fit(docs: DataFrame) -> Model | None:
    x, langs = sample(docs)
    return Model(x, langs) if langs else None


def predictor(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = batch["lettered"].to_pylist()
            found = [model.predict(t) if ok and model else ("und", 0.0) for t, ok in zip(utf8(batch["text"]), lettered, strict=True)]
            columns = [batch["doc_id"], batch["held_out"], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    held = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD, F.lit(False))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held_out"), lettered.alias("lettered"))
    return rows.mapInArrow(predictor(fit(docs)), "doc_id long, held_out boolean, lang_pred string, score double")
