"""The registered queries over whole small tables: against SQL, brute force, or held-out accuracy."""

import collections
import importlib.util
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

from regloom.llm import quality_cnn
from regloom.llm.queries import ORACLE, QUERIES, tokenizer_path
from test_edges import shingles, simhash, similarity

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "labels", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(ORACLE))
def test_against_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    found = duck.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    expected = collections.Counter(tuple(map(str, r)) for r in found.fetchall())
    assert sorted(names) == sorted(got.columns)
    assert collections.Counter(tuple(map(str, r)) for r in got.select(*names).collect()) == expected


def test_contamination_against_brute_force(spark, duck):
    """Every window of an item's length in every document, those cut at the text's ends included."""
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    grams = [(i, (t or "").lower().split(), shingles((t or "").lower().split(), 5)) for i, t in items]
    where = collections.defaultdict(set)
    for at, (_, _, own) in enumerate(grams):
        for gram in own:
            where[gram].add(at)
    best = {}
    for doc_id, text in duck.execute("SELECT doc_id, text FROM documents").fetchall():
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
        # A window without any shared shingle has no similarity at all.
        for at in {a for p in range(len(words) - 4) for a in where.get(tuple(words[p : p + 5]), ())}:
            item, own, weights = grams[at]
            for p in range(1 - len(own), len(words)):
                s = similarity(shingles(words[max(0, p) : p + len(own)], 5), weights)
                if s >= 0.8:
                    best[doc_id, item] = max(s, best.get((doc_id, item), 0))
    got = {(r.doc_id, r.item_id): r.similarity for r in QUERIES["op1_decontaminate"](spark, SF).collect()}
    assert best and got.keys() == best.keys()
    assert all(abs(got[k] - best[k]) < 1e-9 for k in best)


def test_simhash_over_the_table(spark, duck):
    prints = {i: simhash(t) for i, t in duck.execute("SELECT doc_id, text FROM documents WHERE doc_id < 300").fetchall()}
    got = {r.doc_id: r for r in QUERIES["op3_simhash"](spark, SF).collect()}
    assert all(int(got[i].fingerprint, 16) == x for i, x in prints.items())
    ids = np.array(sorted(got))
    x = np.array([int(got[i].fingerprint, 16) for i in ids], np.uint64)
    a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3)
    least = ids.copy()
    for _ in range(50):
        np.minimum.at(least, a, least[b])
    assert [got[i].component_id for i in ids] == least.tolist()


def test_language_model_beats_word_counts(spark):
    rows = QUERIES["op7_lm"](spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held) * 0.9


def test_language_held_out(spark, duck):
    lang = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = [r for r in QUERIES["op9_langid"](spark, SF).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows]) > 0.97


def test_quality_held_out(spark, duck):
    label = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    rows = [r for r in QUERIES["op10_quality"](spark, SF).collect() if r.held_out and r.doc_id in label]
    good = [r.predicted for r in rows if label[r.doc_id] == 1]
    bad = [r.predicted for r in rows if label[r.doc_id] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.4


def test_pipeline_against_brute_force(spark):
    """Each stage once more in plain Python, on all its predecessor kept."""
    spec = importlib.util.spec_from_file_location("corpus_pipeline", ROOT / "corpus_pipeline.py")
    pipeline = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(pipeline)
    assert [name for name, _ in pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "pack"]
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    model = quality_cnn.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = quality_cnn.score_texts([t.encode() for _, t in rows], model)
    rows = [r for r, s in zip(rows, scores, strict=True) if s >= quality_cnn.THRESHOLD]

    first = {}
    for i, t in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", t)
        first[bare] = min(first.get(bare, (-len(t), i, t)), (-len(t), i, t))
    rows = sorted((i, t) for _, i, t in first.values())

    label = {i: i for i, _ in rows}
    prints = [(i, simhash(t)) for i, t in rows]
    for _ in range(5):
        for i, x in prints:
            for j, y in prints:
                if (x ^ y).bit_count() <= 3:
                    label[i] = label[j] = min(label[i], label[j])
    rows = [(i, t) for i, t in rows if label[i] == i]

    items = [(r.text or "").lower().split() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = []
    for i, t in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t.lower()) if w]
        known = {tuple(words[p : p + 5]) for p in range(len(words) - 4)}
        near = [own for own in items if known & set(shingles(own, 5))]
        if not any(similarity(shingles(words[max(0, p) : p + len(own)], 5), shingles(own, 5)) >= 0.8 for own in near for p in range(1 - len(own), len(words))):
            clean.append((i, t))

    encoder = Tokenizer.from_file(tokenizer_path())
    expected = set()
    for i, t in clean:
        ids = np.array(encoder.encode(t, add_special_tokens=False).ids + [2], "<u4")
        expected |= {(i, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes()), len(ids)) for s in range(0, len(ids), 4096)}
    got = pipeline.run(spark, SMALL).collect()
    assert {(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got} == expected and len(got) == len(expected)
    assert len(clean) < len(rows) or not items


def test_stages_keep_the_columns(spark):
    spec = importlib.util.spec_from_file_location("corpus_pipeline", ROOT / "corpus_pipeline.py")
    pipeline = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(pipeline)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).schema == docs.schema


