"""The pipeline's stages on empty tables, and which of equal and similar rows stay."""

import importlib.util
from pathlib import Path

import pytest

from test_edges import prose

ROOT = Path(__file__).resolve().parents[2]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def pipeline():
    spec = importlib.util.spec_from_file_location("corpus_pipeline", ROOT / "corpus_pipeline.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def tables(spark, folder, rows, items=(), labels=()):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_empty_tables(spark, tmp_path, pipeline):
    folder = tables(spark, tmp_path, [])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.schema == docs.schema and found.count() == 0
    assert pipeline.run(spark, folder).count() == 0


def test_which_rows_stay(spark, tmp_path, pipeline):
    """Of equal texts the longest, then the smallest id; of similar ones the smallest id; items go, also with null ids."""
    base, other, item = prose(200, 1), prose(80, 2), prose(40, 3)
    near = " ".join([*base.split()[:-1], "end"])
    rows = [
        (5, base, "en", "s", 1), (3, base.replace(" ", "  "), "en", "s", 1), (9, base + " ", "en", "s", 1), (4, near, "en", "s", 1),
        (7, other, "en", "s", 1), (7, other, "en", "s", 2), (8, f"{prose(30, 4)} {item} {prose(30, 5)}", "en", "s", 1),
        (None, f"{prose(30, 6)} {item}", None, None, None), (None, prose(60, 7), None, None, None), (11, None, "en", "s", 0), (12, "", "en", "s", 0),
    ]
    folder = tables(spark, tmp_path, rows, [(1, item)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(pipeline.STAGES)
    # Without labels no document is rejected.
    assert stages["quality"](spark, docs, folder).count() == len(rows)
    exact = sorted((r.doc_id or 0, r.text or "") for r in stages["exact_dedup"](spark, docs, folder).collect())
    assert exact == sorted((i or 0, t) for i, t in [(3, base.replace(" ", "  ")), (4, near), (7, other), (8, rows[6][1]), (None, rows[7][1]), (None, rows[8][1]), (11, "")])
    clean = {(r.doc_id, r.text) for r in stages["decontaminate"](spark, docs, folder).collect()}
    assert clean == {r[:2] for r in rows if item not in (r[1] or "")}
    kept = stages["near_dedup"](spark, docs, folder).collect()
    ids = [r.doc_id for r in kept]
    assert 3 in ids and 5 not in ids and 9 not in ids and ids.count(7) == 1 and sum(r.text in (None, "") for r in kept) == 1
    packed = pipeline.run(spark, folder).collect()
    assert sorted({r.doc_id or 0 for r in packed}) == [0, 3, *([4] if 4 in ids else []), 7, 11]
