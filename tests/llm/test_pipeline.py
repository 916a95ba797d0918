"""The pipeline's stages one after the other against what each promises."""

import os

import pytest

import corpus_pipeline
from basketry.llm import common

from .test_brute_force import base_spans, linked

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def test_stages(spark):
    docs = common.table(spark, FOLDER, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]

    def run(name, rows):
        return common.keep(stages[name](spark, rows, FOLDER), name)

    known = run("language", docs)
    assert sorted(r["doc_id"] for r in known.collect()) == sorted(
        r["doc_id"] for r in docs.collect() if any(map(str.isalpha, r["text"] or "")))
    single = run("near_duplicates", known)
    rows = sorted((r["doc_id"], r["text"]) for r in known.collect())
    roots = {root for _, root in linked([t for _, t in rows], 5, 80, 100)}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(rows[i][0] for i in roots)
    clean = run("decontamination", single)
    assert clean.columns == docs.columns and 0 < clean.count() < single.count()
    masked = run("personal_data", clean)
    assert masked.count() == clean.count() and masked.columns == docs.columns
    for r in masked.collect():
        assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"])
    pieces = run("packing", masked)
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in masked.collect()}


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_run_over_odd_rows(spark, edges):
    """Nulls, empty and long texts, repeats, near copies, rows without id and clashing columns, through all stages."""
    folder = common.shared_dir(spark, "odd")
    edges.write.parquet(f"{folder}/documents.parquet")
    items = [(1, "an item that occurs nowhere"), (None, None), (2, "")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    pieces = corpus_pipeline.run(spark, folder).collect()
    whole = {p["doc_id"]: p["doc_tokens"] for p in pieces}
    assert set(whole) == {5, 6, 8, 10, 11, 12, None}
    for doc_id, tokens in whole.items():
        assert sum(p["length"] for p in pieces if p["doc_id"] == doc_id) == tokens
    again = corpus_pipeline.run(spark, folder).collect()
    assert {p["doc_id"]: p["doc_tokens"] for p in again} == whole


def test_no_rows(spark):
    rows = common.table(spark, FOLDER, "documents").filter("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        rows = common.keep(stage(spark, rows, FOLDER), "empty")
        assert rows.count() == 0
