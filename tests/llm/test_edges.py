"""Every operator on nulls, empty and long texts, repeats and clashing columns, and on an empty table."""

import pytest
from pyspark.sql import functions as F

from basketry.llm import (
    ann, decontaminate, langid, ngram_join, pack_bestfit, pack_slack, pii, quality, suffix_dedup, toxicity,
)


def ids(rows):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)


def benchmark(spark):
    rows = [(1, "alpha beta"), (2, None), (None, "word"), (3, ""), (3, "nameless text"), (3, "nameless text")]
    return spark.createDataFrame(rows, "item_id bigint, text string").withColumn("row", F.lit(1))


def one_per_row(name, spark, docs, marks):
    if name == "langid":
        return langid.identify(docs, langid.learn(docs))
    if name == "pii":
        return pii.detect(docs.select("doc_id", "text"))
    if name == "decontaminate":
        return decontaminate.contamination(docs, benchmark(spark))
    if name == "ngram_join":
        return ngram_join.link(docs)
    if name == "suffix_dedup":
        return suffix_dedup.remove_repeats(docs)
    if name == "quality":
        return quality.score(docs, quality.fit(docs, marks))
    return toxicity.score(docs, toxicity.fit(docs, marks))


NAMES = ["langid", "pii", "decontaminate", "ngram_join", "suffix_dedup", "quality", "toxicity"]


@pytest.mark.parametrize("name", NAMES)
def test_every_row_has_a_result(name, spark, edges, edge_rows, marks):
    rows = one_per_row(name, spark, edges, marks).collect()
    assert len(rows) == len(edge_rows)
    assert ids(rows) == ids([{"doc_id": i} for i, _ in edge_rows])


@pytest.mark.parametrize("name", NAMES)
def test_no_rows(name, spark, no_docs, marks):
    assert one_per_row(name, spark, no_docs, marks).count() == 0


def test_packers_on_edges_and_no_rows(edges, no_docs, edge_rows):
    pieces = pack_slack.pack(edges).collect()
    assert {p["doc_id"] for p in pieces} == {i for i, _ in edge_rows}
    assert sum(p["length"] for p in pieces) == sum(p["doc_tokens"] for p in pieces if p["start"] == 0)
    matrices = pack_bestfit.matrices(edges).collect()
    assert sum(m["n_tokens"] for m in matrices) == sum(p["length"] for p in pieces)
    assert pack_slack.pack(no_docs).count() == 0 and pack_bestfit.matrices(no_docs).count() == 0


@pytest.mark.parametrize("keep", ["recognised", "clean", "first_of_each", "redact"])
def test_filters_keep_all_columns(keep, spark, edges, no_docs):
    def run(docs):
        if keep == "recognised":
            return langid.recognised(docs, langid.learn(docs))
        if keep == "clean":
            return decontaminate.clean(docs, benchmark(spark))
        return ngram_join.first_of_each(docs) if keep == "first_of_each" else pii.redact(docs)

    done = run(edges)
    assert done.columns == edges.columns
    assert 0 < done.count() <= edges.count()
    assert run(no_docs).count() == 0


def test_vectors_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]),
        (5, [float("inf"), 1.0]), (6, [0.5, 0.5]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 2.0, 3.0]),
        (None, [1.0, 1.0]), (9, [2.0, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("shard", F.lit("x"))
    found = ann.nearest(table, table.filter("vec_id = 0")).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in found] == [(1, 7), (2, 9), (3, 6)]
    none = table.filter("vec_id < 0")
    assert ann.nearest(none, none).count() == 0
