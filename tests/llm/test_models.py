"""Held-out accuracy of the trained operators, and the queries over the smallest tables."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from basketry.llm import common, langid, queries, toxicity

FOLDER, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def accuracy(rows, got, want):
    rows = rows.filter("held_out").select((F.col(got) == F.col(want)).alias("right")).collect()
    return sum(r["right"] for r in rows) / len(rows)


def test_language(spark):
    found = langid.op1_langid(spark, FOLDER)
    assert accuracy(found.join(common.table(spark, FOLDER, "documents"), "doc_id"), "lang_pred", "lang") > 0.97
    assert found.filter("score < 0 or score > 1").count() == 0


@pytest.mark.parametrize("name, label", [("op8_quality", "quality"), ("op10_toxicity", "toxic")])
def test_labels(spark, name, label):
    found = queries.QUERIES[name](spark, FOLDER)
    assert accuracy(found.join(common.table(spark, FOLDER, "labels"), "doc_id"), "predicted", label) > 0.93


def test_held_out_rows_are_not_learned_from(spark):
    docs = common.table(spark, SMALL, "documents").select("doc_id", "text", "lang")
    held_out = common.fold_of(F.col("doc_id")) == 0
    twisted = docs.withColumn("lang", F.when(held_out, F.lit("xx")).otherwise(F.col("lang")))
    assert "xx" not in langid.learn(twisted).languages


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon({toxicity.fold("moron"): 3.0, toxicity.fold("loser"): 2.0, " " + "vequ": 1.0},
                               {toxicity.fold("sore loser"): 2.0}, (-2.0, 2.0, 0.5))
    machine = lexicon.machine()
    clean = lexicon.score(machine, "a plain text")
    for text in ("you MORON!", "m0r0n", "mоrоn", "mörön.", "l0ser", "1oser", "lo$er", "vequiste"):
        assert lexicon.score(machine, text) > clean, text
    for text in ("oxymoronic", "a sore loser", "", None, "closer"):
        assert lexicon.score(machine, text) == clean, text
    assert lexicon.score(machine, "moron " * 2) > lexicon.score(machine, "moron " * 2 + "word " * 500)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
    import check_oracle

    ok, note = check_oracle.compare(spark, check_oracle.connect(SMALL), name, SMALL)
    assert ok, note
