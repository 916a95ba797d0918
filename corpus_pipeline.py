"""From raw documents to packed training sequences, stage by stage.

Each stage works on all rows that the one before it kept; rows travel through Parquet in the shared folder, so a lost
executor or a stopped run costs one stage at most. All but the last return the columns of ``documents``.

Defined cases are those of the operators: null and empty texts have no letter and go with the first stage; of repeated
rows, as of all copies, one stays; of the documents of a group the one with the smallest id stays, then the one with the
smallest hash of its text, and one without id after all others; very long texts are read whole and cut by the packing
alone; other columns, whatever their names, travel with their row up to the packing, which gives its own; an empty table
passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import common, decontaminate, langid, ngram_join, pack_slack, pii


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language; the model is learned from the stage's own input."""
    return langid.recognised(docs, langid.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component linked by five-word shingles at a similarity of 0.8."""
    return ngram_join.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty belongs to benchmark windows."""
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    return pii.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return pack_slack.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Machine learning, graph components and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = common.keep(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return rows
