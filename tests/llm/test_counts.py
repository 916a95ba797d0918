"""Counts that learning rests on are those of the whole sample, however it is dealt out."""

import random

import pytest

from basketry.llm import common, toxicity


@pytest.fixture
def dealt(monkeypatch):
    """Kept tables are read back in so many partitions."""
    plain = common.keep

    def set_parts(parts):
        monkeypatch.setattr(common, "keep", lambda df, label: plain(df, label).repartition(parts))
    return set_parts


def marked(spark, toxic, clean):
    """Documents of random words with what their label adds."""
    own = random.Random(5)
    rows = [(words, 1) for words in toxic] + [(words, 0) for words in clean]
    texts = []
    for words, _ in rows:
        text = [f"{own.choice('bcdfg')}{own.choice('aeiou')}{own.choice('klmnp')}{own.choice('aeiou')}" for _ in range(12)]
        text[own.randrange(12)] += f" {words}"
        texts.append(" ".join(text))
    order = own.sample(range(len(rows)), len(rows))
    docs = spark.createDataFrame([(n, texts[i]) for n, i in enumerate(order)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(n, rows[i][1]) for n, i in enumerate(order)], "doc_id bigint, toxic int")
    return docs, labels


def test_lexicon_counts_clean_documents_of_all_tasks(spark, dealt):
    docs, labels = marked(spark, ["vulgar"] * 50 + ["harbour"] * 15, ["harbour"] * 100 + [""] * 335)
    found = []
    for parts in (1, 200):
        dealt(parts)
        found.append(toxicity.fit(docs, labels))
    assert found[0].entries == found[1].entries and found[0].curve == pytest.approx(found[1].curve)
    assert " vuigar " in found[0].entries and " harbour " not in found[0].entries


def test_exceptions_count_toxic_documents_of_all_tasks(spark, dealt):
    docs, labels = marked(spark, ["vulgar"] * 50 + ["vulgar harbour"] * 15, ["vulgar harbour"] * 5 + [""] * 430)
    dealt(200)
    found = toxicity.fit(docs, labels)
    assert " vuigar " in found.entries
    assert not [p for p in found.exceptions if "harbour" in p]
