"""Cases in which an operator once did less than the whole job."""

import numpy as np

from basketry.llm import decontaminate, langid, ngram_join, pii, quality


def test_every_language_is_learned(spark):
    rows = [(i, f"x{i:03d}", f"text {i} of language {chr(97 + i % 26) * 5}") for i in range(203)]
    model = langid.fit(spark.createDataFrame(rows, "id bigint, lang string, text string"))
    assert len(model.languages) == 203


def test_texts_stay_where_no_language_can_be_learned(spark):
    rows = [(1, "some text"), (2, "日本語"), (3, "12 --"), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, None) for i, t in rows], "doc_id bigint, text string, lang string")
    assert sorted(r["doc_id"] for r in langid.recognised(docs, langid.learn(docs)).collect()) == [1, 2]


def test_items_without_id_count_as_hits(spark):
    tests = spark.createDataFrame([(None, "alpha beta"), (7, "gamma")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "an alpha beta gamma"), (2, "alpha beta")], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in decontaminate.contamination(docs, tests).collect()}
    assert [(found[i]["n_hit"], found[i]["items"], found[i]["contaminated"]) for i in (1, 2)] == [
        (3, ["7"], True), (2, [], True)]
    assert decontaminate.clean(docs, tests).count() == 0


def test_one_document_of_each_component(spark):
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join([*base, f"end{i}"]) for i in range(4)]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (None, "o " + texts[3]), (5, ""), (6, None),
            *((None, " ".join([f"v{i}" for i in range(100)] + [f"end{k}"])) for k in range(3))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = ngram_join.first_of_each(docs).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "5", "6", "None"]
    assert [r["text"][:2] for r in kept if r["doc_id"] is None] == ["v0"]


def test_repeated_ids_do_not_enlarge_the_sample(spark, monkeypatch):
    learned = []
    plain = quality.Follower.step
    monkeypatch.setattr(quality.Follower, "step", lambda self, *row: (learned.append(1), plain(self, *row)))
    rows = [(i, f"some text {i}") for i in range(1, 9)] + [(i, f"other text {k}") for k in range(30) for i in (1, 2, 3, 4)]
    marks = [(i, i % 2) for i in range(1, 9)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    known = quality.sample(labels, "quality", 100).count()
    weights = [quality.fit(spark.createDataFrame(r, "doc_id bigint, text string"), labels) for r in (rows, rows[::-1])]
    assert known > 0 and len(learned) == 2 * quality.PASSES * known
    assert np.array_equal(*weights)


def test_accounts_before_words_in_capitals(spark):
    accounts = ["BE68 5390 0754 7034", "BE68539007547034", "AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332",
                "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"]
    texts = [f"to {a}{rest}" for a in accounts for rest in ("", " IS", " EUR", " NOTE", " 1234 it", ", x")]
    texts += ["BE68 5390 0754 7035 IS", "BE68 5390 0754 7034X"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: [s["text"] for s in r["spans"] if s["kind"] == "iban"] for r in pii.detect(docs).collect()}
    assert [found[i] for i in range(len(texts))] == [[a] for a in accounts for _ in range(6)] + [[], []]
