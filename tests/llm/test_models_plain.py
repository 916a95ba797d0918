"""Trained operators against slow plain versions: features counted in dictionaries, one text and one entry at a time,
with the weights of a model that was fitted on a small sample."""

import math
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import langid, quality, toxicity, words

from .conftest import prose

WORD = (1 << 64) - 1
SHORT = (1 << 32) - 1


def mixed(h):
    h ^= h >> 30
    h = h * words.MIX[0] & WORD
    h ^= h >> 27
    h = h * words.MIX[1] & WORD
    return h ^ h >> 31


def word_hash(raw):
    h = sum((b + 1) * pow(words.ROOT, k, 1 << 64) for k, b in enumerate(raw)) + len(raw) * words.MIX[0]
    return mixed(h & WORD)


# --- language


def plain_grams(text):
    """Numbers of all n-grams of the letters of a text."""
    raw, low, out = text.encode(), [], []
    for i, b in enumerate(raw):
        c = b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
        if 0x80 <= c <= 0x9E and low and raw[i - 1] == 0xC3:
            c += 32
        low.append(c)
    single = [c for i, c in enumerate(low) if not (c == 32 and i and low[i - 1] == 32)]
    for order in langid.ORDERS:
        for i in range(len(single) - order + 1):
            code = order
            for c in single[i:i + order]:
                code = (code * 0x01000193 + c) & SHORT
            out.append((code * 0x9E3779B1 & SHORT) >> (32 - langid.BITS))
    return out


def plain_language(model, text):
    if not any(unicodedata.category(c).startswith("L") for c in text or ""):
        return "und", 0.0
    grams = plain_grams(text)
    margins = [float(b) for b in model.bias]
    for m in range(len(margins)):
        margins[m] += sum(float(model.table[g, m]) for g in grams) / max(1, len(grams))
    sure = [1 / (1 + math.exp(-2 * x)) for x in margins]
    families = model.families
    share = [s / sum(sure[:len(families)]) for s in sure[:len(families)]] if len(families) > 1 else [1.0]
    best = max(range(len(families)), key=lambda i: (share[i], -i))
    group = [x for x in model.languages if langid.family(x) == families[best]]
    votes = dict.fromkeys(group, 0.0)
    for k, (a, b) in enumerate(model.pairs):
        if langid.family(a) == families[best]:
            votes[a] += sure[len(families) + k]
            votes[b] += 1 - sure[len(families) + k]
    name = max(group, key=lambda x: (votes[x], -group.index(x)))
    return name, share[best] * (votes[name] / (len(group) - 1) if len(group) > 1 else 1.0)


TEXTS = ["The cat sat on the mat", "Der Hund läuft über die Straße", "Le chat ÉTAIT   là", "El niño come", "ÀÉ", "", None,
         "123 ...", "日本語", "  the  ", "a", prose(4, 300)]


def test_language_scores(spark):
    rows = [(i, lang, f"{text} {prose(i, 5)}") for i, (lang, text) in enumerate(
        [("en", "the quick brown fox and the dog"), ("de", "der schnelle braune Fuchs und der Hund"),
         ("fr", "le renard brun rapide et le chien"), ("es", "el zorro marron rapido y el perro")] * 12)]
    rows += [(5, "en", "another text of one id"), (6, None, "no language"), (7, "en", None)]
    labelled = spark.createDataFrame(rows, "id bigint, lang string, text string").repartition(3)
    model = langid.fit(labelled)
    assert model.languages == ["de", "en", "es", "fr"] and len(model.pairs) == 2
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").repartition(2)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    for i, text in enumerate(TEXTS):
        name, score = plain_language(model, text)
        assert got[i][0] == name and got[i][1] == pytest.approx(score, abs=1e-5), text


def test_language_sample_does_not_depend_on_partitions(spark):
    rows = [(i % 40, "en" if i % 2 else "de", prose(i, 30)) for i in range(120)]
    labelled = spark.createDataFrame(rows, "id bigint, lang string, text string")
    tables = [langid.fit(labelled.repartition(n), per_language=10).table for n in (1, 7)]
    assert np.array_equal(*tables)


def test_language_sample_is_bounded_and_keeps_all_languages(spark):
    rows = [(i, f"x{i % 30:02d}", prose(i, 10)) for i in range(300)]
    model = langid.fit(spark.createDataFrame(rows, "id bigint, lang string, text string"), most=40)
    assert model.languages == [f"x{i:02d}" for i in range(30)]
    assert langid.fit(spark.createDataFrame([], "id bigint, lang string, text string")).languages == []


# --- quality


def plain_quality(weights, text):
    raw, tokens, at = (text or "").encode(), [], 0
    while at < len(raw):
        kind, end = quality.KIND[raw[at]], at
        while end < len(raw) and quality.KIND[raw[end]] == kind:
            end += 1
        if kind:
            tokens.append(raw[at:end])
        at = end
    hashes = [word_hash(bytes(quality.LOWER[b] for b in t)) for t in tokens]
    found = list(hashes)
    for i, (t, h) in enumerate(zip(tokens, hashes)):
        if i:
            same = hashes[i - 1] == h
            found.append(int(quality.REPEAT) if same else mixed((hashes[i - 1] * words.ROOT + h) & WORD))
        if i > 1 and hashes[i - 2] == h:
            found.append(int(quality.ECHO))
        if sum(65 <= b <= 90 for b in t) >= 2 and not any(97 <= b <= 122 for b in t):
            found.append(int(quality.CAPITALS))
    dot = sum(float(weights[mixed(h) >> (64 - quality.BITS)]) for h in found)
    margin = dot * quality.SCALE / max(1, len(tokens)) + float(weights[-1])
    return 1 / (1 + math.exp(-margin))


def marked(spark, column):
    def text(i):
        bad = ["WIN", "cash cash", "clicky", "now!!!"] if i % 3 == 0 else ["calm", "harbour", "sentence", "made."]
        own = prose(i, 14).split()
        for k, word in enumerate(bad):
            own.insert((i * 7 + 3 * k) % len(own), word)
        return " ".join(own)

    rows = [(i, text(i), int((i % 3 == 0) == (column == "toxic"))) for i in range(240)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(4, "one more text of an id")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], f"doc_id bigint, {column} int")
    return docs.repartition(3), labels


MIXED = ["a calm sentence", "WIN cash cash NOW", "", None, "x", "é É 12 34 !!", "word " * 500, "A-B c d c d C D",
         "cl1cky c4sh here", "harbour CLICKY"]


def test_quality_scores(spark):
    docs, labels = marked(spark, "quality")
    weights = quality.fit(docs, labels)
    assert np.count_nonzero(weights) > 10
    rows = spark.createDataFrame(list(enumerate(MIXED)), "doc_id bigint, text string").repartition(2)
    got = {r.doc_id: r.score for r in quality.score(rows, weights).collect()}
    for i, text in enumerate(MIXED):
        assert got[i] == pytest.approx(plain_quality(weights, text), abs=1e-6), text


# --- toxicity


def plain_toxicity(lexicon, text):
    norm = toxicity.fold(text)
    hits = 0.0
    for table, sign in ((lexicon.entries, 1), (lexicon.exceptions, -1)):
        for key, weight in table.items():
            hits += sign * weight * sum(norm.startswith(key, at) for at in range(len(norm)))
    hits = max(0.0, hits)
    count = max(1, len(norm.split()))
    x = lexicon.curve[0] + lexicon.curve[1] * math.log1p(hits) + lexicon.curve[2] * math.log1p(100 * hits / count)
    return 1 / (1 + math.exp(-x))


def test_toxicity_scores(spark):
    docs, labels = marked(spark, "toxic")
    lexicon = toxicity.fit(docs, labels)
    assert lexicon.entries
    rows = spark.createDataFrame(list(enumerate(MIXED)), "doc_id bigint, text string").repartition(2)
    got = {r.doc_id: r.score for r in toxicity.score(rows, lexicon).collect()}
    for i, text in enumerate(MIXED):
        assert got[i] == pytest.approx(plain_toxicity(lexicon, text), abs=1e-9), text
    assert got[3] == got[2] < got[8]


def test_toxicity_learns_one_text_of_an_id(spark):
    docs, labels = marked(spark, "toxic")
    again = docs.unionByName(docs.filter("doc_id < 30")).unionByName(
        spark.range(200).select(F.lit(1).cast("bigint").alias("doc_id"), F.concat(F.lit("zz extra "), "id").alias("text")))
    one, two = toxicity.fit(docs, labels), toxicity.fit(again, labels)
    assert not any("zz" in e for e in two.entries) and set(one.entries) == set(two.entries)
