"""Operators against plain Python over all pairs or all positions, and exact round trips."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import ann, decontaminate, ngram_join, pack_bestfit, pack_slack, pii, suffix_dedup, tokens
from basketry.llm.components import components
from basketry.llm.suffix_sort import common_prefixes, deep_shallow_order

from .conftest import prose


def frame(spark, texts, parts=3):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(parts)


# --- suffixes


def covered(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[p:p + length] for r in raw for p in range(len(r) - length + 1))
    out = []
    for r in raw:
        mask = np.zeros(len(r), bool)
        for p in range(len(r) - length + 1):
            if seen[r[p:p + length]] > 1:
                mask[p:p + length] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~mask])
        out.append((len(r), int(mask.sum()), hashlib.sha256(kept).hexdigest()))
    return out


def patchwork(seed, count):
    own = random.Random(seed)

    def noise(n):
        return "".join(own.choice("abcdé ") for _ in range(n))

    parts = [noise(300), noise(420), noise(800), noise(1500)]
    texts = [None, "", "x" * 399, "x" * 400, "x" * 401, "x" * 900, "ab" * 700]
    for _ in range(count):
        text = ""
        for _ in range(own.randint(1, 4)):
            part = own.choice(parts)
            cut = own.randint(0, len(part) - 1)
            text += noise(own.randint(0, 200)) + (part[cut:] if own.random() < 0.5 else part)
        texts.append(text)
    return texts + texts[10:13]


@pytest.mark.parametrize("group_rows", [suffix_dedup.GROUP_ROWS, 1])
def test_repeated_bytes(spark, group_rows):
    texts = patchwork(group_rows, 40)
    rows = suffix_dedup.remove_repeats(frame(spark, texts), group_rows=group_rows).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in rows}
    assert [got[i] for i in range(len(texts))] == covered(texts, 400)


def test_segments_of_long_texts(monkeypatch):
    data = np.frombuffer(random.Random(3).randbytes(5000), np.uint8)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    parts = list(suffix_dedup._segments(np.array([0, 5000]), 400))
    windows = [p for _, a, b in parts for p in range(a, b - 399)]
    assert windows == list(range(5000 - 399)) and len(data) == 5000


def test_deep_shallow_order():
    rng = np.random.default_rng(1)
    for _ in range(10):
        base = rng.integers(0, 3, (4, 300)).astype(np.uint8)
        rows = base[rng.integers(0, 4, 150)].copy()
        for i in range(0, 150, 2):
            rows[i, rng.integers(0, 300):] = rng.integers(0, 3)
        order = deep_shallow_order(rows)
        texts = [rows[i].tobytes() for i in order]
        assert texts == sorted(r.tobytes() for r in rows)
        for a, b, n in zip(texts, texts[1:], common_prefixes(rows, order)[1:]):
            assert a[:n] == b[:n] and a[n:n + 1] != b[n:n + 1] or a == b and n == 300


# --- shingles


def linked(texts, size, numerator, denominator):
    sets = []
    for t in texts:
        own = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        grams = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if len(own) >= size else {tuple(own)} - {()}
        sets.append(grams)
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and denominator * both >= numerator * (len(sets[i] | sets[j])):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_copies(seed, groups, size):
    own = random.Random(seed)
    texts = [None, "", " \n", "one two", "ONE two", "one two three four five"]
    for g in range(groups):
        base = [f"w{own.randrange(400)}" for _ in range(own.randint(20, 120))]
        passage = [f"p{i}" for i in range(30)]
        for _ in range(own.randint(1, size)):
            copy = list(base)
            for _ in range(own.randint(0, 5)):
                copy[own.randrange(len(copy))] = f"e{own.randrange(50)}"
            if own.random() < 0.3:
                at = own.randrange(len(copy))
                copy[at:at] = passage
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("size, numerator, list_rows", [(4, 85, 2048), (5, 80, 2048), (3, 60, 4)])
def test_components_of_links(spark, monkeypatch, size, numerator, list_rows):
    monkeypatch.setattr(ngram_join, "LIST_ROWS", list_rows)
    texts = near_copies(size, 25, 8)
    rows = ngram_join.link(frame(spark, texts), size=size, numerator=numerator, denominator=100).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert [got[i] for i in range(len(texts))] == linked(texts, size, numerator, 100)


def test_hot_lists_and_salted_hubs(spark, monkeypatch):
    """Blocks of long lists find the pairs that the first steps leave over."""
    monkeypatch.setattr(ngram_join, "HUB_ROWS", 2)
    monkeypatch.setattr(ngram_join, "WORTH", 0)  # no more than one round
    monkeypatch.setattr(ngram_join.Join, "star_pairs", lambda self, postings, roots, seed: self.inner_pairs())
    texts = near_copies(11, 4, 30)
    left = (np.array([5, 6, 7, 8]), (np.full(4, 50) << 32) + 1, np.array([1, 1, 2, -1]),
            np.zeros((4, 2), np.uint64), np.array([True, False, True, True]), np.zeros((4, ngram_join.BEFORE), np.int64))
    left[3][2] = ~np.uint64(0)
    pairs = {(int(a), int(b)) for x, y in ngram_join.list_pairs(left, None, 80, 100) for a, b in zip(x, y)}
    assert pairs == {(6, 7), (5, 8), (6, 8)}
    left[5][0, 0] = left[5][3, 1] = 99  # these two have met at a shingle before
    pairs = {(int(a), int(b)) for x, y in ngram_join.list_pairs(left, None, 80, 100) for a, b in zip(x, y)}
    assert pairs == {(6, 7), (6, 8)}
    rows = ngram_join.link(frame(spark, texts), size=4, numerator=85, denominator=100).collect()
    got = {r["doc_id"]: r["component_id"] for r in rows}
    assert [got[i] for i in range(len(texts))] == [c for _, c in linked(texts, 4, 85, 100)]


def test_lists_are_dealt_anew_after_a_join_on_their_key(spark):
    """Without an exchange of its own a list is cut in parts where that join turns into a broadcast at run time."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
            "spark.sql.adaptive.enabled": "true", "spark.sql.shuffle.partitions": "4"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 4000, 1, 8).selectExpr("id % 50 token", "id gid")
        join = object.__new__(ngram_join.Join)
        join.docs = rows
        asked = rows.groupBy("token").agg(F.min("gid").alias("low")).filter("low >= 0").select("token")
        dealt = join.dealt(rows.join(asked, "token", "left_semi"), [F.col("token")], [])

        assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()

        def starts(batches):  # a row for each run of equal tokens in a task
            last = None
            for batch in batches:
                for token in batch.column(0).to_pylist():
                    if token != last:
                        yield pa.RecordBatch.from_arrays([pa.array([token], pa.int64())], names=["token"])
                    last = token

        assert sorted(r.token for r in dealt.select("token").mapInArrow(starts, "token bigint").collect()) == list(range(50))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_earlier_shingles_are_shared_ones(spark):
    """What a posting carries are the last shared shingles in front of it, the nearest first."""
    own = random.Random(5)
    base = [f"w{own.randrange(10_000)}" for _ in range(80)]
    texts = [" ".join(base), " ".join([*base[:40], "new", *base[41:]]), " ".join(f"x{i}" for i in range(60))]
    join = ngram_join.Join(frame(spark, texts), "text", 4, 50, 100)
    lists, rows = {}, join.postings().collect()
    for row in sorted(rows, key=lambda r: r.place):
        lists.setdefault(row.gid, []).append(row)
    assert len(lists) == 2
    for own_rows in lists.values():
        tokens = [r.token for r in own_rows]
        assert len(tokens) > ngram_join.BEFORE
        assert [r.before for r in own_rows] == [tokens[max(0, i - ngram_join.BEFORE):i][::-1] for i in range(len(tokens))]


def test_few_pairs_are_left_of_a_large_group(spark, monkeypatch):
    own = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(400):
        words = list(base)
        for k in own.sample(range(150), own.choice([1, 2, 2, 3])):
            words[k] = f"x{i}n{k}"
        texts.append(" ".join(words))
    left, cross = [], ngram_join.Join.cross_pairs

    def counted(self, postings, places, roots):
        pairs = cross(self, postings, places, roots)
        left.append(pairs.count())
        return pairs

    monkeypatch.setattr(ngram_join.Join, "cross_pairs", counted)
    rows = ngram_join.link(frame(spark, texts), size=4, numerator=85, denominator=100).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert [got[i] for i in range(len(texts))] == linked(texts, 4, 85, 100)
    assert left[0] < len(texts)  # 5,259 when only the rounds of stars came before


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = rng.integers(0, 1 << 63, rng.integers(1, 400)).astype(np.uint64)
        b = np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 63, 20).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        assert ngram_join.differing(ngram_join.bitmap(a), ngram_join.bitmap(b)) <= len(np.setxor1d(a, b))


def test_graph_components(spark):
    own = random.Random(9)
    edges = [(own.randrange(300), own.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert got == {i: find(i) for i in root if find(i) != i}


# --- benchmark windows


def test_windows_and_original_spans(spark):
    items = [(1, "One two three four"), (2, "zwei"), (3, "über den Berg"), (4, "a b c d e f g h i j k l m n o")]
    texts = [
        "Say one, TWO; three-four five", "Zwei zweien zwei", "ist ÜBER den über DEN berg!", None, "",
        "x a b c d e f g h i j k l m y", "b c d e f g h i j k l m n", prose(5, 300) + " one two three four",
    ]
    tests = spark.createDataFrame(items, "item_id bigint, text string")

    def split(text):
        return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))

    for block in (1 << 20, 8):
        rows = decontaminate.contamination(frame(spark, texts), tests, block_bytes=block).collect()
        for r in rows:
            own, hit, names = split(texts[r["doc_id"]]), set(), set()
            for item, text in items:
                want = split(text)
                size = min(13, len(want))
                keys = {tuple(want[i:i + size]) for i in range(len(want) - size + 1)}
                at = [i for i in range(len(own) - size + 1) if tuple(own[i:i + size]) in keys]
                hit |= {i + k for i in at for k in range(size)}
                names |= {str(item)} if at else set()
            assert (r["n_words"], r["n_hit"], r["items"]) == (len(own), len(hit), sorted(names))
            assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(own))
            inside = [w for s in r["spans"] for w in split(texts[r["doc_id"]][s["begin"]:s["end"]])]
            assert inside == [own[i] for i in sorted(hit)]


# --- personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    found = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(int(p) for p in m.group().split(".")) > 255:
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), number, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def test_base_spans(spark):
    own = random.Random(6)
    alphabet = ["a", "b.c", "@", "x@y.z", "_", "-", " ", ".", "1", "25", "256", "1.2.3.4", "+1", "+49 (30) 555-0", "é",
                "4805 4762 0017 0562", "4805476200170562", "000", "日", "\n", "%", "999.1.1.1.1.1.1.1"]
    texts = [None, ""] + ["".join(own.choice(alphabet) for _ in range(own.randint(1, 40))) for _ in range(300)]
    texts += ["a" * 30_000, "1" * 30_000, "1." * 8_000, "a@" + "b." * 9_000, "+" + "1(" * 9_000, "1 " * 9_000]
    rows = pii.detect(frame(spark, texts)).select("doc_id", pii.listed(pii.F.filter(
        "spans", lambda s: s["kind_no"] < 4)).alias("base")).collect()
    for r in rows:
        assert [s for s in r["base"].split(",") if s] == base_spans(texts[r["doc_id"]])


def test_added_kinds_and_masks(spark):
    texts = ["my iban DE89 3704 0044 0532 0130 00, mail a@b.cd", "ref DE88 3704 0044 0532 0130 00",
             "ssn 123-45-6789", "part 123-45-6789", "ssn 000-45-6789", "call +49 (30) 1234-5678 now é x@y.zz"]
    rows = {r["doc_id"]: r for r in pii.detect(frame(spark, texts)).collect()}
    kinds = [[s["kind"] for s in rows[i]["spans"]] for i in range(len(texts))]
    assert kinds == [["iban", "email"], [], ["ssn"], [], [], ["phone", "email"]]
    assert all(texts[i][s["begin"]:s["end"]] == s["text"] for i in rows for s in rows[i]["spans"])
    masked = {r["doc_id"]: r["text"] for r in pii.redact(frame(spark, texts)).collect()}
    assert masked[5] == "call <PHONE> now é <EMAIL>" and masked[1] == texts[1]


# --- tokens and packing


def test_chunks_give_the_tokenizers_ids():
    coder = tokens.ChunkTokenizer(tokens.default_path())
    texts = ["a  b\t c\nd", "Ünï ß ΣΑΣ İx 's 123 don't", "日本 語　x", "x́ ́y", "<|endoftext|> a<|startoftext|>b",
             "", None, "ÀÉ. foo,, Bar!!-- x_y ab's ǅ ªº ŉ ḿ ı", prose(7, 400)]
    for _ in range(2):
        for text, ids in zip(texts, coder.encode(texts, 2)):
            want = coder.tokenizer.encode(text or "", add_special_tokens=False).ids
            assert ids.tolist() == want + [2]


@pytest.mark.parametrize("block", [2000, 1 << 22])
def test_packing_round_trips(spark, block):
    texts = [None, ""] + [prose(i, n) for i, n in enumerate([1, 3, 50, 400, 900, 3000, 50, 50, 700] * 4)]
    coder = tokens.ChunkTokenizer(tokens.default_path())
    ids = dict(enumerate(coder.encode(texts, 2)))
    docs = frame(spark, texts, 2)
    pieces = pack_slack.pack(docs, window=512, block_tokens=block).collect()
    for i, own in ids.items():
        at = 0
        for p in sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"]):
            part = own[at:at + p["length"]]
            assert (p["start"], p["doc_tokens"]) == (at, len(own))
            assert p["ids_crc32"] == zlib.crc32(part.astype("<u4").tobytes())
            at += p["length"]
        assert at == len(own)
    full = Counter()
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == full[p["sequence_id"]]
        full[p["sequence_id"]] += p["length"]
    assert all(n <= 512 and n & (n - 1) == 0 for n in full.values())  # nothing to pad
    back = {i: {} for i in ids}
    for m in pack_bestfit.matrices(docs, capacity=512, block_tokens=block).collect():
        row, places = np.frombuffer(m["ids"], "<u2"), np.frombuffer(m["position_ids"], "<u2")
        assert len(row) == len(places) == 512 and m["cu_seqlens"][-1] == m["n_tokens"]
        for i, start, a, b in zip(m["doc_ids"], m["starts"], m["cu_seqlens"], m["cu_seqlens"][1:]):
            back[i][start] = row[a:b]
            assert places[a:b].tolist() == list(range(b - a))
    for i, own in ids.items():
        assert np.concatenate([back[i][s] for s in sorted(back[i])]).tolist() == own.tolist()


def test_closest_sum():
    own = random.Random(8)
    for _ in range(200):
        counts = {own.randint(1, 40): own.randint(1, 4) for _ in range(own.randint(1, 6))}
        room = own.randint(0, 90)
        sums = {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1)}
        chosen = pack_slack.closest(counts, room)
        assert all(0 < c <= counts[n] for n, c in chosen.items())
        assert sum(n * c for n, c in chosen.items()) == max(s for s in sums if s <= room)


def test_best_fit_takes_the_least_room():
    own = random.Random(2)
    pieces = [(i, 0, own.randint(1, 60)) for i in range(300)]
    rows = pack_bestfit.best_fit(pieces, 64)
    rooms, want = [], 0
    for _, _, n in sorted(pieces, key=lambda p: -p[2]):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            want += 1
            rooms.append(64 - n)
    assert len(rows) == want and sorted(p for r in rows for p in r) == sorted(pieces)
    assert sorted(64 - sum(p[2] for p in r) for r in rows) == sorted(rooms)


# --- neighbours


def test_recall_and_ties(spark):
    rng = np.random.default_rng(12)
    base = rng.normal(size=(1500, 16)) + 3 * rng.normal(size=(12, 16))[rng.integers(0, 12, 1500)]
    vectors = np.concatenate([base, np.tile(base[7], (200, 1))]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4)
    got = {}
    for r in ann.nearest(table, table.filter("vec_id % 50 = 0 or vec_id = 7"), shard_rows=400).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    exact = vectors.astype(float)
    norms = np.linalg.norm(exact, axis=1)
    hits = total = 0
    for q, found in got.items():
        score = exact @ exact[q] / (norms * norms[q])
        score[q] = -9
        best = np.lexsort((np.arange(len(score)), -score))[:5]
        assert [r for r, _, _ in sorted(found)] == [1, 2, 3, 4, 5]
        assert all(abs(score[v] - s) < 1e-12 for _, v, s in found)
        hits, total = hits + len(set(best.tolist()) & {v for _, v, _ in found}), total + 5
    assert [v for _, v, _ in sorted(got[7])] == [1500, 1501, 1502, 1503, 1504]
    assert hits >= 0.95 * total
