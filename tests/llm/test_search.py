"""SimHash, hard negatives and ranked search against plain Python over all pairs, and on edge rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from basketry.llm import hard_negatives, lexical_search, simhash

from .conftest import prose

# --- fingerprints


def plain_print(text, size):
    words = (text or "").encode().lower().split()
    rows = [b" ".join(words[k:k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    ones = [sum(xxhash.xxh64_intdigest(r, 42) >> b & 1 for r in rows) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(rows))


def plain_components(prints, distance):
    root = list(range(len(prints)))
    for _ in prints:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= distance:
                    root[i] = root[j] = min(root[i], root[j])
    return root


def near_texts(seed, groups, copies):
    own, out = random.Random(seed), [None, "", " \n", "one", "Two Words", "two  words"]
    for g in range(groups):
        words = prose(seed + g, 120).split()
        for _ in range(copies):
            changed = list(words)
            for _ in range(own.randint(0, 2)):
                changed[own.randrange(len(changed))] = "changed"
            out.append(" ".join(changed))
    return out


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_simhash_components(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    texts = near_texts(5, 6, 9)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, size=3).collect()}
    prints = [plain_print(t, 3) for t in texts]
    roots = plain_components(prints, 3)
    assert got == {i: (f"{p:016x}", roots[i]) for i, p in enumerate(prints)}
    assert len(set(roots)) < len(texts)


def test_every_close_pair_shares_a_key():
    rng = random.Random(2)
    chosen = simhash.keys(3)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        shared = [(m, free) for m, free in chosen if (a ^ b) & m % (1 << 64) == 0]
        assert shared
        for m, free in shared:
            assert any((a ^ b) & (m | f) % (1 << 64) == 0 for f, _ in simhash.finer(free, 3))


def test_large_buckets_by_lookup(monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 10)
    rng = np.random.default_rng(4)
    free = [3, 7, 8, 20, 21, 22, 40, 41, 50, 60, 61, 62]
    values = np.unique(rng.integers(0, 1 << 12, 300))
    prints = np.array([sum((int(v) >> i & 1) << p for i, p in enumerate(free)) for v in values], np.uint64)
    for distance in (1, 2, 3):
        nodes, roots = simhash.spanning(prints, distance, free)
        direct_nodes, direct_roots = simhash.spanning(prints, distance)
        assert dict(zip(nodes.tolist(), roots.tolist())) == dict(zip(direct_nodes.tolist(), direct_roots.tolist()))


def test_long_texts_in_segments(monkeypatch):
    text = prose(8, 500)
    monkeypatch.setattr(simhash, "SEGMENT", 7)
    assert simhash.fingerprint(text.encode(), 5) == plain_print(text, 5)


def test_simhash_edges(spark, edges, edge_rows, no_docs):
    rows = simhash.near_duplicates(edges).collect()
    assert len(rows) == len(edge_rows)
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert of[1] == of[2] == of[3] == {("0" * 16, 1)}
    assert of[7] == {(next(iter(of[6]))[0], 6)}
    assert ("0" * 16, 1) in of[None]
    assert simhash.near_duplicates(no_docs).count() == 0


# --- hard negatives


def plain_negatives(rows, anchor, k=5, low=80, high=100):
    own = set()
    for i, vector, label in rows:
        ok = i is not None and label is not None and vector is not None and len(vector) == 3
        if ok and all(x is not None and math.isfinite(x) for x in vector):
            own.add((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    out = []
    for a in (r for r in own if anchor(r[0])):
        scored = [(-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in own if b != a]
        for p, pid, _ in sorted(x for x in scored if x[2] == a[1])[:k]:
            hits = sorted(x for x in scored if x[2] != a[1] and low * -p <= 100 * -x[0] <= high * -p)[:k]
            out += [(a[0], pid, n + 1, i, -p, -s) for n, (s, i, _) in enumerate(hits)]
    return Counter(out)


def vectors(seed, count):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 3))
    rows = []
    for i in range(count):
        vector = (centres[i % 6] + rng.normal(scale=0.1 if i % 3 else 1.0, size=3)).astype(np.float32)
        rows.append((i, [float(x) for x in vector], int(rng.integers(0, 3))))
    same = [float(x) for x in centres[0]]
    rows += [(1000 + i, same, i % 2) for i in range(40)]  # ties
    rows += [rows[0], rows[7], (7, [1.0, 1.0, 1.0], 1)]
    rows += [(2000, None, 1), (2001, [1.0, None, 1.0], 1), (2002, [1.0, float("nan"), 1.0], 1), (2003, [1.0, 2.0], 1),
             (2004, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (2005, [float("inf"), 1.0, 1.0], 1)]
    return rows


def mined(spark, rows, every, **options):
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    table = table.withColumns({c: F.lit("x") for c in ("id", "key", "block", "score", "row")})
    found = hard_negatives.mine(table, F.col("id") % every == 0, **options)
    return Counter(tuple(r) for r in found.collect())


@pytest.mark.parametrize("block_bytes", [hard_negatives.BLOCK_BYTES, 400])
def test_hard_negatives(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCKS", 1)
    rows = vectors(3, 240)
    want = plain_negatives(rows, lambda i: i % 8 == 0)
    assert sum(want.values()) > 50
    assert mined(spark, rows, 8) == want


def test_hard_negatives_beyond_float64(spark):
    rows = [(i, [3e30, float(i), 1.0], i % 2) for i in range(6)]
    found = mined(spark, rows, 5)
    assert {(a, p) for a, p, *_ in found} == {(0, 2), (0, 4), (5, 1), (5, 3)}
    assert all(s == hard_negatives.LIMIT for *_, s in found)
    assert sorted(n for a, p, _, n, _, _ in found if (a, p) == (0, 2)) == [1, 3, 5]


def test_no_vectors(spark):
    assert not mined(spark, [], 2)
    assert not mined(spark, [(0, [1.0, 2.0, 3.0], 1)], 2)


def test_curve_visits_neighbours():
    side = 8
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = hard_negatives.curve_keys(cells, 3)
    order = sorted(range(len(cells)), key=lambda i: keys[i].tobytes())
    steps = np.abs(np.diff(cells[order], axis=0)).sum(axis=1)
    assert (steps == 1).all() and len({k.tobytes() for k in keys}) == side ** 3


def test_bounds_hold_every_product():
    rng = np.random.default_rng(6)
    anchors, block = rng.integers(-90, 90, (20, 9)).astype(float), rng.integers(-90, 90, (50, 9)).astype(float)
    least, largest = hard_negatives.bounds(anchors, block.min(axis=0)[None], block.max(axis=0)[None])
    exact = hard_negatives.products(anchors, block)
    assert (least <= exact.min(axis=1)[:, None]).all() and (largest >= exact.max(axis=1)[:, None]).all()


@pytest.mark.parametrize("score", [-7, 0, 1, 99, 12_345, 10 ** 18])
def test_window(score):
    a, b = hard_negatives.window(score, 80, 100)
    assert 100 * (a - 1) < 80 * score <= 100 * a and 100 * b <= 100 * score < 100 * (b + 1)


# --- ranked search


def plain_search(docs, items, k=10):
    def terms(text):
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    total = sum(n for _, _, n in own)
    out = []
    for item, text in set(items):
        scored = []
        for doc_id, counts, n in own:
            score = 0
            for t in set(terms(text)) & counts.keys():
                df = sum(t in c for _, c, _ in own)
                weight = math.floor(1000 * math.log((2 * len(own) + 2) / (2 * df + 1)))
                m = 100 - 90 + 90 * n * len(own) // total
                score += weight * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return Counter(out)


ITEMS = [(1, "Alpha betas, gamma"), (2, "betas"), (2, "ZETAS zetas"), (2, "betas"), (None, "kappa mu"), (3, None),
         (4, "..."), (5, "unheard of"), (6, "日本語 word"), (7, "alpha alphas alphaing"), (8, "x" * 20_000)]


@pytest.mark.parametrize("item_bytes, tile", [(lexical_search.ITEM_BYTES, lexical_search.DOC_TILE), (20, 4)])
def test_ranked_search(spark, monkeypatch, edge_rows, item_bytes, tile):
    monkeypatch.setattr(lexical_search, "DOC_TILE", tile)
    own = random.Random(9)
    docs = edge_rows + [(100 + i, prose(i % 40, own.randint(1, 60))) for i in range(150)]
    docs += [(500 - i, "Betas zetas") for i in range(30)]  # ties by id
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    table = table.withColumns({c: F.lit("clash") for c in ("body", "term", "n", "score", "item")})
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("kind", F.lit("clash"))
    found = lexical_search.search(table, items, item_bytes=item_bytes).collect()
    assert Counter(tuple(r) for r in found) == plain_search(docs, ITEMS)


def test_search_on_no_rows(spark, no_docs, edges):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert lexical_search.search(no_docs, items).count() == 0
    assert lexical_search.search(edges, items.filter("item_id < 0")).count() == 0


def test_blocked_products_are_exact():
    rng = np.random.default_rng(7)
    a, b = rng.integers(0, 1 << 20, (4, 900)), rng.integers(0, 1 << 31, (900, 5))
    got = lexical_search.blocked_product(a.astype(float), b.astype(float), 1 << 51)
    assert (got == a.astype(object).dot(b.astype(object))).all()


def test_impacts_of_large_counts():
    tf, n = np.array([3, 5]), np.array([1 << 40, 7])
    docs, total = 1 << 37, 1 << 50
    want = [10 ** 9 * t // (1000 * t + 8 * (10 + 90 * m * docs // total)) for t, m in zip(tf.tolist(), n.tolist())]
    assert lexical_search.impacts(tf, n, docs, total).tolist() == want
