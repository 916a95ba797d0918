"""Ranked lexical search by dense blocked matrix products.

The vocabulary is that of the items alone. One scan counts, per document, its terms and the occurrences of item
terms, and adds up document frequencies on the way; the counts are kept as sparse rows. A second scan turns rows into
tiles of DOC_TILE documents: for the item terms that occur in a tile, the matrix of integer impacts is multiplied with
the matrix of integer term weights in float64, one block of the vocabulary at a time. A block holds so few terms that
no partial sum reaches 2^53, so every product sum is exact; blocks are added as 64-bit integers. Each tile keeps
the ``k`` best documents of each item, ties by id included, so a task sends ``k`` rows per item however many
documents it has read; ranking meets them in two levels, first by salt.

Items go in blocks of ITEM_BYTES, each with a scan of its own: a block's vocabulary and weights, which every task
holds, are bounded by that. Terms are known by 64-bit hashes.

Defined cases: null texts and texts without letters and digits have no terms, count in no statistic and are never
found; a null document id comes after all others among equal scores; repeated documents are found as often as they
occur; equal items (id and text) count once, different texts under one id, or under none, are ranked each for itself;
items without terms, or without documents that score, give no rows; very long texts are read whole, in one piece;
columns of other names are not read; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, words

K = 10
# Saturation of repeats and share of length in thousandths and hundredths, and the scale of weights and impacts.
TERM_SCALE = 1000
IMPACT_SCALE = 1_000_000_000
LENGTH_SHARE = 90
LENGTH_FACTOR = 8
EXACT = 1 << 53
DOC_TILE = 512
TERM_TILE = 4096
ITEM_TILE = 512
ITEM_BYTES = 4 << 20
SLICE = 1 << 18
SALTS = 64

_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each term."""
    starts, ends = words.boundaries(_KIND[data], offsets)
    return words.run_hashes(_LOWER[data], starts, ends), words.owners(starts, offsets)


def item_matrix(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted vocabulary of some items, and its (item, term) pairs as two columns."""
    data, offsets = common.text_bytes(texts)
    hashes, owner = terms(data, offsets)
    vocabulary, term = np.unique(hashes, return_inverse=True)
    pairs = np.unique(np.stack([owner, term.reshape(-1)], axis=1), axis=0) if len(hashes) else np.zeros((0, 2), np.int64)
    return vocabulary, pairs[:, 0], pairs[:, 1]


SPARSE = "doc_id bigint, n bigint, term array<int>, tf array<bigint>, docs bigint, total bigint"


def _count(shared, out: pa.Schema):
    """Sparse rows of the documents that hold item terms; at the end of a task one row without length: how many
    documents hold each term, how many have terms, and how many terms they have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        holds, docs, total = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in batches:
            ids = batch.column(0)
            data, offsets = common.text_bytes(batch.column(1))
            for a, b in common.slices(offsets, SLICE):
                hashes, owner = terms(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                lengths = np.bincount(owner, minlength=b - a)
                docs += int((lengths > 0).sum())
                total += len(hashes)
                if not len(vocabulary) or not len(hashes):
                    continue
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                known = vocabulary[at] == hashes
                cell, tf = np.unique(owner[known] * len(vocabulary) + at[known], return_counts=True)
                doc, term = np.divmod(cell, len(vocabulary))
                holds += np.bincount(term, minlength=len(vocabulary))
                rows, first = np.unique(doc, return_index=True)
                edges = pa.array(np.append(first, len(cell)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(edges, pa.array(v)) for v in (term.astype(np.int32), tf.astype(np.int64))]
                nothing = pa.nulls(len(rows), pa.int64())
                yield common.batch(out, [ids.take(pa.array(rows + a)), pa.array(lengths[rows]), *lists, nothing, nothing])
        held = np.flatnonzero(holds)
        yield common.batch(out, [[None], [None], [held.astype(np.int32)], [holds[held]], [docs], [total]])
    return run


def weights(holding: np.ndarray, docs: int) -> np.ndarray:
    """Integer weight of each term from the number of documents that hold it."""
    return np.array([math.floor(TERM_SCALE * math.log((2 * docs + 2) / (2 * df + 1))) for df in holding.tolist()], np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """Integer impact of ``tf`` occurrences in a document of ``n`` terms."""
    if len(n) and LENGTH_SHARE * int(n.max()) * docs >= 1 << 63:
        share = np.array([LENGTH_SHARE * x * docs // total for x in n.tolist()], np.int64)
    else:
        share = LENGTH_SHARE * n * docs // max(1, total)
    return IMPACT_SCALE * tf // (TERM_SCALE * tf + LENGTH_FACTOR * (100 - LENGTH_SHARE + share))


def blocked_product(item_weights: np.ndarray, tile: np.ndarray, largest: int) -> np.ndarray:
    """Exact integer product of float64 matrices of whole numbers: the inner side is cut so that no sum of a block
    reaches 2^53, where ``largest`` bounds a single product."""
    width = max(1, min(TERM_TILE, (EXACT - 1) // max(1, largest)))
    out = np.zeros((item_weights.shape[0], tile.shape[1]), np.int64)
    for a in range(0, tile.shape[0], width):
        out += (item_weights[:, a:a + width] @ tile[a:a + width]).astype(np.int64)
    return out


class Best:
    """The k best documents of each item: highest score, then smallest id (a null one last)."""

    def __init__(self, items: int, k: int):
        self.k, self.score = k, np.zeros((items, 0), np.int64)
        self.doc = np.zeros((items, 0), np.int64)
        self.nameless = np.zeros((items, 0), bool)

    def add(self, first: int, score: np.ndarray, doc: np.ndarray, nameless: np.ndarray) -> None:
        """Scores of a tile for the items from ``first`` on. A document that only ties with the last place so far still
        competes by its id."""
        last = self.score[first:first + len(score)]
        least = last[:, -1] if last.shape[1] == self.k else np.zeros(len(score), np.int64)
        live = np.flatnonzero(((score >= least[:, None]) & (score > 0)).any(axis=1))
        for i in live:
            at = np.flatnonzero((score[i] >= max(1, least[i])))
            if len(at) > 4 * self.k:  # all that reach the k-th highest, ties included
                floor = np.partition(score[i, at], len(at) - self.k)[len(at) - self.k]
                at = at[score[i, at] >= floor]
            row = first + i
            held = self.score[row] > 0
            own = [np.concatenate([x[row][held], y[at]]) for x, y in (
                (self.score, score[i]), (self.doc, doc), (self.nameless, nameless))]
            order = np.lexsort((own[1], own[2], -own[0]))[:self.k]
            if self.score.shape[1] < self.k:
                grow = self.k - self.score.shape[1]
                self.score, self.doc, self.nameless = (
                    np.pad(x, ((0, 0), (0, grow))) for x in (self.score, self.doc, self.nameless))
            for target, values in zip((self.score, self.doc, self.nameless), own):
                target[row] = 0
                target[row, :len(order)] = values[order]

    def rows(self) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        item, at = np.nonzero(self.score > 0)
        doc = pa.array(self.doc[item, at], mask=self.nameless[item, at])
        return item, doc, self.score[item, at]


def _rank(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, owner, term, weight, docs, total = shared.value
        best = Best(items, k)
        by_item = np.searchsorted(owner, np.arange(0, items + ITEM_TILE, ITEM_TILE))
        highest = int(weight.max(initial=0)) * (IMPACT_SCALE // TERM_SCALE)
        for batch in batches:
            for a in range(0, batch.num_rows, DOC_TILE):
                rows = batch.slice(a, DOC_TILE)
                lists = rows.column(2)
                lengths = np.diff(lists.offsets.to_numpy())
                terms_, tf = lists.flatten().to_numpy(), rows.column(3).flatten().to_numpy()
                n = np.repeat(rows.column(1).to_numpy(), lengths)
                doc = np.repeat(np.arange(rows.num_rows), lengths)
                present, at = np.unique(terms_, return_inverse=True)
                tile = np.zeros((len(present), rows.num_rows))
                tile[at.reshape(-1), doc] = impacts(tf, n, docs, total)
                ids = rows.column(0)
                nameless = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                place = np.full(len(weight), -1)
                place[present] = np.arange(len(present))
                for number, (x, y) in enumerate(zip(by_item[:-1], by_item[1:])):
                    first = number * ITEM_TILE
                    matrix = np.zeros((min(ITEM_TILE, items - first), len(present)))
                    used = place[term[x:y]] >= 0
                    matrix[owner[x:y][used] - first, place[term[x:y][used]]] = weight[term[x:y][used]]
                    best.add(first, blocked_product(matrix, tile, highest), ids, nameless)
        item, doc, score = best.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int64)), doc, pa.array(score)], names=["item", "doc_id", "score"])
    return run


def _search_block(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """Ranked documents for the items of one block, rows (item_id, body)."""
    spark = docs.sparkSession
    vocabulary, owner, term = item_matrix(pa.array([r.body for r in rows], pa.string()))
    shared = spark.sparkContext.broadcast(vocabulary)
    counted = common.keep(common.map_arrow(docs, _count(shared, common.arrow_schema(SPARSE)), SPARSE), "lexical")
    tasks = counted.filter("n is null")
    sums = tasks.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("total"), F.lit(0)).alias("total")).first()
    # One row per term of a vocabulary that ITEM_BYTES bounds.
    each = tasks.select(F.explode(F.arrays_zip("term", "tf")).alias("x")).groupBy("x.term").agg(F.sum("x.tf").alias("df"))
    holding = np.zeros(len(vocabulary), np.int64)
    found = each.toArrow()
    holding[found.column("term").to_numpy()] = found.column("df").to_numpy()
    model = spark.sparkContext.broadcast((len(rows), owner, term, weights(holding, sums.docs), sums.docs, sums.total))
    sparse = counted.filter("n is not null").select("doc_id", "n", "term", "tf")
    best = common.map_arrow(sparse, _rank(model, k), "item bigint, doc_id bigint, score bigint")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = best.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    by_salt = F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))
    near = salted.withColumn("place", by_salt).filter(F.col("place") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    ranked = near.select("item", rank.alias("rank"), "doc_id", "score").filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"item bigint, item_id {rows[0].kind}")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, *, text: str = "text", k: int = K, item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """For each item the k highest-scoring documents with a score above 0: item_id, rank (from 1), doc_id, score."""
    kind = items.schema["item_id"].dataType.simpleString()
    asked = items.select("item_id", F.coalesce(F.col(text), F.lit("")).alias("body"), F.lit(kind).alias("kind")).distinct()
    size = asked.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-size // item_bytes))
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("body"))
    out = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for number in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("body"), F.lit(blocks)) == number).collect()
        if rows:
            found = _search_block(base, rows, k)
            # The answer of a block is small; it is written before the next block's scan takes its memory.
            out = out.union(found if blocks == 1 else common.keep(found, "lexical"))
    return out


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    return search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () r, doc_id, coalesce({_TERMS}, []) w FROM documents),
b AS (SELECT row_number() OVER () i, item_id, w
      FROM (SELECT DISTINCT item_id, text, coalesce({_TERMS}, []) w FROM benchmark)),
s AS (SELECT CAST(count(*) AS BIGINT) n_docs, CAST(sum(len(w)) AS BIGINT) n_terms FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT i, unnest(w) t FROM b),
tf AS (SELECT r, t, count(*) tf FROM (SELECT r, unnest(w) t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
wt AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) w
       FROM tf, s GROUP BY t),
sc AS (SELECT i, r, sum(CAST(wt.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(d.w) * n_docs) // n_terms))) AS BIGINT)) score
       FROM q JOIN tf USING (t) JOIN wt USING (t) JOIN d USING (r), s GROUP BY i, r),
k AS (SELECT i, r, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) p
      FROM sc JOIN d USING (r) WHERE score > 0)
SELECT item_id, CAST(p AS INTEGER) AS "rank", doc_id, CAST(score AS BIGINT) score FROM k JOIN b USING (i) WHERE p <= 10
"""
