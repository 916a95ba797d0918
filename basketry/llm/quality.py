"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader steps.

Tokens are words (letters, digits, all bytes beyond ASCII) and runs of marks. Features are hashed: single tokens,
pairs of neighbours, signs for a token that repeats the one before or the one before that, and a sign for words in
capitals; values are shares of the text's tokens. A text's score is the sparse dot product of its features with the weights.

The labels are learned from at most TRAIN_ROWS labelled documents, those with the smallest hash of their id among
the rows that are not held out, in PASSES passes in a fixed order; of several texts of one id the one with the smallest
hash counts.

Defined cases: a null or empty text has no features and scores by the bias alone; of several labels of one id the
smallest counts, of several texts the one with the smallest hash is learned; without any label every score is 0.5, and
a score on the threshold counts as good; repeated rows are scored one by one, very long texts whole; columns of other
names are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, words

TRAIN_ROWS = 8000
PASSES = 3
BITS = 18
SCALE = 20.0
SLICE = 1 << 18
THRESHOLD = 0.3


def _kinds() -> np.ndarray:
    """0 white space and controls, 1 word bytes, 2 marks."""
    kind = np.full(256, 2, np.uint8)
    kind[:33] = 0
    kind[127] = 0
    for a, b in ((48, 58), (65, 91), (97, 123), (128, 256)):
        kind[a:b] = 1
    return kind


KIND = _kinds()
LOWER = np.array([b + 32 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256)], np.uint8)
REPEAT, CAPITALS, ECHO = np.uint64(0x5EED0001), np.uint64(0x5EED0002), np.uint64(0x5EED0003)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers in any order, the text each belongs to, and the number of tokens of each text."""
    texts = len(offsets) - 1
    starts, ends = words.boundaries(KIND[data], offsets)
    owner = words.owners(starts, offsets)
    tokens = np.bincount(owner, minlength=texts) if len(owner) else np.zeros(texts, np.int64)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), tokens
    hashes = words.run_hashes(LOWER[data], starts, ends)
    capital = (data >= 65) & (data <= 90)
    small = (data >= 97) & (data <= 122)
    loud = np.add.reduceat(np.stack([capital, small], axis=1).astype(np.int32), starts, axis=0)
    # reduceat sums up to the next start: white space between adds nothing, marks are runs of their own
    loud = (loud[:, 0] >= 2) & (loud[:, 1] == 0)
    next_to = owner[1:] == owner[:-1]
    same = next_to & (hashes[1:] == hashes[:-1])
    echo = (owner[2:] == owner[:-2]) & (hashes[2:] == hashes[:-2])
    with np.errstate(over="ignore"):
        pairs = words.mix(hashes[:-1] * np.uint64(words.ROOT) + hashes[1:])
    parts = [
        (hashes, owner),
        (np.where(same, REPEAT, pairs)[next_to], owner[1:][next_to]),
        (np.full(int(loud.sum()), CAPITALS), owner[loud]),
        (np.full(int(echo.sum()), ECHO), owner[2:][echo]),
    ]
    codes = np.concatenate([words.mix(h) for h, _ in parts])
    return (codes >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate([o for _, o in parts]), tokens


@dataclass
class Follower:
    """Per-coordinate follow-the-regularised-leader steps (proximal, with L1 and L2 terms)."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01

    def __post_init__(self):
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) > self.l1, (np.sign(z) * self.l1 - z) / rate, 0.0)

    def step(self, at: np.ndarray, value: np.ndarray, label: float) -> None:
        weight = self.weights(at)
        slope = (1 / (1 + np.exp(-np.clip(weight @ value, -30, 30))) - label) * value
        n = self.n[at]
        grown = n + slope * slope
        self.z[at] += slope - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * weight
        self.n[at] = grown


def sample(labels: DataFrame, column: str, most: int) -> DataFrame:
    """Ids and labels to learn from: one row per id, not held out, at most ``most`` by the hash of the id."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    known = known.filter(common.fold_of(F.col("doc_id")) != 0)
    single = known.groupBy("doc_id").agg(F.min(column).cast("int").alias("label"))
    return single.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = common.text_bytes(batch.column(2))
        codes, owner, tokens = features(data, offsets)
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(len(offsets)))
        where, value = [], []
        for row, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            own, count = np.unique(codes[order[a:b]], return_counts=True)
            where.append(own.astype(np.int32))
            value.append((count * (SCALE / max(1, tokens[row]))).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(where, pa.list_(pa.int32())),
             pa.array(value, pa.list_(pa.float32()))],
            names=["doc_id", "label", "at", "value"],
        )


def fit(docs: DataFrame, labels: DataFrame, *, column: str = "quality", most: int = TRAIN_ROWS) -> np.ndarray:
    """Weights, the last of them the bias. The sample has a proven bound, so it may be broadcast and gathered."""
    chosen = F.broadcast(sample(labels, column, most))
    rows = docs.select("doc_id", F.col("text").alias("body")).join(chosen, "doc_id")
    first = F.min_by("body", F.struct(F.xxhash64("body"), "body")).alias("body")
    rows = rows.groupBy("doc_id", "label").agg(first)
    found = common.map_arrow(rows, _sparse, "doc_id bigint, label int, at array<int>, value array<float>").toArrow()
    found = found.sort_by("doc_id")
    learner = Follower()
    rows = [
        (np.append(at.values.to_numpy(), np.int32(1 << BITS)), np.append(value.values.to_numpy(), np.float32(1)), y)
        for at, value, y in zip(found.column("at"), found.column("value"), found.column("label").to_pylist())
    ]
    order = np.random.default_rng(11)
    for _ in range(PASSES):
        for i in order.permutation(len(rows)):
            learner.step(*rows[i])
    del rows, found
    common.release()
    return learner.weights(np.arange((1 << BITS) + 1)).astype(np.float32)


def _score(shared, kept: int, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        for batch in batches:
            data, offsets = common.text_bytes(batch.column(kept))
            scores = np.empty(len(offsets) - 1)
            for a, b in common.slices(offsets, SLICE):
                codes, owner, tokens = features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                dots = np.bincount(owner, weight[codes].astype(np.float64), minlength=b - a)
                margin = dots * SCALE / np.maximum(1, tokens) + float(weight[-1])
                scores[a:b] = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            yield common.batch(out, [*(batch.column(i) for i in range(kept)), scores])
    return run


def score(docs: DataFrame, weights: np.ndarray, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per document: the ``keep`` columns and the score, 0 to 1."""
    base = docs.select(*[F.col(c) for c in keep], F.col(text).alias("body"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])
    schema = f"{head}, score double"
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    return common.map_arrow(base, _score(shared, len(keep), common.arrow_schema(schema)), schema)


def judged(scored: DataFrame, threshold: float) -> list[Column]:
    held_out = common.fold_of(F.col("doc_id")) == 0
    return ["doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")]


def op8_quality(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, common.table(spark, sf_dir, "labels")))
    return scored.select(*judged(scored, THRESHOLD))
