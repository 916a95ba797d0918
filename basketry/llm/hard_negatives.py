"""Hard negatives: rows of another label whose similarity to an anchor lies in a window below that of a positive.

Vectors are quantised to whole numbers and laid out along a Hilbert curve over the dimensions of largest spread:
range-partitioned and sorted by curve position, then written as Parquet blocks of BLOCK_BYTES of components, each
with its zone map, the least and largest component of every dimension, and its labels. Anchors are cut into blocks in the same order.

Interval arithmetic on zone maps bounds every inner product of an anchor with a block from both sides, for a block of
anchors and many zone maps as four matrix products. Blocks are read in three steps:
1. for each anchor the block of its label with the highest upper bound, which yields a first set of positives;
2. all other blocks of its label whose upper bound reaches the last of these: after them the positives are exact;
3. the blocks with other labels whose bounds meet one of the anchor's windows: they yield the negatives.
A block to be read travels once for every ANCHOR_BLOCKS anchor blocks that need it, and these follow it as a stream. Each
meeting sends ``k`` rows of an anchor (or window) at most, so nothing unbounded meets in one place.

Products are exact: in float64 where no sum reaches 2^53, else in whole numbers of any length, and what then lies
beyond a 64-bit number counts as the nearest one.

Defined cases: rows without id, label or vector, with a null or non-finite component, or with another number of
components than most rows have (the smaller number on a tie) take no part; rows of equal id, label and quantised vector count
once, other rows that share an id each count; equal scores are ordered by id; with fewer rows than asked for, all are returned; anchors without
positives or negatives give no rows; columns of other names are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from . import common

POSITIVES = NEGATIVES = 5
LOW, HIGH, PERCENT = 80, 100, 100
SCALE = 256
CURVE_DIMENSIONS, CURVE_BITS = 16, 8
# Bytes of the components of a block, as 64-bit numbers; a block of anchors has a quarter of the rows.
BLOCK_BYTES = 512 << 10
ANCHOR_BLOCKS = 32
EXACT = 1 << 53
LIMIT = (1 << 63) - 1

BLOCKS = (
    "block bigint, size int, ids binary, labels binary, vectors binary, lows binary, highs binary, kinds array<bigint>"
)


def usable(rows: DataFrame, vector: str, vec_id: str, label: str) -> DataFrame:
    """Rows (id, label, vector of doubles) that take part, of the most frequent number of components."""
    own = rows.select(
        F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).dropna()
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = own.filter(finite).withColumn("dim", F.size("vector"))
    most = own.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    return own.filter(F.col("dim") == (most.dim if most else 0)).select("id", "label", "vector")


def curve_plan(rows: DataFrame) -> list[tuple[int, float, float]]:
    """Dimensions for the curve, widest first, with their range. One row per dimension reaches the driver."""
    each = rows.select(F.posexplode("vector").alias("at", "x")).groupBy("at").agg(
        F.stddev_pop("x").alias("spread"), F.min("x").alias("low"), F.max("x").alias("high"))
    best = each.filter("high > low").orderBy(F.desc("spread"), "at").limit(CURVE_DIMENSIONS).collect()
    return [(r["at"], r["low"], r["high"]) for r in best]


def curve_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve as rows of bytes, from cell numbers (rows x dimensions) below 2^bits, by
    reflecting and exchanging axes from the highest bit down, and a Gray code over all axes."""
    x = cells.T.astype(np.uint32).copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        below = np.uint32((1 << bit) - 1)
        for i in range(n):
            flip = (x[i] >> np.uint32(bit)) & np.uint32(1) == 1
            swap = np.where(flip, np.uint32(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(flip, below, swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    last = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        last ^= np.where((x[n - 1] >> np.uint32(bit)) & np.uint32(1) == 1, np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= last
    planes = [(x[i] >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1) for i in range(n)]
    return np.packbits(np.stack(planes, axis=1).astype(np.uint8), axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _keyed(plan: list[tuple[int, float, float]], scale: float):
    """Quantised vectors with their curve keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = _matrix(batch.column(2))
            keys = np.zeros((len(raw), 1), np.uint8)
            if plan:
                at, low, high = (np.array(c) for c in zip(*plan))
                top = (1 << CURVE_BITS) - 1
                share = (raw[:, at.astype(int)] / 2 - low / 2) / (high / 2 - low / 2)  # halves: no overflow
                keys = curve_keys(np.clip(share * top, 0, top).astype(np.uint32), CURVE_BITS)
            whole = np.floor(raw * scale)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in whole], pa.binary()),
                 pa.array([k.tobytes() for k in keys], pa.binary())],
                names=["id", "label", "whole", "key"])
    return run


def _cut(most: int, out: pa.Schema):
    """Sorted rows into blocks of ``most`` rows with their zone maps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0

        def block(rows: pa.Table) -> pa.RecordBatch:
            nonlocal number
            ids, labels = (rows.column(i).to_numpy().astype(np.int64) for i in range(2))
            vectors = np.frombuffer(b"".join(rows.column(2).to_pylist()), np.float64).reshape(len(ids), -1)
            number += 1
            return common.batch(out, [
                [part << 32 | number], [len(ids)], [ids.tobytes()], [labels.tobytes()], [vectors.tobytes()],
                [vectors.min(axis=0).tobytes()], [vectors.max(axis=0).tobytes()], [np.unique(labels)]])

        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            while count >= most:
                rows = pa.Table.from_batches(held)
                yield block(rows.slice(0, most))
                held, count = rows.slice(most).to_batches(), count - most
        if count:
            yield block(pa.Table.from_batches(held))
    return run


def blocks(rows: DataFrame, most: int) -> DataFrame:
    """Rows (id, label, whole, key) as a table of blocks along the curve."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "id", "label", "whole"]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "label", "whole")
    return common.keep(common.map_arrow(dealt, _cut(most, common.arrow_schema(BLOCKS)), BLOCKS), "negatives")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(a).dot(whole(b).T) if a.shape[1] else np.zeros((len(a), len(b)), object)
    return np.clip(exact, -LIMIT - 1, LIMIT).astype(np.int64)


def bounds(anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each anchor with any vector of each zone, widened by the rounding of the sums
    and held in the range of scores."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    least, largest = up @ lows.T + down @ highs.T, up @ highs.T + down @ lows.T
    slack = np.abs(anchors) @ np.maximum(np.abs(lows), np.abs(highs)).T * (anchors.shape[1] * 2.0 ** -50)
    return np.clip(least - slack, -LIMIT - 1, LIMIT), np.clip(largest + slack, -LIMIT - 1, LIMIT)


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest whole s with low * score <= PERCENT * s <= high * score."""
    return -(-low * score // PERCENT), high * score // PERCENT


def _numbers(raw: bytes, dim: int | None = None) -> np.ndarray:
    return np.frombuffer(raw, np.int64) if dim is None else np.frombuffer(raw, np.float64).reshape(dim, -1)


def _wanted(step: str, low: int, high: int):
    """From zone maps and anchor blocks (with their state): which anchors need which blocks. In the first step one
    row per anchor, with the bound; later one per block and anchor block."""
    names = ["block", "anchors", "rows", "bound"]

    def run(zones: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if not len(zones):
            return pd.DataFrame(out, columns=names)
        lows, highs = (np.stack([np.frombuffer(x, np.float64) for x in zones[c]]) for c in ("lows", "highs"))
        kinds = zones["kinds"].to_list()
        ids = zones["block"].to_numpy()
        one = np.array([k[0] if len(k) == 1 else 0 for k in kinds], np.int64)
        single = np.array([len(k) == 1 for k in kinds])
        for at, raw, labels, size, state in zip(*(anchors[c] for c in ("block", "vectors", "labels", "size", "state"))):
            labels = _numbers(labels)
            least, largest = bounds(_numbers(raw, size), lows, highs)
            if step == "negatives":
                need = np.zeros(least.shape, bool)
                for s in state:
                    a, b = window(s["score"], low, high)
                    need[s["row"]] |= (largest[s["row"]] >= a) & (least[s["row"]] <= b)
                need &= ~(single & (one == labels[:, None]))
            else:
                has = np.zeros(least.shape, bool)
                for label in np.unique(labels):
                    has[labels == label] = np.array([label in k for k in kinds])
                if step == "first":
                    best = np.where(has, largest, -np.inf).argmax(axis=1)
                    out += [(ids[z], at, [i], largest[i, z]) for i, z in enumerate(best) if has[i, z]]
                    continue
                need = has
                for s in state:  # the block that was read, and the score to reach
                    need[s["row"]] &= (largest[s["row"]] >= s["score"]) & (ids != s["block"])
            for z in np.flatnonzero(need.any(axis=0)):
                out.append((ids[z], at, np.flatnonzero(need[:, z]).tolist(), 0.0))
        return pd.DataFrame(out, columns=names)
    return run


def first_of(score: np.ndarray, ids: np.ndarray, live: np.ndarray, k: int) -> np.ndarray:
    """Of the live places the k with the highest scores, ties by id."""
    if len(live) > 4 * k:
        floor = np.partition(score[live], len(live) - k)[len(live) - k]
        live = live[score[live] >= floor]
    return live[np.lexsort((ids[live], -score[live]))[:k]]


def _read(step: str, k: int, low: int, high: int):
    """From rows sorted by (block, slot) with the block first: the best rows of each anchor or window that asks it."""
    names = ["anchors", "row", "anchor_id", "place", "id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = labels = vectors = None
        for batch in batches:
            for r in batch.to_pylist():
                if r["anchors"] is None:
                    ids, labels = _numbers(r["ids"]), _numbers(r["labels"])
                    vectors = _numbers(r["vectors"], r["size"])
                    continue
                rows = np.array(r["rows"])
                scores = products(_numbers(r["vectors"], r["size"])[rows], vectors)
                own_ids, own_labels = _numbers(r["ids"])[rows], _numbers(r["labels"])[rows]
                windows: dict[int, list] = {}
                for s in r["state"] or ():
                    windows.setdefault(s["row"], []).append((s["place"], *window(s["score"], low, high)))
                anchors = _numbers(r["vectors"], r["size"])[rows]
                out = []
                for i, row in enumerate(rows.tolist()):
                    if step == "negatives":
                        asked = windows[row]
                        least = min(a for _, a, _ in asked)
                        most = max(b for _, _, b in asked)
                        live = np.flatnonzero((labels != own_labels[i]) & (scores[i] >= least) & (scores[i] <= most))
                        for place, a, b in asked:
                            fits = live[(scores[i, live] >= a) & (scores[i, live] <= b)]
                            out += [(row, own_ids[i], place, ids[j], scores[i, j]) for j in first_of(scores[i], ids, fits, k)]
                    else:
                        live = np.flatnonzero(labels == own_labels[i])
                        same = live[ids[live] == own_ids[i]]
                        itself = same[(vectors[same] == anchors[i]).all(axis=1)]
                        live = np.setdiff1d(live, itself, assume_unique=True)
                        out += [(row, own_ids[i], 0, ids[j], scores[i, j]) for j in first_of(scores[i], ids, live, k)]
                if out:
                    columns = [np.full(len(out), r["anchors"]), *(np.array(c, np.int64) for c in zip(*out))]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
    return run


class Miner:
    """Blocks, anchors and the steps over them."""

    def __init__(self, rows: DataFrame, anchors: Column, scale: float, vector: str, vec_id: str, label: str, low: int, high: int):
        self.low, self.high = low, high
        own = common.keep(usable(rows, vector, vec_id, label), "negatives")
        first = own.select(F.size("vector").alias("dim")).first()
        most = max(16, BLOCK_BYTES // (8 * max(1, first.dim if first else 1)))
        run = _keyed(curve_plan(own), scale)
        whole = common.map_arrow(own, run, "id bigint, label bigint, whole binary, key binary")
        whole = common.keep(whole.dropDuplicates(["id", "label", "whole"]), "negatives")
        self.blocks = blocks(whole, most)
        self.anchors = blocks(whole.filter(anchors), max(16, most // 4))
        spark = rows.sparkSession
        self.parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.slots = max(1, -(-self.anchors.count() // ANCHOR_BLOCKS))

    def slot(self) -> Column:
        return F.pmod(F.xxhash64("anchors"), F.lit(self.slots)).cast("int")

    def asked(self, state: DataFrame | None) -> DataFrame:
        """Anchor blocks with their state, at most one entry per anchor and place."""
        own = self.anchors.select("block", "size", "ids", "labels", "vectors")
        kind = "array<struct<row:int,place:int,score:bigint,block:bigint>>"
        if state is None:
            return own.withColumn("state", F.lit(None).cast(kind))
        entry = F.struct(
            F.col("row").cast("int").alias("row"), F.col("place").cast("int").alias("place"), "score", "block")
        folded = state.groupBy("anchors").agg(F.collect_list(entry).alias("state"))
        return own.join(folded.withColumnRenamed("anchors", "block"), "block")

    def wanted(self, asked: DataFrame, step: str) -> DataFrame:
        """Meetings of anchor blocks with the zone maps of each part of the curve."""
        part = F.shiftright("block", 32).cast("int").alias("part")
        zones = self.blocks.select(part, "block", "lows", "highs", "kinds")
        zones = zones.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(self.slots - 1))))
        met = asked.select(
            F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1))).alias("part"),
            F.pmod(F.xxhash64("block"), F.lit(self.slots)).cast("int").alias("slot"),
            "block", "size", "labels", "vectors", "state")
        pairs = zones.groupBy("part", "slot").cogroup(met.groupBy("part", "slot"))
        return pairs.applyInPandas(
            _wanted(step, self.low, self.high), "block bigint, anchors bigint, rows array<int>, bound double")

    def read(self, wanted: DataFrame, asked: DataFrame, step: str, k: int) -> DataFrame:
        """The best rows of each anchor (and place) from the blocks it needs."""
        wanted = common.keep(wanted.withColumn("slot", self.slot()), "negatives")
        nothing = [F.lit(None).cast(t).alias(n) for n, t in (
            ("anchors", "bigint"), ("rows", "array<int>"), ("state", asked.schema["state"].dataType))]
        columns = ["block", "slot", "anchors", "rows", "state", "size", "ids", "labels", "vectors"]
        heads = self.blocks.join(wanted.select("block", "slot").distinct(), "block").select(
            "block", "slot", *nothing, "size", "ids", "labels", "vectors")
        tails = wanted.join(asked.withColumnRenamed("block", "anchors"), "anchors").select(*columns)
        rows = heads.select(*columns).unionByName(tails)
        dealt = rows.repartition(self.parts, "block", "slot").sortWithinPartitions(
            "block", "slot", F.asc_nulls_first("anchors"))
        schema = "anchors bigint, row bigint, anchor_id bigint, place bigint, id bigint, score bigint"
        found = common.map_arrow(dealt, _read(step, k, self.low, self.high), schema)
        return common.keep(found, "negatives")

    def positives(self, k: int) -> DataFrame:
        """The first rows of the anchor's own label: (anchors, row, place, id, score)."""
        asked = self.asked(None)
        best = self.wanted(asked, "first").select(
            "anchors", F.element_at("rows", 1).alias("row"), "block", "bound")
        best = common.keep(best.groupBy("anchors", "row").agg(
            F.max_by("block", F.struct("bound", "block")).alias("block")), "negatives")
        grouped = best.groupBy("block", "anchors").agg(F.collect_list("row").alias("rows"))
        found = self.read(grouped, asked, "positives", k)
        # Without k rows yet every score may still enter.
        last = found.groupBy("anchors", "row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        reached = F.when(F.col("n") >= k, F.col("least")).otherwise(F.lit(-LIMIT - 1))
        state = best.join(last, ["anchors", "row"], "left").select(
            "anchors", "row", F.lit(0).alias("place"), reached.alias("score"), "block")
        asked = self.asked(state)
        more = self.read(self.wanted(asked, "positives").drop("bound"), asked, "positives", k)
        return placed(found.unionByName(more), ["anchors", "row"], k)

    def negatives(self, positives: DataFrame, k: int) -> DataFrame:
        asked = self.asked(positives.withColumn("block", F.lit(None).cast("bigint")))
        found = self.read(self.wanted(asked, "negatives").drop("bound"), asked, "negatives", k)
        return placed(found.withColumnRenamed("place", "window"), ["anchors", "row", "window"], k)


def placed(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k rows of each key with their place from 0."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id")) - 1
    return rows.withColumn("place", place).filter(F.col("place") < k)


def mine(
    rows: DataFrame, anchors: Column, *, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: float = SCALE,
) -> DataFrame:
    """For each anchor (a condition on the column ``id``) and each of its first ``positives`` rows of the same label:
    the first ``negatives`` rows of other labels with low * positive <= 100 * negative <= high * positive."""
    miner = Miner(rows, anchors, scale, vector, vec_id, label, low, high)
    near = common.keep(miner.positives(positives), "negatives")
    far = miner.negatives(near, negatives)
    keyed = near.select(
        "anchors", "row", F.col("place").alias("window"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"))
    joined = far.join(keyed, ["anchors", "row", "window"])
    return joined.select(
        "anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", "embedding", moved.alias("label")), F.col("id") % 100 == 0)


OP12_SQL = """
WITH e AS (SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) l,
                  [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] q
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT a.vec_id a, b.vec_id b, a.l = b.l same, CAST(list_inner_product(a.q, b.q) AS BIGINT) s
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT * FROM (SELECT a, b, s, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) k FROM p WHERE same) WHERE k <= 5),
neg AS (SELECT pos.a, pos.b, pos.s ps, p.b n, p.s ns, row_number() OVER (PARTITION BY pos.a, pos.b ORDER BY p.s DESC, p.b) k
        FROM pos JOIN p ON p.a = pos.a AND NOT p.same AND 80 * pos.s <= 100 * p.s AND 100 * p.s <= 100 * pos.s)
SELECT a anchor_id, b positive_id, CAST(k AS INTEGER) "rank", n negative_id, ps positive_score, ns negative_score
FROM neg WHERE k <= 5
"""
