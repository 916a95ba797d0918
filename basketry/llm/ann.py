"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, stored as flat arrays.

Equal vectors are collapsed first and keep their smallest ids, so copies neither crowd the graph nor the answers.
Distinct vectors are dealt to shards of about SHARD_ROWS by their hash. A task builds the graph of a shard and writes
it as one row: vectors, ids and, for each layer, its nodes and their neighbours as a matrix of row numbers, -1 where
there is none. Queries travel in blocks; a block meets each shard once, and each shard returns its best rows of every
query, scored in double precision on the original vectors. A ranking per query merges the shards.

Defined cases: vectors that are null, zero or hold a null or a component that is not finite take no part, nor do
rows without id or with another number of components than most rows have; repeated rows count once; ties go to the
smaller id; a table without vectors gives no rows; with fewer candidates than asked for, all are returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

SHARD_ROWS = 4096
LINKS = 12
BUILD_WIDTH = 80
SEARCH_WIDTH = 96
BLOCK = 256
BLOCKS_AT_ONCE = 32
COLLAPSE_ROWS = 20_000
K = 5


@dataclass
class Graph:
    """Layers of (nodes, neighbours); layer 0 has all rows, its nodes are their numbers."""

    unit: np.ndarray
    nodes: list[np.ndarray]
    near: list[np.ndarray]
    entry: int

    def __post_init__(self):
        self.row = [None] + [dict(zip(n.tolist(), range(len(n)))) for n in self.nodes[1:]]

    def neighbours(self, layer: int, node: int) -> np.ndarray:
        own = self.near[layer][node if layer == 0 else self.row[layer][node]]
        return own[own >= 0]

    def around(self, query: np.ndarray, start: list[tuple[float, int]], width: int, layer: int) -> list[tuple[float, int]]:
        """The ``width`` most similar nodes reached from the start, best first."""
        seen = {n for _, n in start}
        open_ = [(-s, n) for s, n in start]
        best = list(start)
        heapq.heapify(open_)
        heapq.heapify(best)
        while open_:
            back, node = heapq.heappop(open_)
            if len(best) >= width and -back < best[0][0]:
                break
            fresh = [n for n in self.neighbours(layer, node).tolist() if n not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            for s, n in zip((self.unit[fresh] @ query).tolist(), fresh):
                if len(best) < width:
                    heapq.heappush(best, (s, n))
                    heapq.heappush(open_, (-s, n))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, n))
                    heapq.heappush(open_, (-s, n))
        return sorted(best, key=lambda x: (-x[0], x[1]))

    def search(self, query: np.ndarray, width: int) -> list[int]:
        if len(self.unit) <= width:
            return list(range(len(self.unit)))
        found = [(float(self.unit[self.entry] @ query), self.entry)]
        for layer in range(len(self.nodes) - 1, 0, -1):
            found = self.around(query, found[:1], 1, layer)
        return [n for _, n in self.around(query, found[:1], width, 0)]


def _diverse(unit: np.ndarray, sims: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
    """Of nodes (most similar first) those that are nearer to the centre than to any taken one, then the others."""
    if len(nodes) <= most:
        return nodes
    among = unit[nodes] @ unit[nodes].T
    taken, left = [], []
    closest = np.full(len(nodes), -2.0)
    for i in range(len(nodes)):
        if closest[i] < sims[i]:
            taken.append(i)
            if len(taken) == most:
                break
            np.maximum(closest, among[i], out=closest)
        else:
            left.append(i)
    return nodes[(taken + left)[:most]]


def build(unit: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 0) -> Graph:
    """Insert row after row; the levels of rows are drawn with a fixed seed."""
    count = len(unit)
    rng = np.random.default_rng(seed)
    level = np.minimum((-np.log(1 - rng.random(count)) / np.log(links)).astype(int), 12)
    nodes = [np.flatnonzero(level >= k).astype(np.int32) for k in range(int(level.max()) + 1)]
    near = [np.full((len(n), 2 * links if k == 0 else links), -1, np.int32) for k, n in enumerate(nodes)]
    graph = Graph(unit, nodes, near, 0)
    for node in range(1, count):
        query = unit[node]
        top = int(level[graph.entry])
        found = [(float(unit[graph.entry] @ query), graph.entry)]
        for layer in range(top, int(level[node]), -1):
            found = graph.around(query, found[:1], 1, layer)
        for layer in range(min(top, int(level[node])), -1, -1):
            found = graph.around(query, found, width, layer)
            others = np.array([n for _, n in found], np.int32)
            chosen = _diverse(unit, np.array([s for s, _ in found]), others, links)
            matrix, row = near[layer], graph.row[layer]
            matrix[node if layer == 0 else row[node], :len(chosen)] = chosen
            for other in chosen.tolist():
                own = matrix[other if layer == 0 else row[other]]
                free = np.flatnonzero(own < 0)
                if len(free):
                    own[free[0]] = node
                    continue
                many = np.append(own, node).astype(np.int32)
                sims = unit[many] @ unit[other]
                order = np.argsort(-sims, kind="stable")
                own[:] = _diverse(unit, sims[order], many[order], len(own))
        if level[node] > top:
            graph.entry = node
    return graph


INDEX = (
    "shard int, size int, dim int, vectors binary, ids array<array<bigint>>, entry int, "
    "nodes array<binary>, near array<binary>"
)


def _usable(rows: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """(vec_id, vector as doubles) of rows that take part."""
    own = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = own.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine)
    own = own.filter(F.exists("vector", lambda x: x != 0))
    common_dim = own.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    first = common_dim.orderBy(F.desc("n"), "dim").first()
    return own.filter(F.size("vector") == (first.dim if first else 0))


def _collapse(kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors as bytes with their smallest ids, equal ones of the task together."""
        held: dict[bytes, list[int]] = {}

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.list_(pa.int64()))],
                names=["vector", "ids"])

        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            matrix = (flat + 0.0).reshape(batch.num_rows, -1)  # -0.0 becomes 0.0
            for vec_id, vector in zip(batch.column(0).to_pylist(), matrix):
                own = held.setdefault(vector.tobytes(), [])
                if vec_id not in own:
                    own.append(vec_id)
                    if len(own) > kept:
                        own.remove(max(own))
            if len(held) > COLLAPSE_ROWS:
                yield flush()
                held.clear()
        yield flush()
    return run


def _build_shards(out: pa.Schema, links: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, vectors, ids = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            if shard is None:
                return
            matrix = np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
            unit = _unit(matrix)
            graph = build(unit, links, width, seed=shard)
            yield common.batch(out, [
                [shard], [len(matrix)], [matrix.shape[1]], [matrix.tobytes()], [ids], [graph.entry],
                [[n.tobytes() for n in graph.nodes]], [[n.tobytes() for n in graph.near]],
            ])

        for batch in batches:
            for own, vector, names in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if own != shard:
                    yield from close()
                    shard, vectors, ids = own, [], []
                vectors.append(vector)
                ids.append(names)
        yield from close()
    return run


def _unit(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def index(
    rows: DataFrame, *, vector: str = "embedding", vec_id: str = "vec_id", shard_rows: int = SHARD_ROWS,
    links: int = LINKS, width: int = BUILD_WIDTH, k: int = K,
) -> DataFrame:
    """One row per shard, written to the shared folder. Every usable row is in it; of equal vectors the k + 1
    smallest ids, as no answer needs more."""
    found = common.map_arrow(_usable(rows, vector, vec_id), _collapse(k + 1), "vector binary, ids array<bigint>")
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids")
    distinct = common.keep(found.groupBy("vector").agg(ids), "vectors")
    shards = max(1, -(-distinct.count() // shard_rows))
    dealt = distinct.select(F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), "vector", "ids")
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "vector")
    built = common.map_arrow(dealt, _build_shards(common.arrow_schema(INDEX), links, width), INDEX)
    return common.keep(built, "hnsw")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        ids = batch.column(0).to_pylist()
        for at in range(0, len(ids), BLOCK):
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[at:at + BLOCK]], pa.list_(pa.int64())),
                 pa.array([flat[at:at + BLOCK].tobytes()], pa.binary())], names=["ids", "vectors"])


def load(row) -> Graph:
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(row["size"], row["dim"])
    nodes = [np.frombuffer(n, np.int32) for n in row["nodes"]]
    near = [np.frombuffer(n, np.int32).reshape(len(o), -1) for n, o in zip(row["near"], nodes)]
    return Graph(_unit(vectors), nodes, near, row["entry"])


def _search(k: int, width: int):
    names = ["query_id", "vec_id", "score"]

    def run(shards: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        for row in shards.to_dict("records"):
            graph = load(row)
            vectors = np.frombuffer(row["vectors"], np.float64).reshape(row["size"], row["dim"])
            norms = np.linalg.norm(vectors, axis=1)
            for ids, raw in zip(blocks["ids"], blocks["vectors"]):
                queries = np.frombuffer(raw, np.float64).reshape(len(ids), -1)
                for query_id, query, unit in zip(ids, queries, _unit(queries)):
                    at = np.array(graph.search(unit, max(width, k + 1)))
                    score = (vectors[at] @ query) / (norms[at] * np.linalg.norm(query))
                    best = np.lexsort((at, -score))
                    # Ties behind the last place must still compete by id.
                    least = score[best[min(k, len(best) - 1)]]
                    found = [
                        (-score[i], vec_id) for i in best if score[i] >= least
                        for vec_id in row["ids"][at[i]] if vec_id != query_id
                    ]
                    out += [(query_id, vec_id, -s) for s, vec_id in sorted(found)[:k]]
        return pd.DataFrame(out, columns=names)
    return run


def nearest(
    rows: DataFrame, queries: DataFrame, *, vector: str = "embedding", vec_id: str = "vec_id", k: int = K,
    width: int = SEARCH_WIDTH, **options,
) -> DataFrame:
    """For each query row the k nearest other rows by cosine: query_id, rank (from 1), vec_id, score."""
    shards = index(rows, vector=vector, vec_id=vec_id, k=k, **options)
    count = shards.count()
    asked = _usable(queries, vector, vec_id).dropDuplicates(["vec_id"])
    blocks = common.keep(common.map_arrow(asked, _blocks, "ids array<bigint>, vectors binary"), "queries")
    # A task holds one shard and a bounded number of blocks: beyond it the shard goes to several tasks.
    slots = max(1, -(-blocks.count() // BLOCKS_AT_ONCE))
    slot = F.pmod(F.xxhash64("vectors"), F.lit(slots)).cast("int").alias("slot")
    met = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(max(0, count - 1)))).alias("shard"), slot, "ids", "vectors")
    copies = shards.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    pairs = copies.groupBy("shard", "slot").cogroup(met.groupBy("shard", "slot"))
    found = pairs.applyInPandas(_search(k, width), "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def op6_ann(spark, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, rows.filter(F.col("vec_id") % 50 == 0))
