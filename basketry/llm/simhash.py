"""SimHash near-duplicates: fingerprints of word shingles, linked where few bits differ, found by pigeonhole blocks.

A fingerprint bit is set where over half the 64-bit hashes of a text's shingles, repeats included, have it. Equal
fingerprints are folded first. The 64 bits are cut into PARTS blocks; two fingerprints that differ in at most
``distance`` bits agree on at least PARTS - distance of them, so every choice of so many blocks is a key, and close
pairs share a key. A key with two fingerprints is a pair to verify; a larger one is a bucket, which a task reads as a
stream and searches breadth-first by Hamming distance. It writes one link for each member that is reached, never all
pairs. A bucket of more than BUCKET fingerprints is cut once more by blocks of its free bits: what then still shares
a key differs in few positions, so a second bucket is small however many documents there are.

Defined cases: null, empty and wordless texts have fingerprint zero and are linked like any other; fewer words than a
shingle are one shingle; a bit that exactly half the hashes have is not set; very long texts are hashed in segments;
repeated rows each keep their row; a null id takes the smallest id of its component, if there is one; columns of
other names are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

SIZE = 5
DISTANCE = 3
BITS = 64
PARTS = 6
SEED = 42
# Shingles whose bits are added up at a time.
SEGMENT = 1 << 15
# Fingerprints of a bucket that are compared directly.
BUCKET = 4096


def shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text, in segments: words lower-cased in ASCII, joined by single spaces."""
    words = text.lower().split()
    if not words:
        return
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    count = max(1, len(words) - size + 1)
    last = ends[-count:].tolist()
    starts = starts.tolist()
    digest = xxhash.xxh64_intdigest
    for a in range(0, count, SEGMENT):
        b = min(count, a + SEGMENT)
        own = (digest(joined[i:j], SEED) for i, j in zip(starts[a:b], last[a:b]))
        yield np.fromiter(own, np.uint64, b - a)


def fingerprint(text: bytes, size: int) -> int:
    """Bits that over half the shingle hashes have."""
    ones, total = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, size):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big") if total else 0


def _prints(size: int, kept: int, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.text_bytes(batch.column(kept))
            raw = data.tobytes()
            own = np.fromiter(
                (fingerprint(raw[a:b], size) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())),
                np.uint64, len(offsets) - 1)
            yield common.batch(out, [*(batch.column(i) for i in range(kept)), pa.array(own.view(np.int64))])
    return run


def fingerprints(docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text", size: int = SIZE) -> DataFrame:
    """One row per document: the ``keep`` columns and ``print``, the fingerprint as a signed 64-bit number."""
    base = docs.select(*[F.col(c) for c in keep], F.col(text).alias("body"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])
    schema = f"{head}, print bigint"
    return common.map_arrow(base, _prints(size, len(keep), common.arrow_schema(schema)), schema)


def parts(positions: list[int], number: int) -> list[list[int]]:
    """The positions cut into ``number`` blocks of nearly equal length."""
    edges = [len(positions) * i // number for i in range(number + 1)]
    return [positions[a:b] for a, b in zip(edges[:-1], edges[1:])]


def mask(positions: list[int]) -> int:
    """These bits, as a signed number."""
    value = sum(1 << p for p in positions)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def keys(distance: int) -> list[tuple[int, list[int]]]:
    """For each choice of PARTS - distance blocks: the mask of its bits, and the positions left free."""
    blocks = parts(list(range(BITS)), PARTS)
    return [
        (mask([p for i in chosen for p in blocks[i]]), [p for i in range(PARTS) if i not in chosen for p in blocks[i]])
        for chosen in combinations(range(PARTS), PARTS - distance)
    ]


def finer(free: list[int], distance: int) -> list[tuple[int, list[int]]]:
    """The same for the free positions of a key."""
    blocks = parts(free, PARTS)
    return [
        (mask([p for i in chosen for p in blocks[i]]), [p for i in range(PARTS) if i not in chosen for p in blocks[i]])
        for chosen in combinations(range(PARTS), PARTS - distance)
    ]


def near_masks(free: list[int], distance: int) -> np.ndarray:
    """All changes of one to ``distance`` of these bits."""
    return np.array(
        [mask(list(c)) for k in range(1, distance + 1) for c in combinations(free, k)], np.int64).view(np.uint64)


def spanning(prints: np.ndarray, distance: int, free: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, first of its component) of distinct fingerprints, by breadth-first search. With few free
    positions and many members, neighbours are looked up; else distances are taken."""
    members = np.sort(prints)
    by_lookup = free is not None and len(members) > BUCKET
    changes = near_masks(free, distance) if by_lookup else None
    left = np.ones(len(members), bool)
    nodes, roots = [], []
    for first in range(len(members)):
        if not left[first]:
            continue
        left[first] = False
        front = np.array([first])
        while len(front):
            if by_lookup:
                wanted = np.unique(np.concatenate([members[i] ^ changes for i in front]))
                at = np.minimum(np.searchsorted(members, wanted), len(members) - 1)
                found = at[members[at] == wanted]
                found = found[left[found]]
                left[found] = False
                nodes.append(members[found])
                roots.append(np.full(len(found), members[first]))
                front = found
                continue
            reached = []
            for i in front:
                rest = np.flatnonzero(left)
                found = rest[np.bitwise_count(members[rest] ^ members[i]) <= distance]
                left[found] = False
                reached.append(found)
            front = np.concatenate(reached)
            nodes.append(members[front])
            roots.append(np.full(len(front), members[first]))
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(nodes), np.concatenate(roots)) if nodes else (empty, empty)


def _search(distance: int, free_of: list[list[int]] | None):
    """From rows (choice, key, print) sorted by key: the spanning links of each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if held:
                free = free_of[current[0]] if free_of else None
                a, b = spanning(np.concatenate(held), distance, free)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            choice, key, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            new = np.flatnonzero((choice[1:] != choice[:-1]) | (key[1:] != key[:-1])) + 1
            edges = [0, *new.tolist(), len(own)] if len(own) else []
            for a, b in zip(edges[:-1], edges[1:]):
                if (choice[a], key[a]) != current:
                    yield from close()
                    current, held = (choice[a], key[a]), []
                held.append(own[a:b].view(np.uint64))
        yield from close()
    return run


def keyed(prints: DataFrame, masks: Column) -> DataFrame:
    """Each fingerprint under the key of each mask."""
    rows = prints.select("print", F.posexplode(masks).alias("choice", "mask"))
    return rows.select("choice", F.col("print").bitwiseAND(F.col("mask")).alias("key"), "print")


def _buckets(rows: DataFrame) -> DataFrame:
    """Keys with several fingerprints: how many, and two of them."""
    found = rows.groupBy("choice", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("print").alias("a"), F.max("print").alias("b"))
    return common.keep(found.filter("n > 1"), "simhash")


def _searched(rows: DataFrame, buckets: DataFrame, run) -> DataFrame:
    """Links inside the buckets asked for."""
    rows = rows.join(buckets.select("choice", "key"), ["choice", "key"]).select("choice", "key", "print")
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(count, "choice", "key").sortWithinPartitions("choice", "key")
    return common.map_arrow(dealt, run, "a bigint, b bigint")


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """From distinct fingerprints: links (a, b) of pairs within the distance that span every component."""
    if not 0 <= distance < PARTS:
        raise ValueError(f"distance must be below {PARTS}")
    chosen = keys(distance)
    rows = keyed(prints, F.array(*[F.lit(m) for m, _ in chosen]))
    buckets = _buckets(rows)
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    found = [buckets.filter("n = 2").filter(apart <= distance).select("a", "b")]
    found.append(_searched(rows, buckets.filter(f"n between 3 and {BUCKET}"), _search(distance, None)))
    large = common.keep(
        rows.join(buckets.filter(f"n > {BUCKET}").select("choice", "key"), ["choice", "key"]), "simhash")
    if not large.isEmpty():
        # The second choice is numbered below the first, so a bucket still knows its free positions.
        second = [finer(free, distance) for _, free in chosen]
        by_choice = F.array(*[F.array(*[F.lit(chosen[i][0] | m) for m, _ in second[i]]) for i in range(len(chosen))])
        deep = large.select("choice", "print", F.posexplode(by_choice[F.col("choice")]).alias("finer", "mask"))
        deep = deep.select(
            (F.col("choice") * len(second[0]) + F.col("finer")).alias("choice"),
            F.col("print").bitwiseAND(F.col("mask")).alias("key"), "print")
        small = _buckets(deep)
        found.append(small.filter("n = 2").filter(apart <= distance).select("a", "b"))
        free_of = [free for own in second for _, free in own]
        found.append(_searched(deep, small.filter("n > 2"), _search(distance, free_of)))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(
    docs: DataFrame, *, text: str = "text", size: int = SIZE, distance: int = DISTANCE,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest id reachable by
    links between fingerprints that differ in at most ``distance`` bits)."""
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("body"))
    rows = common.keep(fingerprints(base, text="body", size=size), "simhash")
    distinct = common.keep(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash")
    roots = components(links(distinct.select("print"), distance))
    placed = distinct.join(roots, F.col("print") == F.col("node"), "left")
    placed = placed.select("print", "least", F.coalesce("root", "print").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    names = placed.join(least, "root").select("print", "component_id")
    digits = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return rows.join(names, "print").select("doc_id", digits, F.coalesce("component_id", "doc_id").alias("component_id"))


def op11_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), size=3)
