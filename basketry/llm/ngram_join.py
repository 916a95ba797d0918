"""N-gram Jaccard join by grouped prefixes, and the components of its links.

A document's set holds the 64-bit hashes of its distinct word shingles. Documents of equal sets form a class. Sets
are put into one order, rare shingles first (FREQUENT ones, found by counts of all documents, last): two sets that
reach the threshold share a shingle within their prefixes. Classes with the same prefix and size collapse into a
group, groups that share a prefix shingle and fit in size and position become group pairs, and these are expanded to
class pairs and verified on the texts.

Only components are asked for, so pairs inside a component are not all compared:
1. each class is verified against the first class of its group and, in rounds with different choices, each group against
   a group of another component that it shares many prefix shingles with, as long as a round finds one in WORTH of the
   links that the first one found: after that a round costs more than the pairs it spares. Then each component is verified
   against up to TRIES others that its groups stand near in lists of random order, as long as the square of the
   components that a round joins is over the number of entries: those left could make more pairs than a round reads;
2. every candidate pair whose two sides are then still in different components is verified. A pair is written at the
   first prefix shingle that its sides share: each entry of a list carries the BEFORE shared shingles in front of it, and
   a pair with one of these in common has been met in an earlier list.
No link between components is lost, and a group of thousands of near copies costs one comparison for most members.

Lists of groups by shingle are read as sorted streams. A list of more than LIST_ROWS groups is cut into blocks, and
each pair of blocks is a task of its own; texts to verify against one class are salted in the same way. Before pairs are
written and texts fetched, parity bitmaps rule pairs out: they never differ in more bits than the sets in shingles.

Defined cases: null, empty or wordless texts have no shingles and are linked with nothing; fewer words than a
shingle are one shingle; repeated rows are equal sets; a null id takes the smallest id of its component if there is
one; very long texts are read whole, in one piece; columns of other names are not read, and ``first_of_each`` keeps
them; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, words
from .components import components

SIZE = 5
NUMERATOR, DENOMINATOR = 80, 100
# Shingles counted at a time in a task; those seen LOCAL times in it are added up over all tasks.
CHUNK_SHINGLES = 2 << 20
LOCAL = 3
# Bound of the frequent shingles known to every task (8 bytes each).
FREQUENT = 200_000
LIST_ROWS = 2048
SIGNATURE = 1024
# Rounds go on while they find more than one in so many of the links of the first round.
WORTH = 5
# In a round of the second kind: entries of a list that meet the next one, and pairs verified of a component.
REACH = 8
TRIES = 8
# Earlier prefix shingles carried along with an entry of a list, 8 bytes each.
BEFORE = 4
HUB_ROWS = 512
SLICE = 1 << 18

_KIND = np.ones(256, np.uint8)
_KIND[[32, 9, 10, 11, 12, 13]] = 0
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    starts, ends = words.boundaries(_KIND[data], offsets)
    hashes = words.run_hashes(_LOWER[data], starts, ends)
    bounds = np.searchsorted(starts, offsets)
    out = []
    with np.errstate(over="ignore"):
        code = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
        for k in range(size):
            code = words.mix(code * np.uint64(words.ROOT) + hashes[k:k + len(code)])
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= size:
                out.append(np.unique(code[a:b - size + 1]))
            elif b > a:
                short = np.uint64(b - a)
                for h in hashes[a:b]:
                    short = words.mix(np.array([short * np.uint64(words.ROOT) + h]))[0]
                out.append(np.array([short], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _texts_to_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    data, offsets = common.text_bytes(column)
    for a, b in common.slices(offsets, SLICE):
        yield from shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], size)


def _often(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def counted() -> pa.RecordBatch:
            token, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            many = n >= LOCAL
            return pa.RecordBatch.from_arrays(
                [pa.array(token[many].view(np.int64)), pa.array(n[many].astype(np.int64))], names=["token", "n"])

        for batch in batches:
            for own in _texts_to_sets(batch.column(0), size):
                held.append(own)
                count += len(own)
                if count >= CHUNK_SHINGLES:
                    yield counted()
                    held, count = [], 0
        yield counted()
    return run


def frequent(docs: DataFrame, size: int) -> np.ndarray:
    """Frequent shingles, from rare to common. Their choice only sets the order, so it decides on speed alone."""
    counts = common.map_arrow(docs.select("body"), _often(size), "token bigint, n bigint")
    total = counts.groupBy("token").agg(F.sum("n").alias("n"))
    top = total.orderBy(F.desc("n"), "token").limit(FREQUENT).orderBy("n", "token").select("token").toArrow()
    return top.column("token").to_numpy().view(np.uint64)


def bitmap(own: np.ndarray) -> bytes:
    """Parity of the shingles by hash: a power of two of bits, about as many as shingles."""
    bits = 1 << max(6, int(len(own)).bit_length())
    at = words.mix(own) & np.uint64(bits - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8).tobytes()


def signature(own: np.ndarray) -> bytes:
    """The same in SIGNATURE bits whatever the size, to travel with postings."""
    at = words.mix(own) & np.uint64(SIGNATURE - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=SIGNATURE) & 1).astype(np.uint8).tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits that differ after folding the longer map to the length of the shorter: at most the shingles that do."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


ROWS = "doc_id bigint, th bigint, n int, dig binary, gid bigint, bits binary, sig binary, prefix array<bigint>"


def _prefixes(size: int, numerator: int, denominator: int, shared, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common_last = shared.value
        known = np.sort(common_last)
        rank = np.argsort(common_last, kind="stable") + 1
        seen: set[int] = set()
        for batch in batches:
            rows = []
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, th, own in zip(ids, hashes, _texts_to_sets(batch.column(2), size)):
                n = len(own)
                if not n:
                    rows.append((doc_id, th, 0, None, None, None, None, None))
                    continue
                order = np.zeros(n, np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    order = np.where(known[at] == own, rank[at], 0)
                length = n - -(-numerator * n // denominator) + 1
                prefix = own[np.argsort(order, kind="stable")[:length]]
                gid = xxhash.xxh3_64_intdigest(prefix.tobytes() + n.to_bytes(8, "little")) - (1 << 63)
                first = gid not in seen  # a task writes the prefix of a group once
                if first:
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(gid)
                rows.append((
                    doc_id, th, n, xxhash.xxh3_128_digest(own.tobytes()), gid, bitmap(own), signature(own),
                    prefix.view(np.int64) if first else None))
            if rows:
                yield common.batch(out, [list(c) for c in zip(*rows)])
    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From postings sorted by shingle: each group with the first of its list, where their components differ."""
    last = None  # shingle, first group, its size and component, at the end of the batch before
    for batch in batches:
        token, gid, place, comp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        if not len(token):
            continue
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(token)), 0))
        hub = [c[first] for c in (gid, place, comp)]
        if last is not None and token[0] == last[0]:
            hub = [np.where(first == 0, old, c) for old, c in zip(last[1:], hub)]
        last = (token[-1], *(c[-1] for c in hub))
        other = (hub[0] != gid) & (hub[2] != comp)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[other]) for c in (gid, hub[0], place >> 32, hub[1] >> 32)], names=["gid", "hub", "n", "m"])


def _neighbours(numerator: int, denominator: int):
    """From postings sorted by shingle: each group with the REACH ones before it in the list, where their components differ
    and sizes, places and signatures allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks()
            begin, last = len(rows) - batch.num_rows, rows.slice(max(0, len(rows) - REACH)).to_batches()
            last = last[0] if last else None
            token, gid, place, comp = (rows.column(i).to_numpy() for i in range(4))
            n, rest = place >> 32, (place >> 32) - (place & 0xFFFFFFFF)
            sigs, known = _signatures(rows.column(4).to_pylist())
            for far in range(1, min(REACH, len(rows) - 1) + 1):
                x = np.arange(max(begin, far), len(rows))
                x = x[(token[x] == token[x - far]) & (gid[x] != gid[x - far]) & (comp[x] != comp[x - far])]
                need = needed(n[x], n[x - far], numerator, denominator)
                apart = np.bitwise_count(sigs[x] ^ sigs[x - far]).sum(axis=1)
                fits = (n[x] + n[x - far] - apart >= 2 * need) | ~known[x] | ~known[x - far]
                x = x[fits & (np.minimum(rest[x], rest[x - far]) >= need)]
                if len(x):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in (gid[x], gid[x - far], comp[x], comp[x - far])],
                        names=["gid", "hub", "comp", "hub_comp"])
    return run


def needed(n, m, numerator: int, denominator: int):
    """Shared shingles that sets of these sizes need."""
    return -(-numerator * (n + m) // (numerator + denominator))


def list_pairs(
    left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...] | None, numerator: int, denominator: int,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Group pairs of one list (or of two blocks of it) that lie in different components and can reach the
    threshold with this shingle as the first they share and with their signatures. Columns: gid, place, component
    (-1: several), signature (a row of numbers), whether there is one (a group of one class), and the shingles in
    front of this one (a row of numbers, 0 for none)."""
    same = right is None
    order = np.argsort(left[1], kind="stable")  # by size, then position
    gid, place, comp, sig, known, before = (c[order] for c in left)
    n, at = place >> 32, place & 0xFFFFFFFF
    if same:
        others, other_n, other_at, other_comp, other_sig, other_known, other_before = gid, n, at, comp, sig, known, before
    else:
        order = np.argsort(right[1], kind="stable")
        others, other_place, other_comp, other_sig, other_known, other_before = (c[order] for c in right)
        other_n, other_at = other_place >> 32, other_place & 0xFFFFFFFF
    lows = np.searchsorted(other_n * denominator, n * numerator, "left")
    highs = np.searchsorted(other_n * numerator, n * denominator, "right")
    for i in range(len(gid)):
        a, b = (i + 1 if same else lows[i]), highs[i]
        if a >= b:
            continue
        fits = (other_comp[a:b] != comp[i]) | (comp[i] < 0)
        rest = np.minimum(n[i] - at[i], other_n[a:b] - other_at[a:b])
        need = needed(n[i], other_n[a:b], numerator, denominator)
        fits &= (rest >= need) & (others[a:b] != gid[i])
        live = np.flatnonzero(fits)
        earlier = before[i][before[i] != 0]
        if len(live) and len(earlier):
            live = live[~(other_before[a:b][live][:, :, None] == earlier).any(axis=(1, 2))]
        if len(live) and known[i]:
            apart = np.bitwise_count(other_sig[a:b][live] ^ sig[i]).sum(axis=1)
            live = live[(n[i] + other_n[a:b][live] - apart >= 2 * need[live]) | ~other_known[a:b][live]]
        if len(live):
            hit = others[a:b][live]
            yield np.minimum(hit, gid[i]), np.maximum(hit, gid[i])


def _signatures(sigs: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures as rows of numbers, and whether they are there."""
    raw = b"".join(s or bytes(SIGNATURE // 8) for s in sigs)
    return np.frombuffer(raw, np.uint64).reshape(len(sigs), SIGNATURE // 64), np.array([s is not None for s in sigs], bool)


def _with_rows(columns: list[np.ndarray], sigs: list[bytes | None], before: pa.Array) -> tuple[np.ndarray, ...]:
    """The plain columns, the signatures as rows of numbers, whether they are there, and the shingles in front."""
    sig, known = _signatures(sigs)
    lengths = before.value_lengths().to_numpy(zero_copy_only=False)
    front = np.zeros((len(sigs), BEFORE), np.int64)
    front[np.arange(BEFORE) < lengths[:, None]] = before.flatten().to_numpy(zero_copy_only=False)
    return (*columns, sig, known, front)


def _pairs(numerator: int, denominator: int):
    """From postings sorted by shingle: pairs (a, b), and rows of overlong lists (token, row, gid, place, comp, sig,
    before)."""
    names = ["a", "b", "token", "row", "gid", "place", "comp", "sig", "before"]

    def batch_of(pairs: list, hot: list) -> Iterator[pa.RecordBatch]:
        if pairs:
            a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
            ab = np.unique(np.stack([a, b], axis=1), axis=0)
            rest = [*[pa.nulls(len(ab), pa.int64())] * 5, pa.nulls(len(ab), pa.binary())]
            rest.append(pa.nulls(len(ab), pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1]), *rest], names=names)
        if hot:
            *columns, sig, known, front = (np.concatenate(c) for c in zip(*hot))
            empty = [pa.nulls(len(known), pa.int64())] * 2
            sigs = pa.array([s.tobytes() if k else None for s, k in zip(sig, known)], pa.binary())
            lists = pa.array([f[f != 0] for f in front], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*empty, *[pa.array(c.astype(np.int64)) for c in columns], sigs, lists], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []  # the open list
        current, size, written = None, 0, 0

        def close() -> Iterator[pa.RecordBatch]:
            if held and not written:
                columns = tuple(np.concatenate(c) for c in zip(*held))
                if len(columns[0]) > 1 and ((columns[2] != columns[2][0]).any() or columns[2][0] < 0):
                    yield from batch_of(list(list_pairs(columns, None, numerator, denominator)), [])

        for batch in batches:
            token, *own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            own = _with_rows(own, batch.column(4).to_pylist(), batch.column(5))
            cuts = np.flatnonzero(token[1:] != token[:-1]) + 1 if len(token) else []
            edges = [0, *cuts, len(token)] if len(token) else []
            for a, b in zip(edges[:-1], edges[1:]):
                if token[a] != current:
                    yield from close()
                    held, size, written, current = [], 0, 0, token[a]
                held.append(tuple(c[a:b] for c in own))
                size += b - a
                if size > LIST_ROWS:
                    rows = tuple(np.concatenate(c) for c in zip(*held))
                    count = len(rows[0])
                    number = np.arange(written, written + count)
                    yield from batch_of([], [(np.full(count, current), number, *rows)])
                    written, held = written + count, []
        yield from close()
    return run


def _block_pairs(numerator: int, denominator: int):
    """From rows sorted by (token, x, y, block): pairs of the two blocks of each group of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            block, *columns = (np.concatenate(c) for c in zip(*held))
            first = block == key[1]
            left = tuple(c[first] for c in columns)
            right = None if key[1] == key[2] else tuple(c[~first] for c in columns)
            for a, b in list_pairs(left, right, numerator, denominator):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            keys = np.stack(columns[:3], axis=1)
            columns = _with_rows(columns, batch.column(7).to_pylist(), batch.column(8))
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)] if len(keys) else []
            for a, b in zip(edges[:-1], edges[1:]):
                if tuple(keys[a]) != key:
                    yield from close()
                    key, held = tuple(keys[a]), []
                held.append(tuple(c[a:b] for c in columns[3:]))
        yield from close()
    return run


def _possible(numerator: int, denominator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m, x, y = (batch.column(i).to_pylist() for i in range(6))
            kept = [
                n[i] + m[i] - differing(x[i], y[i]) >= 2 * needed(n[i], m[i], numerator, denominator)
                for i in range(len(a))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, k in zip(c, kept) if k], pa.int64()) for c in (a, b)], names=["a", "b"])
    return run


def _verify(size: int, numerator: int, denominator: int):
    """From rows (hub, salt, other, body) with the hub's own text first: the pairs that reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, None
        for batch in batches:
            links = []
            hubs, others = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for a, b, own in zip(hubs, others, _texts_to_sets(batch.column(3), size)):
                if b is None:
                    hub, hub_set = a, own
                elif a == hub:
                    both = len(np.intersect1d(hub_set, own, assume_unique=True))
                    if denominator * both >= numerator * (len(hub_set) + len(own) - both):
                        links.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in links], pa.int64()) for i in range(2)], names=["a", "b"])
    return run


def joined(roots: DataFrame, found: DataFrame) -> DataFrame:
    """Components (node, root) after more links: only the roots that these meet are looked at again. The tables given
    are dropped."""
    links = found
    for side in ("a", "b"):
        links = links.join(roots.withColumnRenamed("root", "r"), F.col(side) == F.col("node"), "left").withColumn(
            side, F.coalesce("r", side)).drop("node", "r")
    more = components(links)
    moved = roots.join(more.select(F.col("node").alias("old"), F.col("root").alias("new")), F.col("root") == F.col("old"), "left")
    moved = moved.select("node", F.coalesce("new", "root").alias("root"))
    done = common.keep(moved.unionByName(more), "components")
    common.drop(roots, found, more)
    return done


class Join:
    """One run of the join over documents: its tables and steps."""

    def __init__(self, docs: DataFrame, text: str, size: int, numerator: int, denominator: int):
        self.size, self.numerator, self.denominator = size, numerator, denominator
        body = F.coalesce(F.col(text), F.lit(""))
        self.docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("body"))
        spark = docs.sparkSession
        shared = spark.sparkContext.broadcast(frequent(self.docs, size))
        run = _prefixes(size, numerator, denominator, shared, common.arrow_schema(ROWS))
        hashed = self.docs.select("doc_id", F.xxhash64("body").alias("th"), "body")
        self.found = common.keep(common.map_arrow(hashed, run, ROWS), "ngrams")
        self.rows = self.found.select("doc_id", "th", "n", "dig", "gid", "bits", "sig")
        first = F.min(F.struct("doc_id", "th")).alias("first")
        rest = [F.max(c).alias(c) for c in ("n", "gid", "bits", "sig")]
        classes = self.rows.filter("n > 0").groupBy("dig").agg(first, F.min("doc_id").alias("least"), *rest)
        self.classes = common.keep(classes.withColumn("cid", F.monotonically_increasing_id()), "ngrams")
        self.groups = self.classes.groupBy("gid").agg(F.min("cid").alias("cid"), F.count(F.lit(1)).alias("members"))

    def parts(self) -> int:
        return int(self.docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(self, df: DataFrame, keys: list, order: list) -> DataFrame:
        """Rows of a key together and in order, as streams. They are dealt by a hash of the keys: after a join on the keys
        themselves Spark leaves the exchange out, and when the join turns into a broadcast it may read the rows of a key
        in several tasks, which would cut a list into parts that never meet."""
        return df.repartition(self.parts(), F.xxhash64(*keys)).sortWithinPartitions(*keys, *order)

    def postings(self) -> DataFrame:
        """Prefix shingles that occur in several groups, each with the BEFORE last of them in front of it: a shingle of one
        group alone can be no earlier one that two groups share, so it travels through one narrow shuffle only."""
        lists = self.found.filter("prefix is not null").select("gid", "n", "prefix").dropDuplicates(["gid"])
        lists = common.keep(lists, "ngrams")
        many = lists.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("k"))
        own = lists.select("gid", "n", F.posexplode("prefix").alias("at", "token")).select(
            "token", "gid", F.shiftleft(F.col("n").cast("bigint"), 32).bitwiseOR(F.col("at")).alias("place"))
        shared = own.join(many.filter("k > 1").select("token"), "token")
        in_front = Window.partitionBy("gid").orderBy("place")
        before = F.array_compact(F.array(*[F.lag("token", k).over(in_front) for k in range(1, BEFORE + 1)]))
        done = common.keep(shared.select("token", "gid", "place", before.alias("before")), "ngrams")
        common.drop(lists)
        return done

    def places(self, roots: DataFrame) -> DataFrame:
        """Each group with its component (-1 for several) and, if it is one class, the signature."""
        rows = self.classes.join(roots, F.col("cid") == F.col("node"), "left")
        comp = F.coalesce("root", "cid")
        found = rows.groupBy("gid").agg(
            F.min(comp).alias("low"), F.max(comp).alias("high"), F.max("sig").alias("sig"), F.count(F.lit(1)).alias("k"))
        one = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.lit(-1))
        return found.select("gid", one.alias("comp"), F.when(F.col("k") == 1, F.col("sig")).alias("sig"))

    def star_pairs(self, postings: DataFrame, roots: DataFrame | None, seed: int) -> DataFrame:
        """Each group with the group of another component that it meets most often as the first of a list, as pairs
        of first classes. Which is first changes with the seed. Without roots every group is a component."""
        rows = postings.withColumn("comp", F.col("gid"))
        if roots is not None:
            rows = postings.join(self.places(roots).select("gid", "comp"), "gid")
        rows = rows.select("token", "gid", "place", "comp")
        rows = self.dealt(rows, [F.col("token")], [F.xxhash64("gid", F.lit(seed)), F.col("gid")])
        met = common.map_arrow(rows, _stars, "gid bigint, hub bigint, n bigint, m bigint")
        fits = F.least("n", "m") * self.denominator >= F.greatest("n", "m") * self.numerator
        best = met.filter(fits).groupBy("gid", "hub").agg(F.count(F.lit(1)).alias("k"))
        best = best.groupBy("gid").agg(F.max_by("hub", F.struct("k", "hub")).alias("hub"))
        return self.first_classes(best)

    def near_pairs(self, postings: DataFrame, roots: DataFrame, seed: int) -> DataFrame:
        """Up to TRIES pairs of each component with others, as pairs of first classes. The lists are in random order, each
        in its own, and groups that stand near each other meet. Of a component and a share of its pairs, dealt by their hash, the pair
        met most often is taken."""
        rows = postings.join(self.places(roots), "gid").select("token", "gid", "place", "comp", "sig")
        rows = self.dealt(rows, [F.col("token")], [F.xxhash64("gid", "token", F.lit(seed)), F.col("gid")])
        run = _neighbours(self.numerator, self.denominator)
        met = common.map_arrow(rows, run, "gid bigint, hub bigint, comp bigint, hub_comp bigint")
        met = met.select(F.least("gid", "hub").alias("gid"), F.greatest("gid", "hub").alias("hub"),
                         F.explode(F.array("comp", "hub_comp")).alias("comp"))
        met = met.groupBy("comp", "gid", "hub").agg(F.count(F.lit(1)).alias("k"))
        share = F.pmod(F.xxhash64("gid", "hub", F.lit(seed)), F.lit(TRIES)).alias("share")
        best = met.groupBy("comp", share).agg(F.max_by(F.struct("gid", "hub"), F.struct("k", "gid", "hub")).alias("pair"))
        return self.first_classes(best.select("pair.gid", "pair.hub").distinct())

    def first_classes(self, best: DataFrame) -> DataFrame:
        """Pairs of groups (gid, hub) as pairs of their first classes."""
        names = self.groups.select(F.col("gid").alias("hub"), F.col("cid").alias("a"))
        return best.join(names, "hub").join(self.groups, "gid").select("a", F.col("cid").alias("b"))

    def inner_pairs(self) -> DataFrame:
        """Each class of a group with its first class."""
        first = self.groups.filter("members > 1").select("gid", F.col("cid").alias("a"))
        return self.classes.join(first, "gid").filter("cid <> a").select("a", F.col("cid").alias("b"))

    def texts(self, cids: DataFrame) -> DataFrame:
        """The text of one document of each class asked for."""
        asked = self.classes.join(cids.distinct(), "cid", "left_semi").select("cid", "first.doc_id", "first.th")
        docs = self.docs.withColumn("th", F.xxhash64("body"))
        same = asked.doc_id.eqNullSafe(docs.doc_id) & (asked.th == docs.th)
        return asked.join(docs, same).select("cid", "body")

    def possible(self, pairs: DataFrame) -> DataFrame:
        """Pairs that the bitmaps do not rule out, as (a, b) with the smaller number first."""
        sides = self.classes.select("cid", "n", "bits")
        x, y = (sides.select(F.col("cid").alias(c), F.col("n").alias(c + "n"), F.col("bits").alias(c + "x"))
                for c in "ab")
        rows = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        rows = rows.join(x, "a").join(y, "b").select("a", "b", "an", "bn", "ax", "bx")
        kept = common.map_arrow(rows, _possible(self.numerator, self.denominator), "a bigint, b bigint")
        return common.keep(kept, "ngrams")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that reach the threshold, by their texts. The table of pairs is dropped."""
        texts = common.keep(self.texts(pairs.select(F.explode(F.array("a", "b")).alias("cid"))), "ngrams")
        salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_ROWS).cast("int").alias("salts"))
        hubs = texts.withColumnRenamed("cid", "a").join(salts, "a").select(
            "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
            F.lit(None).cast("bigint").alias("b"), "body")
        members = pairs.join(salts, "a").join(texts.withColumnRenamed("cid", "b"), "b").select(
            "a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), "b", "body")
        rows = self.dealt(hubs.union(members), [F.col("a"), F.col("salt")], [F.col("b")])
        links = common.map_arrow(rows, _verify(self.size, self.numerator, self.denominator), "a bigint, b bigint")
        done = common.keep(links, "ngrams")
        common.drop(texts, pairs)
        return done

    def cross_pairs(self, postings: DataFrame, places: DataFrame, roots: DataFrame) -> DataFrame:
        """All candidate pairs of classes that lie in different components, with ``sure`` where the signatures have
        been compared."""
        rows = postings.join(places, "gid")
        spread = rows.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        spread = spread.filter("low <> high or low < 0").select("token")
        rows = rows.join(spread, "token", "left_semi").select("token", "gid", "place", "comp", "sig", "before")
        schema = (
            "a bigint, b bigint, token bigint, row bigint, gid bigint, place bigint, comp bigint, sig binary, "
            "before array<bigint>")
        run = _pairs(self.numerator, self.denominator)
        found = common.keep(common.map_arrow(self.dealt(rows, [F.col("token")], []), run, schema), "ngrams")
        hot = found.filter("token is not null").withColumn("block", F.expr(f"row div {LIST_ROWS}"))
        blocks = hot.groupBy("token").agg(F.max("block").alias("most"))
        other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("most"))).alias("other")
        hot = hot.join(blocks, "token").select("token", "block", "gid", "place", "comp", "sig", "before", other)
        hot = hot.select("token", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                         "block", "gid", "place", "comp", "sig", "before")
        run = _block_pairs(self.numerator, self.denominator)
        more = common.map_arrow(
            self.dealt(hot, [F.col("token"), F.col("x"), F.col("y")], []), run, "a bigint, b bigint")
        mixed = places.filter("comp < 0").select(F.col("gid").alias("a"), F.col("gid").alias("b"))
        groups = found.filter("token is null").select("a", "b").union(more).union(mixed).distinct()
        placed = self.classes.join(roots, F.col("cid") == F.col("node"), "left").join(
            self.groups.select("gid", "members"), "gid")
        x, y = (placed.select(F.col("gid").alias(g), F.col("cid").alias(g + "c"),
                              F.coalesce("root", "cid").alias(g + "p"), (F.col("members") == 1).alias(g + "one"))
                for g in "ab")
        pairs = groups.join(x, "a").join(y, "b").filter("ap <> bp and (a <> b or ac < bc)")
        done = common.keep(pairs.select(F.least("ac", "bc").alias("a"), F.greatest("ac", "bc").alias("b"),
                                        (F.col("aone") & F.col("bone")).alias("sure")), "ngrams")
        common.drop(found)
        return done

    def roots(self) -> DataFrame:
        """(node, root) of all classes that are linked with a class of a smaller number."""
        postings = self.postings()
        near = self.possible(self.inner_pairs().union(self.star_pairs(postings, None, 0)))
        links, number = self.verified(near), 0
        roots = components(links)
        first = found = links.count()
        common.drop(links)
        while found * WORTH > first:
            number += 1
            links = self.verified(self.possible(self.star_pairs(postings, roots, number)))
            found = links.count()
            roots = joined(roots, links)
        entries, had = postings.count(), 0
        while (now := roots.count()) > had and (not had or (now - had) ** 2 > entries):
            number, had = number + 1, now
            roots = joined(roots, self.verified(self.possible(self.near_pairs(postings, roots, number))))
        pairs = self.cross_pairs(postings, self.places(roots), roots)
        common.drop(postings)
        unsure = self.possible(pairs.filter("not sure").select("a", "b"))
        last = common.keep(pairs.filter("sure").select("a", "b").union(unsure), "ngrams")
        common.drop(pairs, unsure)
        return roots if last.isEmpty() else joined(roots, self.verified(last))

    def result(self) -> DataFrame:
        placed = self.classes.join(self.roots(), F.col("cid") == F.col("node"), "left")
        placed = placed.select("dig", "least", F.coalesce("root", "cid").alias("comp"))
        least = placed.groupBy("comp").agg(F.min("least").alias("component_id"))
        names = placed.join(least, "comp").select("dig", "comp", "component_id")
        found = self.rows.select("doc_id", "n", "dig", "th").join(names, "dig", "left")
        return found.select(
            "doc_id", F.col("n").cast("bigint").alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"), "th", "comp")


def link(
    docs: DataFrame, *, text: str = "text", size: int = SIZE, numerator: int = NUMERATOR,
    denominator: int = DENOMINATOR,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id reachable by links between sets with
    denominator * shared >= numerator * all), th (xxhash64 of the text, null as empty)."""
    return Join(docs, text, size, numerator, denominator).result().drop("comp")


def first_of_each(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """One document of each component with all its columns: the smallest id (a null one last), then the smallest hash
    of the text. Documents without shingles are linked with nothing: each of their ids and texts stays once."""
    sizes = {"size": SIZE, "numerator": NUMERATOR, "denominator": DENOMINATOR} | options
    found = Join(docs, text, **sizes).result()
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "th")
    first = found.filter("comp is not null").groupBy("comp").agg(F.min(order).alias("first"))
    alone = found.filter("comp is null").select("doc_id", "th").distinct()
    kept = first.select("first.doc_id", "first.th").union(alone)
    names = [F.col(f"`{c}`") for c in docs.columns]
    body = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.struct(*names).alias("row"), F.col("doc_id").cast("bigint").alias("k"), body.alias("h"))
    same = rows.k.eqNullSafe(kept.doc_id) & (rows.h == kept.th)
    rows = rows.join(kept, same, "left_semi")
    return rows.dropDuplicates(["k", "h"]).select("row.*")


def op7_ngram_join(spark, sf_dir: str) -> DataFrame:
    found = link(common.table(spark, sf_dir, "documents"), size=4, numerator=85, denominator=100)
    return found.select("doc_id", "n_shingles", "component_id")


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
    r"'[^\x20\x09-\x0D]+')"

OP7_SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () r, doc_id, coalesce({_WORDS}, []) w FROM documents),
s AS (SELECT DISTINCT r, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END g
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) n FROM s GROUP BY r),
l AS (SELECT x.r a, y.r b FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r GROUP BY x.r, y.r
      HAVING 100 * count(*) >= 85 * ((SELECT n FROM n WHERE r = x.r) + (SELECT n FROM n WHERE r = y.r) - count(*))),
reach AS (SELECT r a, r b FROM d UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a r, min(e.doc_id) component_id FROM reach JOIN d e ON e.r = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0) n_shingles, component_id FROM d LEFT JOIN n USING (r) JOIN c USING (r)
"""
