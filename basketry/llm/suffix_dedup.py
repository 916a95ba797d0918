"""Removal of long repeated byte strings: suffixes at anchors, sorted deep-shallow, give the repeated windows.

A window is ``length`` bytes of a text. Its anchor is the leftmost of its ``KMER``-byte strings with the smallest
hash, so equal windows have the same anchor at the same distance. Neighbouring windows with one anchor form a run;
the bytes that a run covers are its context. Only runs whose anchor string occurs in another run can repeat.

1. Runs with equal contexts are counted together; all windows of such runs repeat.
2. Of every other context with a shared anchor, the bytes from the anchor on (a suffix) and the bytes before it, read
   backwards, are each sorted with their common prefixes. For each distance of a window from the anchor, the
   neighbours that agree far enough to the right and to the left are the windows that repeat.

Contexts of one anchor string are a stream of at most GROUP_ROWS rows. Beyond that, windows are counted by digest in
two steps (bytes shared by CELL neighbouring distances, then single distances), which combine before the shuffle.

Defined cases: a null or empty text has no bytes and keeps none; texts below the length keep all; matches never cross
documents but may overlap in one; repeated rows remove each other's windows; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, words
from .suffix_sort import common_prefixes, deep_shallow_order

LENGTH = 400
KMER = 32
SLICE = 1 << 18
# Longer texts are scanned in segments; a place in a slice must fit PLACE_BITS.
SEGMENT = 1 << 22
PLACE_BITS = 24
GROUP_ROWS = 4096
BLOCK_ROWS = 16_384
CELL = 16

RUNS = "key bigint, digest bigint, doc bigint, th bigint, start bigint, wins int, off int"
NO_ID = -(1 << 63)


def _words_at(padded: np.ndarray, size: int) -> np.ndarray:
    """The eight bytes from each place on, as numbers."""
    return np.ndarray((size,), "<u8", buffer=padded, strides=(1,))


def kmer_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the KMER bytes from each place on (zeros behind the end)."""
    size = len(data)
    padded = np.concatenate([data, np.zeros(KMER + 8, np.uint8)])
    eight = _words_at(padded, size + KMER)
    with np.errstate(over="ignore"):
        h = np.zeros(size, np.uint64)
        for k in range(KMER // 8):
            h += eight[8 * k:8 * k + size]
            h *= np.uint64(words.MIX[k % 2])
            h ^= h >> np.uint64(29 + 3 * (k % 2))
    return words.mix(h)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def _span_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of at least 256 bytes, from overlapping blocks of 256 that cover it."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = _words_at(padded, len(data) + 1)
    blocks = int(-(-(ends - starts).max() // 256)) if len(starts) else 0
    with np.errstate(over="ignore"):
        h = words.mix((ends - starts).astype(np.uint64))
        for block in range(blocks):
            at = np.minimum(starts + 256 * block, ends - 256)
            for k in range(32):
                h += eight[at + 8 * k]
                h *= np.uint64(words.MIX[k % 2])
                h ^= h >> np.uint64(29)
    return words.mix(h)


def runs_of(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of all texts of a slice: first window, windows, anchor (places in the slice), key, digest."""
    none = np.zeros(0, np.int64)
    sizes = np.diff(bounds)
    if len(data) < length or not (sizes >= length).any():
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashes = kmer_hashes(data)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    ranked = (hashes & ~mask) | np.arange(len(data), dtype=np.uint64)
    least = sliding_min(ranked[:len(data) - KMER + 1], length - KMER + 1)
    begins, counts = bounds[:-1][sizes >= length], sizes[sizes >= length] - length + 1
    total = np.cumsum(counts)
    window = np.repeat(begins - (total - counts), counts) + np.arange(total[-1])
    anchor = (least[window] & mask).astype(np.int64)
    new = np.ones(len(window), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(new)
    wins = np.diff(np.append(first, len(window)))
    start, anchor = window[first], anchor[first]
    digest = _span_digests(data, start, start + wins - 1 + length)
    with np.errstate(over="ignore"):
        digest = words.mix(digest + (anchor - start).astype(np.uint64) * np.uint64(words.ROOT))
    return start, wins, anchor, hashes[anchor], digest


def _segments(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(row, begin, end) with ends overlapping so that every window lies in exactly one segment of a text."""
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        at = a
        while True:
            end = min(b, at + SEGMENT + length - 1)
            yield row, at, end
            at += SEGMENT
            if at + length > b:
                break


def _runs(length: int):
    names = [f.split()[0] for f in RUNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            data, offsets = common.text_bytes(batch.column(2))
            held: list[tuple[int, int, int]] = []
            size = 0

            def close() -> Iterator[pa.RecordBatch]:
                part = np.concatenate([data[a:b] for _, a, b in held])
                bounds = np.cumsum([0] + [b - a for _, a, b in held])
                start, wins, anchor, key, digest = runs_of(part, bounds, length)
                own = np.searchsorted(bounds, start, "right") - 1
                row = np.array([r for r, _, _ in held])[own] if len(own) else own
                place = start - bounds[own] + np.array([a for _, a, _ in held])[own] - offsets[row]
                yield pa.RecordBatch.from_arrays([
                    pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(docs[row]),
                    pa.array(hashes[row]), pa.array(place), pa.array(wins.astype(np.int32)),
                    pa.array((anchor - start).astype(np.int32))], names=names)

            for row, a, b in _segments(offsets, length):
                if b - a < length:
                    continue
                held.append((row, a, b))
                size += b - a
                if size >= SLICE:
                    yield from close()
                    held, size = [], 0
            if held:
                yield from close()
    return run


CONTEXTS = "key bigint, doc bigint, th bigint, start bigint, wins int, off int, solved boolean, context binary"


def _contexts(length: int, out: pa.Schema):
    """From rows (doc, th, body, runs): the bytes of each run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, th, text, runs in zip(*(batch.column(i).to_pylist() for i in range(4))):
                raw = text.encode()
                for r in runs:
                    end = r["start"] + r["wins"] - 1 + length
                    rows.append((r["key"], doc, th, r["start"], r["wins"], r["off"], r["solved"], raw[r["start"]:end]))
                    if len(rows) == 4096:
                        yield common.batch(out, [list(c) for c in zip(*rows)])
                        rows = []
            if rows:
                yield common.batch(out, [list(c) for c in zip(*rows)])
    return run


def repeated(contexts: list[bytes], off: np.ndarray, wins: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest distance from the anchor of the windows that repeat among the contexts; largest -1 for
    none. The windows of a context all hold its anchor, so what they cover is one span."""
    count = len(contexts)
    low, high = np.full(count, length), np.full(count, -1)
    reach = length - KMER
    right, left = np.zeros((count, length), np.uint8), np.zeros((count, reach), np.uint8)
    for i, raw in enumerate(contexts):
        own = np.frombuffer(raw, np.uint8)
        right[i, :len(own) - off[i]] = own[off[i]:]
        left[i, :off[i]] = own[:off[i]][::-1]
    orders = [deep_shallow_order(m) for m in (right, left)]
    shared = [common_prefixes(m, order) for m, order in zip((right, left), orders)]
    best = []
    for order, lcp in zip(orders, shared):
        most = np.empty(count, np.int64)
        most[order] = np.maximum(lcp, np.append(lcp[1:], 0))
        best.append(most)
    # Distances at which the neighbours in both orders agree far enough; outside, no window can repeat.
    first = np.maximum(off - wins + 1, length - best[0])
    last = np.minimum(off, best[1])
    live = np.flatnonzero(first <= last)
    if not len(live):
        return low, high
    first, last = first[live], last[live]
    group = np.empty((2, count), np.int64)
    for distance in range(int(first.min()), int(last.max()) + 1):
        open_ = live[(first <= distance) & (distance <= last)]
        if len(open_) < 2:
            continue
        group[0, orders[0]] = np.cumsum(shared[0] < length - distance)
        group[1, orders[1]] = np.cumsum(shared[1] < distance)
        code = group[0, open_] * (count + 1) + group[1, open_]
        order = np.argsort(code, kind="stable")
        code = code[order]
        twin = np.zeros(len(code), bool)
        twin[1:] = code[1:] == code[:-1]
        twin[:-1] |= twin[1:]
        hit = open_[order[twin]]
        low[hit] = np.minimum(low[hit], distance)
        high[hit] = distance
    return low, high


SPANS = "doc bigint, th bigint, begin bigint, end bigint"
_SPAN_NAMES = ["doc", "th", "begin", "end"]


def _sorted_spans(length: int):
    """From contexts sorted by key: spans of the unsolved ones, block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def spans(rows: pa.Table) -> pa.RecordBatch:
            start, wins, off = (rows.column(i).to_numpy() for i in (3, 4, 5))
            low, high = repeated(rows.column(7).to_pylist(), off.astype(np.int64), wins.astype(np.int64), length)
            kept = (high >= 0) & ~rows.column(6).to_numpy()
            anchor = (start + off)[kept]
            return pa.RecordBatch.from_arrays(
                [pa.array(rows.column(i).to_numpy()[kept]) for i in (1, 2)]
                + [pa.array(anchor - high[kept]), pa.array(anchor - low[kept] + length)], names=_SPAN_NAMES)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                rows = pa.Table.from_batches(held).combine_chunks()
                key = rows.column(0).to_numpy()
                cut = int(np.searchsorted(key, key[-1], "left"))  # the last key may go on
                if cut:
                    yield spans(rows.slice(0, cut))
                held, size = rows.slice(cut).to_batches(), len(rows) - cut
        if held:
            yield spans(pa.Table.from_batches(held))
    return run


_MARK = "key bigint, doc bigint, th bigint, start bigint, off int, solved boolean, at int, mark binary"


def _marks(length: int, out: pa.Schema, cells: bool):
    """Digests of the bytes that all windows of a cell share, or of single windows of the cells given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for key, doc, th, start, wins, off, solved, raw, *live in zip(*columns):
                least = off - wins + 1
                asked = range(least // CELL, off // CELL + 1) if cells else sorted(set(live[0]))
                for cell in asked:
                    near, far = cell * CELL, cell * CELL + CELL - 1
                    steps = [(near, far, cell)] if cells else [
                        (d, d, d) for d in range(max(near, least), min(far, off) + 1)]
                    for x, y, at in steps:
                        mark = xxhash.xxh3_128_digest(raw[off - x:off - y + length])
                        rows.append((key, doc, th, start, off, solved, at, mark))
                if len(rows) >= 4096:
                    yield common.batch(out, [list(c) for c in zip(*rows)])
                    rows = []
            if rows:
                yield common.batch(out, [list(c) for c in zip(*rows)])
    return run


def _counted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """The same spans for anchor strings with very many contexts, from counts of digests."""
    schema = common.arrow_schema(_MARK)
    own = ["key", "doc", "th", "start"]

    def several(marks: DataFrame) -> DataFrame:
        many = marks.groupBy("key", "at", "mark").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
        return marks.join(many.drop("k"), ["key", "at", "mark"])

    cells = several(common.map_arrow(contexts, _marks(length, schema, True), _MARK))
    live = cells.groupBy(*own).agg(F.collect_set("at").alias("cells"))  # at most length / CELL of them
    names = [F.col(c) for c in ("key", "doc", "th", "start", "wins", "off", "solved", "context", "cells")]
    rows = contexts.join(live, own).select(*names)
    windows = several(common.map_arrow(rows, _marks(length, schema, False), _MARK)).filter("not solved")
    found = windows.groupBy("doc", "th", "start", "off").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    anchor = F.col("start") + F.col("off")
    return found.select("doc", "th", (anchor - F.col("high")).alias("begin"), (anchor - F.col("low") + length).alias("end"))


def repeated_spans(rows: DataFrame, length: int = LENGTH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Covered spans (doc, th, begin, end), overlapping, from rows (doc, th, body)."""
    spark = rows.sparkSession
    runs = common.keep(common.map_arrow(rows.select("doc", "th", "body"), _runs(length), RUNS), "suffixes")
    keys = runs.groupBy("key").agg(
        F.count(F.lit(1)).alias("k"), F.min("digest").alias("least"), F.max("digest").alias("most"))
    # As a table of its own: joined straight from its aggregate, a passage that many texts share would meet in one task.
    keys = common.keep(
        keys.filter("k > 1").select("key", (F.col("least") == F.col("most")).alias("alike")), "suffixes")
    shared = common.keep(runs.join(keys, "key"), "suffixes")
    end = (F.col("start") + F.col("wins") - 1 + length).alias("end")
    whole = ["doc", "th", F.col("start").alias("begin"), end]
    alike = shared.filter("alike").select(*whole)
    mixed = shared.filter("not alike")
    first = F.min(F.struct("doc", "th", "start", "wins", "off")).alias("first")
    classes = common.keep(mixed.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("k"), first), "suffixes")
    twins = mixed.join(classes.filter("k > 1").select("key", "digest"), ["key", "digest"]).select(*whole)
    sizes = classes.groupBy("key").agg((F.count(F.lit(1)) > group_rows).alias("hot"))
    asked = classes.select("key", "first.*", (F.col("k") > 1).alias("solved"))
    lists = asked.groupBy("doc", "th").agg(F.collect_list(F.struct("key", "start", "wins", "off", "solved")).alias("runs"))
    cut = rows.join(lists, ["doc", "th"]).select("doc", "th", "body", "runs")
    contexts = common.map_arrow(cut, _contexts(length, common.arrow_schema(CONTEXTS)), CONTEXTS)
    hot_keys = sizes.filter("hot").select("key")
    names = [f.split()[0] for f in CONTEXTS.split(", ")]
    contexts = common.keep(contexts, "suffixes")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    usual = contexts.join(hot_keys, "key", "left_anti").select(*names)
    usual = usual.repartition(parts, "key").sortWithinPartitions("key")
    hot = contexts.join(hot_keys, "key", "left_semi").select(*names)
    found = common.map_arrow(usual, _sorted_spans(length), SPANS)
    return alike.union(twins).union(found).union(_counted_spans(hot, length))


RESULT = (
    "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
    "spans array<struct<begin:bigint,end:bigint>>, kept binary"
)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _removed(out: pa.Schema, with_kept: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw = (text or "").encode()
                runs = merged([(s["begin"], s["end"]) for s in spans or ()])
                edges = [0, *(x for run in runs for x in run), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((
                    doc_id, len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(),
                    [{"begin": a, "end": b} for a, b in runs], kept if with_kept else None,
                ))
            if rows:
                yield common.batch(out, [list(c) for c in zip(*rows)])
    return run


def remove_repeats(
    docs: DataFrame, *, text: str = "text", length: int = LENGTH, group_rows: int = GROUP_ROWS, with_kept: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (maximal removed byte runs) and,
    on demand, the kept bytes, which need not be valid UTF-8."""
    if length < 256:
        raise ValueError("the length must be 256 bytes at least")
    body = F.coalesce(F.col(text), F.lit("")).alias("body")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), body,
    ).withColumn("th", F.xxhash64("body"))
    spans = repeated_spans(rows, length, group_rows)
    lists = spans.groupBy("doc", "th").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    found = rows.join(lists, ["doc", "th"], "left").select("doc_id", "body", "spans")
    done = common.map_arrow(found, _removed(common.arrow_schema(RESULT), with_kept), RESULT)
    return done if with_kept else done.drop("kept")


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
