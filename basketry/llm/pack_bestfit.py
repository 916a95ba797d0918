"""Best-fit-decreasing packing into id matrices, written as binary columns.

A document longer than a row is split into full rows and a rest, without loss. The rests of a block, longest first,
each go to the row with the least room that still takes them; a segment tree over the capacities finds that room in
logarithmic time. A packed row holds its ids padded to the capacity, the cumulative segment lengths, and position
numbers that restart at every segment.

Every task packs its own rows in blocks of BLOCK_TOKENS ids: bounded memory, no shuffle, the same result on retry.
Rows filled to less than FULL are opened again with the next block.

Defined cases: a null or empty text is the closing id alone; repeated rows are packed one by one; an empty table
gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

CAPACITY = 2048
END_ID = 2
PAD_ID = 0
BLOCK_TOKENS = 4 << 20
FULL = 0.97

Piece = tuple[int, int, int]  # document number, start, length

SCHEMA = (
    "sequence_id bigint, n_tokens int, doc_ids array<bigint>, starts array<bigint>, cu_seqlens array<int>, "
    "ids binary, position_ids binary"
)


class RoomTree:
    """Counts of open rows by room left, and the least room from a given one on that any row has."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def change(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def least(self, room: int) -> int | None:
        """Climb until a right sibling holds a row, then go down to its leftmost one."""
        at = room + self.size
        if self.count[at]:
            return room
        while at > 1 and (at & 1 or not self.count[at + 1]):
            at >>= 1
        if at <= 1:
            return None
        at += 1
        while at < self.size:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        return at - self.size


def best_fit(pieces: list[Piece], capacity: int) -> list[list[Piece]]:
    """Rows of pieces; equal lengths keep their order, equal rooms take the row opened last."""
    tree, rows = RoomTree(capacity), []
    by_room: dict[int, list[int]] = defaultdict(list)
    for piece in sorted(pieces, key=lambda p: -p[2]):
        room = tree.least(piece[2])
        if room is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = by_room[room].pop()
            tree.change(room, -1)
        rows[row].append(piece)
        by_room[room - piece[2]].append(row)
        tree.change(room - piece[2], 1)
    return rows


def _run(path: str, capacity: int, end: int, pad: int, block: int, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.tokenizer(path)
        task = TaskContext.get().partitionId() << 33
        position = np.dtype("<u2" if capacity <= 1 << 16 else "<u4")
        every = np.arange(capacity)
        docs: dict[int, tuple] = {}
        pool: list[Piece] = []
        number = sequence = held = 0

        def written(rows: list[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            columns: list[list] = [[] for _ in range(7)]
            for pieces in rows:
                ids = np.full(capacity, pad, coder.dtype)
                bounds = [0]
                for doc, start, length in pieces:
                    at = bounds[-1]
                    ids[at:at + length] = docs[doc][1][start:start + length]
                    bounds.append(at + length)
                # Places since the last bound, in one step for the row; zero behind the last segment.
                places = np.zeros(capacity, position)
                places[:bounds[-1]] = every[:bounds[-1]] - np.repeat(bounds[:-1], np.diff(bounds))
                values = (
                    task + sequence, bounds[-1], [docs[d][0] for d, _, _ in pieces], [s for _, s, _ in pieces],
                    bounds, ids.tobytes(), places.tobytes(),
                )
                for column, value in zip(columns, values):
                    column.append(value)
                sequence += 1
                if len(columns[0]) == common.BATCH_ROWS:
                    yield common.batch(out, columns)
                    columns = [[] for _ in range(7)]
            if columns[0]:
                yield common.batch(out, columns)

        def settle(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal pool
            rows = best_fit(pool, capacity)
            done = [r for r in rows if last or sum(p[2] for p in r) >= FULL * capacity]
            pool = [] if last else [p for r in rows if sum(q[2] for q in r) < FULL * capacity for p in r]
            yield from written(done)
            still = {p[0] for p in pool}
            for doc in [d for d in docs if d not in still]:
                del docs[doc]

        for batch in batches:
            found = coder.encode(batch.column(1).to_pylist(), end)
            whole = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), found):
                docs[number] = (doc_id, ids)
                full = len(ids) - len(ids) % capacity
                whole += [[(number, at, capacity)] for at in range(0, full, capacity)]
                if full < len(ids):
                    pool.append((number, full, len(ids) - full))
                held += len(ids)
                number += 1
            yield from written(whole)
            if held >= block:
                held = 0
                yield from settle(False)
        yield from settle(True)
    return run


def matrices(
    docs: DataFrame, *, text: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY,
    end: int = END_ID, pad: int = PAD_ID, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per packed row: sequence_id, n_tokens, doc_ids and starts of its segments, cu_seqlens (from 0 to
    n_tokens), ids (little-endian, 2 bytes for vocabularies of up to 65,536 ids, else 4, padded to the capacity)
    and position_ids (2 bytes each up to that capacity)."""
    base = docs.select("doc_id", F.col(text).alias("body"))
    run = _run(tokenizer or tokens.default_path(), capacity, end, pad, block_tokens, common.arrow_schema(SCHEMA))
    return common.map_arrow(base, run, SCHEMA)


def write_matrices(docs: DataFrame, path: str, **options) -> None:
    """The packed rows as uncompressed Parquet: the id column of a file is one run of fixed-size matrices."""
    matrices(docs, **options).write.option("compression", "none").parquet(path)


def op9_token_output(spark, sf_dir: str) -> DataFrame:
    return matrices(common.table(spark, sf_dir, "documents"))
