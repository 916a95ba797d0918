"""Packing by minimum bin slack: a bitset subset-sum search fills each window from the multiset of remaining lengths.

Whole windows of a long document stand alone; its rest joins a pool. A fill takes the longest rest and, by dynamic
programming over a bitset of reachable sums, the multiset of other lengths that comes closest to the capacity; the
kept bitsets lead back to how many rests of each length it takes, and the fill repeats while the counts allow. What
slack is left is closed by cutting the longest other rest. The last tokens of a task fill windows of power-of-two
size, which need no padding.

Every task packs its own rows in blocks of BLOCK_TOKENS ids, so memory is bounded, nothing is shuffled and a
retried task writes the same rows; rests that fill no window move on to the next block.

Defined cases: a null or empty text is the closing id alone; repeated rows are packed one by one; a text longer
than a window fills whole windows first; of pieces of equal length the one that came last is taken; columns of other
names are not read; an empty table gives no rows. A sequence id is the task's number times 2^33 plus the window's number in the task.
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

WINDOW = 4096
END_ID = 2
BLOCK_TOKENS = 4 << 20

Piece = tuple[int, int, int]  # document number, start, length

SCHEMA = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def closest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths with the largest sum within ``room``: length to count."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((n for n, c in counts.items() if c and n <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(take, left)
            before, reach = reach, reach | (reach << take * length & mask)
            if reach != before:
                steps.append((length, take, before))
            left, take = left - take, take * 2
        if reach >> room & 1:
            break
    at, picked = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(steps):
        if not before >> at & 1:  # this sum needs the step
            picked[length] += take
            at -= take * length
    return dict(picked)


class Pool:
    """Rests by length."""

    def __init__(self, window: int):
        self.window = window
        self.by_length: dict[int, list[Piece]] = defaultdict(list)
        self.total = 0

    def add(self, piece: Piece) -> None:
        self.by_length[piece[2]].append(piece)
        self.total += piece[2]

    def take(self, length: int) -> Piece:
        own = self.by_length[length]
        piece = own.pop()
        if not own:
            del self.by_length[length]
        self.total -= length
        return piece

    def cut(self, length: int) -> Piece:
        """The first ``length`` tokens of the longest rest; the others go back."""
        doc, start, whole = self.take(max(self.by_length))
        if whole > length:
            self.add((doc, start + length, whole - length))
        return doc, start, min(whole, length)

    def fill(self, window: int) -> list[Piece]:
        """One full window; the pool must hold as many tokens."""
        pieces, room = [], window
        while room:
            first = max(self.by_length)
            if first >= room:
                pieces.append(self.cut(room))
                break
            pieces.append(self.take(first))
            room -= first
        return pieces

    def fills(self) -> Iterator[list[Piece]]:
        """Full windows while the pool holds one."""
        while self.total >= self.window:
            longest = max(self.by_length)
            counts = {n: len(p) for n, p in self.by_length.items()}
            counts[longest] -= 1
            chosen = closest(counts, self.window - longest)
            chosen[longest] = chosen.get(longest, 0) + 1
            slack = self.window - sum(n * c for n, c in chosen.items())
            times = min(len(self.by_length[n]) // c for n, c in chosen.items()) if not slack else 1
            for _ in range(times):
                pieces = [self.take(n) for n, c in chosen.items() for _ in range(c)]
                while slack > 0:
                    pieces.append(self.cut(slack))
                    slack -= pieces[-1][2]
                yield pieces

    def rest(self) -> Iterator[list[Piece]]:
        """What fills no window, in windows of power-of-two size."""
        for size in [1 << b for b in reversed(range(self.total.bit_length())) if self.total >> b & 1]:
            yield self.fill(size)


def _run(path: str, window: int, end: int, kept: int, block: int, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.tokenizer(path)
        task = TaskContext.get().partitionId() << 33
        pool = Pool(window)
        docs: dict[int, tuple[tuple, np.ndarray]] = {}  # those with a piece to come
        number = sequence = 0

        def rows(windows) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            columns: list[list] = [[] for _ in range(kept + 6)]
            for pieces in windows:
                offset = 0
                for doc, start, length in pieces:
                    names, ids = docs[doc]
                    own = common.crc(ids[start:start + length].astype("<u4").tobytes())
                    values = (*names, start, length, own, len(ids), task + sequence, offset)
                    for column, value in zip(columns, values):
                        column.append(value)
                    offset += length
                sequence += 1
            if columns[-1]:
                yield common.batch(out, columns)

        def settle(last: bool) -> Iterator[pa.RecordBatch]:
            yield from rows(pool.fills())
            if last:
                yield from rows(pool.rest())
            open_docs = {p[0] for own in pool.by_length.values() for p in own}
            for doc in [d for d in docs if d not in open_docs]:
                del docs[doc]

        held = 0
        for batch in batches:
            names = [batch.column(i).to_pylist() for i in range(kept)]
            found = coder.encode(batch.column(kept).to_pylist(), end)
            whole = []
            for row, ids in enumerate(found):
                docs[number] = (tuple(n[row] for n in names), ids)
                full = len(ids) - len(ids) % window
                whole += [[(number, at, window)] for at in range(0, full, window)]
                if full < len(ids):
                    pool.add((number, full, len(ids) - full))
                held += len(ids)
                number += 1
            yield from rows(whole)
            if held >= block:
                held = 0
                yield from settle(False)
        yield from settle(True)
    return run


def pack(
    docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text", tokenizer: str | None = None,
    window: int = WINDOW, end: int = END_ID, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per piece: the ``keep`` columns, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    base = docs.select(*[F.col(c) for c in keep], F.col(text).alias("body"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])
    schema = f"{head}, {SCHEMA}"
    run = _run(tokenizer or tokens.default_path(), window, end, len(keep), block_tokens, common.arrow_schema(schema))
    return common.map_arrow(base, run, schema)


def op2_pack(spark, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))
