"""Benchmark decontamination: one Aho-Corasick automaton over the word windows of all test items, one scan per text.

Texts and items are normalised alike: A-Z in lower case, words of digits, letters and all characters beyond ASCII,
joined by single spaces. A window is ``window`` consecutive words of an item, or the whole item where it has fewer.
A match always begins and ends at a space, so it covers whole words; word numbers lead back to the original text.

The items are a stated query set. They reach the tasks in blocks of about ``block_bytes`` bytes of item text, one
automaton each; more blocks mean more passes over the rows, in a chain without a shuffle, and the hits add up.

Defined cases: a null or empty text has no words and is never contaminated; an item without text or
words is left out; the words of an item without id count as hits, but it has no name in the items; items with one id
count once; repeated rows and rows without id are judged one by one; very long texts are scanned whole; columns
of other names are not read, and ``clean`` keeps them; an empty table gives no rows, and without items nothing is hit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 13
BLOCK_BYTES = 4 << 20
# A document is contaminated from this share of its words: one in SHARE.
SHARE = 20

# Bytes outside words become spaces, A-Z become a-z.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
WORD = re.compile(rb"[^ ]+")

STATE = "runs array<struct<first:int,last:int>>, items array<string>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def windows(text: str | None, size: int = WINDOW) -> set[str]:
    """Search keys of an item, as Latin-1 readings of the bytes: the automaton then works on any UTF-8."""
    own = words(text)
    if not own:
        return set()
    return {
        (b" " + b" ".join(own[i:i + size]) + b" ").decode("latin-1") for i in range(max(1, len(own) - size + 1))
    }


def automaton(items: list[tuple[str | None, str]], size: int = WINDOW) -> ahocorasick.Automaton:
    """Key to (words in it, named items that hold it)."""
    holders: dict[str, set[str]] = {}
    for item, text in items:
        for key in windows(text, size):
            own = holders.setdefault(key, set())
            if item is not None:
                own.add(item)
    found = ahocorasick.Automaton()
    for key, own in holders.items():
        found.add_word(key, (key.count(" ") - 1, tuple(sorted(own))))
    if holders:
        found.make_automaton()
    return found


def find(machine: ahocorasick.Automaton, own: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged runs of hit words (first and last number) and the items hit."""
    if not own or not len(machine):
        return [], set()
    norm = " " + b" ".join(own).decode("latin-1") + " "
    runs: list[tuple[int, int]] = []
    items: set[str] = set()
    ends = None
    for at, (length, holders) in machine.iter(norm):
        if ends is None:  # position of the space behind each word
            ends = np.cumsum([len(w) + 1 for w in own])
        last = int(np.searchsorted(ends, at))
        runs.append((last - length + 1, last))
        items.update(holders)
    return merge(runs), items


def merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and adjoining runs become one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of word numbers as code point spans (end exclusive) of the text as it was."""
    raw = text.encode()
    places = [m.span() for m in WORD.finditer(raw.translate(FOLD))]
    spans, seen, at = [], 0, 0
    for first, last in runs:
        begin, end = places[first][0], places[last][1]
        seen += len(raw[at:begin].decode())
        length = len(raw[begin:end].decode())
        spans.append((seen, seen + length))
        seen, at = seen + length, end
    return spans


_machines: dict[tuple, ahocorasick.Automaton] = {}


def _machine(block, size: int) -> ahocorasick.Automaton:
    """One automaton per worker process and block, for all its tasks."""
    key = (block.value[0], size)
    if key not in _machines:
        _machines.clear()
        _machines[key] = automaton(block.value[1], size)
    return _machines[key]


def _pass(block, size: int, kept: int, schema: str):
    out = common.arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(block, size)
        for rows in batches:
            texts, runs, items = (rows.column(kept + i) for i in range(3))
            new_runs, new_items = [], []
            for text, before, names in zip(texts.to_pylist(), runs.to_pylist(), items.to_pylist()):
                hit, found = find(machine, words(text))
                if before:
                    hit = merge(hit + [(r["first"], r["last"]) for r in before])
                new_runs.append([{"first": a, "last": b} for a, b in hit])
                new_items.append(sorted(found | set(names)))
            yield common.batch(out, [*(rows.column(i) for i in range(kept + 1)), new_runs, new_items])
    return run


def _finish(kept: int, schema: str, with_spans: bool):
    out = common.arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            counts, hits, spans, digests = [], [], [], []
            texts, runs, items = (rows.column(kept + i) for i in range(3))
            for text, hit, names in zip(texts.to_pylist(), runs.to_pylist(), items.to_pylist()):
                pairs = [(r["first"], r["last"]) for r in hit]
                counts.append(len(words(text)))
                hits.append(sum(b - a + 1 for a, b in pairs))
                spans.append([{"begin": a, "end": b} for a, b in original_spans(text, pairs)] if pairs else [])
                digests.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            extra = [pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), items, spans, digests]
            yield common.batch(out, [*(rows.column(i) for i in range(kept + with_spans)), *extra])
    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES, with_text: bool = False,
) -> DataFrame:
    """One row per document: the ``keep`` columns (and the text, on demand), n_words, n_hit, items (sorted ids),
    spans (code points of the original text), items_sha256, contaminated."""
    spark = docs.sparkSession
    tests = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("body")).dropna(subset=["body"])
    size = tests.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-size // block_bytes))
    picked = [F.col(c) for c in keep] + [F.col(text).alias("body")]
    empty = [
        F.array().cast("array<struct<first:int,last:int>>").alias("runs"), F.array().cast("array<string>").alias("items")
    ]
    rows = docs.select(*picked, *empty)
    base = docs.select(*picked)
    state = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    for number in range(blocks):
        own = tests.filter(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == number)
        name = common.uuid.uuid4().hex
        block = spark.sparkContext.broadcast((name, [tuple(r) for r in own.collect()]))
        schema = f"{state}, {STATE}"
        rows = common.map_arrow(rows, _pass(block, window, len(keep), schema), schema)
    kept = base.schema.fields if with_text else base.schema.fields[:-1]
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema = (
        f"{head}, n_words bigint, n_hit bigint, items array<string>, spans array<struct<begin:int,end:int>>, "
        "items_sha256 string"
    )
    done = common.map_arrow(rows, _finish(len(keep), schema, with_text), schema)
    bad = (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))
    return done.withColumn("contaminated", bad)


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").alias("body"))
    found = contamination(row, benchmark, keep=("row",), text="body", **options)
    return found.filter(~F.col("contaminated")).select("row.*")


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = contamination(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items_sha256", "contaminated"
    )


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP5_SQL = f"""
WITH d AS (SELECT row_number() OVER () r, doc_id, coalesce({_WORDS}, []) w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) item, {_WORDS} w FROM benchmark
      WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') win
       FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) i
             FROM (SELECT item, w, least(13, len(w)) n FROM b WHERE len(w) > 0))),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') win
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) i FROM d, lens WHERE len(w) >= n)),
m AS (SELECT r, i, n, item FROM dw JOIN bw USING (n, win)),
hits AS (SELECT r, count(DISTINCT p) n_hit FROM (SELECT r, unnest(range(i, i + n)) p FROM (SELECT DISTINCT r, i, n FROM m)) GROUP BY r),
its AS (SELECT r, count(item) n_items, string_agg(item, ',' ORDER BY item) names FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       sha256(coalesce(names, '')) items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN its USING (r)
"""
