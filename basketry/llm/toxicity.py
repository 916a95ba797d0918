"""Toxicity: a weighted lexicon, matched by Aho-Corasick after folding disguises, normalised by length.

Folding lowers the case, drops accents, reads look-alike letters of other scripts and digits or signs inside words
as Latin letters, and writes all that is no word as one space. ``l`` and ``i`` fold to one letter, as ``1`` may stand
for either. Lexicon and text fold alike, so a match is a whole word or the beginning of one, whatever its disguise.

The lexicon is learned from at most TRAIN_ROWS labelled documents that are not held out: words and word beginnings
that occur in toxic documents far more often than chance allows, over all candidates. Documents that share one of
their smallest shingle hashes count once, so copies of one toxic text do not turn all its words into the lexicon. A
phrase of an entry and a neighbouring word that occurs mostly in clean documents becomes an exception: it takes the
entry's weight back; EXCEPTIONS holds phrases that always count as such. A logistic curve over the weighted hits, as
they are and per word, gives the score.

Defined cases: null or empty text has no hits and the lowest score; of several labels of one id the smallest counts, of
several texts the one with the smallest hash is learned; without any label the lexicon is empty and every score is 0;
entries of equal weight are all kept; repeated rows are scored one by one, very long texts whole; columns of other
names are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .quality import judged, sample

TRAIN_ROWS = 20_000
PREFIXES = range(4, 8)
MIN_WEIGHT = 2.0
SHINGLE = 4
KEYS = 3
MARGIN = 5.0
THRESHOLD = 0.5

# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "a": "аαɑａ", "b": "вβƄｂ", "c": "сϲᴄｃ",
    "d": "ԁⅾｄ", "e": "еε℮ｅ", "f": "ƒϝｆ",
    "g": "ɡցｇ", "h": "нһհｈ", "i": "іιıｉ",
    "j": "јϳｊ", "k": "кκｋ", "l": "ӏⅼｌ", "m": "мⅿｍ",
    "n": "ոηｎ", "o": "оοօｏ", "p": "рρｐ", "q": "ԛｑ",
    "r": "гᴦｒ", "s": "ѕｓ", "t": "тτｔ", "u": "υսｕ",
    "v": "νѵｖ", "w": "ԝѡｗ", "x": "хχｘ", "y": "уγｙ",
    "z": "ᴢｚ",
}
# Digits and signs that stand for letters inside words.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "+": "t"}
INSIDE = re.compile(r"(?<=[^\W_])[@$!|+]+(?=[^\W_])|(?<![^\W_])[@$](?=[^\W\d_])")
# Phrases that are harmless although a word of them may be in the lexicon.
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "sore loser", "pathetic fallacy")


class _Folding(dict):
    """Character by character: folded letter, digit as letter, or space; worked out once per character."""

    def __missing__(self, code: int) -> str:
        letter = chr(code)
        for base in [letter.lower(), unicodedata.normalize("NFKD", letter).lower()]:
            for c in base:
                if c in _LATIN:
                    c = _LATIN[c]
                if "a" <= c <= "z":
                    self[code] = "i" if c == "l" else c
                    return self[code]
        if letter in DIGITS:
            self[code] = DIGITS[letter]
        elif unicodedata.combining(letter) or unicodedata.category(letter) == "Cf":
            self[code] = ""
        else:
            self[code] = letter.lower() if letter.isalnum() else " "
        return self[code]


_LATIN = {c: base for base, others in LOOKALIKES.items() for c in others}
_FOLD = _Folding()


def fold(text: str | None) -> str:
    """Words joined and surrounded by single spaces."""
    text = text or ""
    if any(s in text for s in SIGNS):
        text = INSIDE.sub(lambda m: "".join(SIGNS[c] for c in m.group()), text)
    return " " + " ".join(text.translate(_FOLD).split()) + " "


@dataclass
class Lexicon:
    """Keys are `` word `` and `` beginning``; exceptions are phrases with spaces around."""

    entries: dict[str, float] = field(default_factory=dict)
    exceptions: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, float, float] = (-745.0, 0.0, 0.0)

    def machine(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for key, weight in self.entries.items():
            found.add_word(key, weight)
        for key, weight in self.exceptions.items():
            found.add_word(key, -weight)
        if len(found):
            found.make_automaton()
        return found

    def measure(self, machine: ahocorasick.Automaton, text: str | None) -> tuple[float, float]:
        """Weighted hits, and hits for a hundred words."""
        norm = fold(text)
        hits = sum(w for _, w in machine.iter(norm)) if len(machine) else 0.0
        hits = max(0.0, hits)
        return math.log1p(hits), math.log1p(100 * hits / max(1, norm.count(" ") - 1))

    def score(self, machine: ahocorasick.Automaton, text: str | None) -> float:
        a, b = self.measure(machine, text)
        if not self.entries:
            return 0.0
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.curve[0] + self.curve[1] * a + self.curve[2] * b))))


def _keys_of(norm: str) -> list[int]:
    """Smallest hashes of the text's shingles: near copies share most of them."""
    own = norm.split()
    grams = [" ".join(own[i:i + SHINGLE]) for i in range(max(1, len(own) - SHINGLE + 1))]
    return [min(xxhash.xxh3_64_intdigest(g, seed) for g in grams) - (1 << 63) for seed in range(KEYS)]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        norms = [fold(t) for t in batch.column(2).to_pylist()]
        keys = [_keys_of(n) for n in norms]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64())), pa.array(norms, pa.string())],
            names=["doc_id", "label", "keys", "norm"],
        )


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each word and word beginning, by label, added up in the task. Which of them occur in toxic
    documents is known only from the sums over all tasks."""
    counts: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0])
    for batch in batches:
        for label, norm in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = set(norm.split())
            found = {(w, w) for w in own}
            for size in PREFIXES:
                found |= {(w[:size], "") for w in own if len(w) > size}
            for key in found:
                counts[key][label != 0] += 1
    keys = list(counts)
    for at in range(0, len(keys), 20_000):
        part = keys[at:at + 20_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in part]), pa.array([bool(k[1]) for k in part]),
             pa.array([counts[k][0] for k in part], pa.int64()), pa.array([counts[k][1] for k in part], pa.int64())],
            names=["entry", "whole", "clean", "toxic"],
        )


def _evidence(clean: int, toxic: int, share: float) -> float:
    """Log likelihood ratio of the entry's toxic share against that of all documents."""
    total = clean + toxic
    out = toxic * math.log(toxic / total / share)
    return out + (clean * math.log(clean / total / (1 - share)) if clean else 0.0)


def _stands_out(clean: int, toxic: int) -> Column:
    """The entries that ``choose`` can take: of enough weight, and at least the evidence that a single candidate needs."""
    share = toxic / (clean + toxic)
    c, t = F.col("clean"), F.col("toxic")
    weight = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    evidence = t * F.log(t / (c + t) / share) + F.when(c > 0, c * F.log(c / (c + t) / (1 - share))).otherwise(0)
    return (weight >= MIN_WEIGHT - 1e-6) & (evidence >= math.log(2) + MARGIN - 1e-6)


def choose(
    found: list[tuple[str, bool, int, int]], clean: int, toxic: int, candidates: dict[int, int],
) -> dict[str, float]:
    """Entries with their weights; ``candidates`` has the number of words (0) and of beginnings by size, as more of
    them reach any evidence by chance. A beginning is taken where no single word accounts for half of it; longer ones
    and words that begin like it are then left out."""
    share = toxic / (clean + toxic)
    enough = {size: math.log(max(2, n)) + MARGIN for size, n in candidates.items()}
    weights = {}
    for entry, whole, c, t in found:
        weight = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        if weight >= MIN_WEIGHT and _evidence(c, t, share) >= enough[0 if whole else len(entry)]:
            weights[entry, whole] = (weight, t)
    largest: dict[str, int] = defaultdict(int)
    for (entry, whole), (_, t) in weights.items():
        if whole:
            for size in PREFIXES:
                largest[entry[:size]] = max(largest[entry[:size]], t)
    chosen: dict[str, float] = {}
    stems: set[str] = set()
    for (entry, whole), (weight, t) in sorted(weights.items(), key=lambda x: (len(x[0][0]), x[0])):
        if any(entry[:size] in stems for size in PREFIXES if size < len(entry) or (whole and size == len(entry))):
            continue
        if whole:
            chosen[f" {entry} "] = weight
        elif largest[entry] < 0.5 * t:
            stems.add(entry)
            chosen[f" {entry}"] = weight
    return dict(sorted(chosen.items(), key=lambda x: (-x[1], x[0])))


def _neighbours(machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phrases of an entry and the word before or behind it, by label, added up in the task."""
        own = machine()
        counts: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0])
        for batch in batches:
            for label, norm in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = set()
                for at, key in own.iter(norm) if len(own) else ():
                    begin = at - len(key) + 1
                    end = norm.index(" ", begin + 1)
                    left, right = norm.rfind(" ", 0, begin), norm.find(" ", end + 1)
                    if begin > 0:
                        found.add((norm[max(0, left):end + 1], key))
                    if right > 0:
                        found.add((norm[begin:right + 1], key))
                for pair in found:
                    counts[pair][label != 0] += 1
        rows = [(p, k, c, t) for (p, k), (c, t) in counts.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["phrase", "entry", "clean", "toxic"],
        )
    return run


def _index(entries: dict[str, float]):
    def machine() -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for key in entries:
            found.add_word(key, key)
        if entries:
            found.make_automaton()
        return found
    return machine


def _measures(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.machine()
        for batch in batches:
            found = [lexicon.measure(machine, n) for n in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a for a, _ in found], pa.float64()),
                 pa.array([b for _, b in found], pa.float64())], names=["label", "a", "b"],
            )
    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Newton steps for logistic regression with a small penalty."""
    weight = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        slope = x.T @ (p - y) + ridge * weight
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        weight -= step
        if np.abs(step).max() < 1e-9:
            break
    return weight


def fit(
    docs: DataFrame, labels: DataFrame, *, column: str = "toxic", most: int = TRAIN_ROWS,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Lexicon:
    """The lexicon and its curve. The sample has a proven bound, one text of each id in it, so its ids may be
    broadcast, and what it holds for sure enough may reach the driver."""
    chosen = F.broadcast(sample(labels, column, most))
    rows = docs.select("doc_id", F.col("text").alias("body")).join(chosen, "doc_id")
    body = F.min_by("body", F.struct(F.xxhash64("body"), "body")).alias("body")
    rows = rows.groupBy("doc_id", "label").agg(body)
    single = common.map_arrow(rows, _keys, "doc_id bigint, label int, keys array<bigint>, norm string")
    for number in range(KEYS):
        first = F.min_by(F.struct("doc_id", "keys", "norm"), "doc_id").alias("row")
        single = single.groupBy(F.col("keys")[number].alias("key"), "label").agg(first).select("label", "row.*")
    texts = common.keep(single.select("label", "norm"), "toxicity")
    totals = {r.label != 0: r.n for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = totals.get(False, 0), totals.get(True, 0)
    if not clean or not toxic:
        return Lexicon()
    counts = common.map_arrow(texts, _candidates, "entry string, whole boolean, clean bigint, toxic bigint")
    counts = counts.groupBy("entry", "whole").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = common.keep(counts.filter("toxic > 0"), "toxicity")
    kind = F.when(F.col("whole"), 0).otherwise(F.length("entry")).alias("kind")
    candidates = {r.kind: r.n for r in counts.groupBy(kind).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = toxic / (clean + toxic)
    strong = counts.filter(_stands_out(clean, toxic)).orderBy("entry", "whole")
    entries = choose([tuple(r) for r in strong.collect()], clean, toxic, candidates)
    phrases = common.map_arrow(
        texts, _neighbours(_index(entries)), "phrase string, entry string, clean bigint, toxic bigint")
    phrases = phrases.groupBy("phrase", "entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    harmless = phrases.filter((F.col("clean") >= 3) & (F.col("clean") >= 9 * F.col("toxic")))
    harmless = harmless.orderBy("phrase", "entry")
    lexicon = Lexicon(entries, {r.phrase: entries[r.entry] for r in harmless.collect()})
    for phrase in map(fold, exceptions):
        own = [w for key, w in entries.items() if key in phrase]
        if own:
            lexicon.exceptions.setdefault(phrase, max(own))
    found = common.map_arrow(texts, _measures(lexicon), "label int, a double, b double").toArrow()
    found = found.sort_by([("label", "ascending"), ("a", "ascending"), ("b", "ascending")])
    x = np.stack([np.ones(len(found)), found.column("a").to_numpy(), found.column("b").to_numpy()], axis=1)
    lexicon.curve = tuple(float(v) for v in logistic(x, (found.column("label").to_numpy() != 0).astype(float)))
    return lexicon


def _score(shared, kept: int, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon: Lexicon = shared.value
        machine = lexicon.machine()
        for batch in batches:
            scores = [lexicon.score(machine, t) for t in batch.column(kept).to_pylist()]
            yield common.batch(out, [*(batch.column(i) for i in range(kept)), scores])
    return run


def score(docs: DataFrame, lexicon: Lexicon, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per document: the ``keep`` columns and the score, 0 to 1."""
    base = docs.select(*[F.col(c) for c in keep], F.col(text).alias("body"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])
    schema = f"{head}, score double"
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    return common.map_arrow(base, _score(shared, len(keep), common.arrow_schema(schema)), schema)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, common.table(spark, sf_dir, "labels")))
    return scored.select(*judged(scored, THRESHOLD))
