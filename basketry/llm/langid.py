"""Language identification: the family first, then one-versus-one linear support vector machines inside it.

A text is its letters in lower case with single spaces between words; features are hashed byte n-grams, as shares of
all n-grams of the whole text. One-versus-rest machines choose the family; for each pair of languages of a family one
machine votes between them, and the summed certainties decide. All machines are linear over the same features, so a
text is scored by summing rows of one weight table.

The machines are fitted, by dual coordinate descent, on at most ROWS_PER_LANGUAGE texts of each language and TRAIN_ROWS
in all (though one of each language at least), taken by the hash of their ids from the rows that are not held out;
every language that occurs there is learned. Of the texts of one id the one with the smallest hash is taken.

Defined cases: null text or no letter gives ``und`` with score 0, and so does every text where no row can be learned
from, as in an empty table, which gives no rows; a null id is held out; ties between languages go to the first by name;
repeated rows are judged one by one; very long texts are judged whole; columns of other names are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, words

ROWS_PER_LANGUAGE = 1500
TRAIN_ROWS = 30_000
BROADCAST_LANGUAGES = 100_000
BITS = 15
ORDERS = (2, 4)
SLICE = 1 << 18

# Languages by family; any other code is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb yi fy",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indic": "hi ur bn mr gu pa ne",
    "semitic": "ar he mt am",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().split("-")[0], lang)


def _lower_table() -> np.ndarray:
    """Letters in lower case, bytes of longer characters as they are, all else a space."""
    table = np.full(256, 32, np.uint8)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


LOWER = _lower_table()


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram numbers of all texts in a row, and where each text's numbers begin (and the last ends)."""
    low = LOWER[data]
    accented = np.flatnonzero((low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[:-1] == 0xC3)) + 1
    low[accented] += 0x20  # capitals of the Latin-1 block
    first = np.zeros(len(low) + 1, bool)
    first[offsets] = True
    space = low == 32
    double = np.zeros(len(low), bool)
    double[1:] = space[1:] & space[:-1] & ~first[1:-1]
    kept = np.flatnonzero(~double)
    low, starts = low[kept].astype(np.uint32), np.searchsorted(kept, offsets)
    parts, owner = [], np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    owners = []
    for order in ORDERS:
        if len(low) < order:
            continue
        code = np.full(len(low) - order + 1, order, np.uint32)
        for k in range(order):
            code = code * np.uint32(0x01000193) + low[k:len(low) - order + 1 + k]
        inside = owner[:len(code)] == owner[order - 1:]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        parts.append(code[inside])
        owners.append(owner[:len(inside)][inside])
    if not parts:
        return np.zeros(0, np.uint32), np.zeros(len(starts), np.int64)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(parts)[order], np.searchsorted(owner[order], np.arange(len(starts)))


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    families: list[str] = field(default_factory=list)
    pairs: list[tuple[str, str]] = field(default_factory=list)
    table: np.ndarray | None = None  # features x machines: families, then pairs
    bias: np.ndarray | None = None

    @classmethod
    def of(cls, languages: list[str]) -> Model:
        """Without weights: the families and the pairs inside them follow from the languages."""
        families = sorted({family(x) for x in languages})
        pairs = [(a, b) for i, a in enumerate(languages) for b in languages[i + 1:] if family(a) == family(b)]
        return cls(languages, families, pairs)

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        codes, at = features(data, offsets)
        out = np.tile(self.bias, (len(offsets) - 1, 1))
        filled = np.flatnonzero(np.diff(at))
        if len(filled) and self.table.shape[1]:
            sums = np.add.reduceat(self.table[codes], at[filled], axis=0)
            out[filled] += sums / np.diff(at)[filled, None]
        return out

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        sure = 1 / (1 + np.exp(-2 * np.clip(self.margins(data, offsets), -300, 300)))
        rows, count = len(offsets) - 1, len(self.families)
        share = sure[:, :count] if count > 1 else np.ones((rows, count))
        share = share / share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        names, scores = [""] * rows, np.zeros(rows)
        for number, name in enumerate(self.families):
            own = np.flatnonzero(best == number)
            group = [x for x in self.languages if family(x) == name]
            votes = np.zeros((len(own), len(group)))
            for k, (a, b) in enumerate(self.pairs):
                if family(a) == name:
                    won = sure[own, count + k]
                    votes[:, group.index(a)] += won
                    votes[:, group.index(b)] += 1 - won
            chosen = votes.argmax(axis=1)
            meetings = max(1, len(group) - 1)
            inside = votes[np.arange(len(own)), chosen] / meetings if len(group) > 1 else np.ones(len(own))
            scores[own] = share[own, number] * inside
            for row, pick in zip(own, chosen):
                names[row] = group[pick]
        return names, scores


def fit_svm(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, cost: float, passes: int = 12) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine with hinge loss, by dual coordinate descent."""
    weight = np.zeros((1 << BITS) + 1)
    alpha = np.zeros(len(rows))
    norm = np.array([float(value @ value) for _, value in rows])
    order = np.random.default_rng(7)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(rows)):
            where, value = rows[i]
            slope = target[i] * (weight[where] @ value) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), cost)
            if new != alpha[i]:
                weight[where] += (new - alpha[i]) * target[i] * value
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3 * cost:
            break
    return weight


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of training texts: numbers and shares, scaled to length one."""
    for batch in batches:
        data, offsets = common.text_bytes(batch.column(1))
        codes, at = features(data, offsets)
        where, value = [], []
        for a, b in zip(at[:-1], at[1:]):
            own, count = np.unique(codes[a:b], return_counts=True)
            where.append(own.astype(np.int32))
            value.append((count / max(1, b - a)).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(where, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32())),
             batch.column(2)], names=["lang", "at", "value", "rank"],
        )


FITTED = "languages array<string>, weights binary, bias binary"


def _fitted(cost: float, out: pa.Schema):
    """From all sampled rows (lang, at, value): the machines, as one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, rows = [], []
        for batch in batches:
            langs += batch.column(0).to_pylist()
            for at, value in zip(batch.column(1), batch.column(2)):
                at, value = at.values.to_numpy(), value.values.to_numpy()
                scale = 1 / max(float(np.sqrt(value @ value)), 1e-9)
                rows.append((
                    np.append(at, np.int32(1 << BITS)), np.append(value * np.float32(scale), np.float32(1)), scale))
        model = _fit_machines(np.array(langs, object), rows, cost)
        yield common.batch(out, [[model.languages], [model.table.tobytes()], [model.bias.tobytes()]])
    return run


def fit(
    labelled: DataFrame, *, per_language: int = ROWS_PER_LANGUAGE, most: int = TRAIN_ROWS, cost: float = 50.0,
) -> Model:
    """A model from rows of ``id``, ``lang`` and ``text``. The sample, one text of an id at most, meets in one task,
    which fits all machines; only their weights reach the driver."""
    known = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    languages = counts.count()
    quota = max(1, min(per_language, most // max(1, languages)))
    # Texts must not move to meet a count, so a table of counts of checked size is sent to them.
    counts = F.broadcast(counts) if languages <= BROADCAST_LANGUAGES else counts
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Some more than the quota are drawn, so that a language of few draws is not missed.
    taken = known.join(counts, "lang").filter(draw < F.lit(1.1 * quota + 40) / F.col("n"))
    text = F.struct(F.xxhash64("text").alias("h"), "text")
    taken = taken.groupBy("lang", "id").agg(F.min(text).alias("text")).withColumn("place", F.xxhash64("id"))
    first = Window.partitionBy("lang").orderBy("place", "id")
    sample = taken.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= quota)
    sparse = common.map_arrow(
        sample.select("lang", F.col("text.text").alias("text"), "rank"), _sparse,
        "lang string, at array<int>, value array<float>, rank int")
    together = sparse.repartition(1).sortWithinPartitions("lang", "rank").drop("rank")
    row = common.map_arrow(together, _fitted(cost, common.arrow_schema(FITTED)), FITTED).first()
    if row is None:  # no rows at all
        return Model()
    model = Model.of(row.languages)
    machines = len(model.families) + len(model.pairs)
    model.table = np.frombuffer(row.weights, np.float32).reshape(1 << BITS, machines)
    model.bias = np.frombuffer(row.bias, np.float64)
    return model


def _fit_machines(langs: np.ndarray, rows: list, cost: float) -> Model:
    model = Model.of(sorted(set(langs)))
    of = np.array([family(x) for x in langs], object)
    # Scoring uses shares of n-grams, so the scale of training rows goes into the weights by its mean.
    scale = float(np.mean([r[2] for r in rows])) if rows else 1.0
    plain = [(at, value) for at, value, _ in rows]
    columns = []
    if len(model.families) > 1:
        columns += [fit_svm(plain, np.where(of == name, 1.0, -1.0), cost) for name in model.families]
    else:
        columns += [np.zeros((1 << BITS) + 1) for _ in model.families]
    for a, b in model.pairs:
        own = np.flatnonzero((langs == a) | (langs == b))
        columns.append(fit_svm([plain[i] for i in own], np.where(langs[own] == a, 1.0, -1.0), cost))
    weights = np.stack(columns, axis=1) if columns else np.zeros(((1 << BITS) + 1, 0))
    model.table = np.ascontiguousarray(weights[:-1] * scale, np.float32)
    model.bias = weights[-1].astype(np.float64)
    return model


def _has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _score(shared, kept: int, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            texts = batch.column(kept)
            data, offsets = common.text_bytes(texts)
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            if model.languages:
                for a, b in common.slices(offsets, SLICE):
                    part = data[offsets[a]:offsets[b]]
                    own, sure = model.predict(part, offsets[a:b + 1] - offsets[a])
                    names[a:b], scores[a:b] = own, sure
            for row in range(len(texts)):
                part = data[offsets[row]:offsets[row + 1]]
                if not ((part | 32) - np.uint8(97) < 26).any() and not _has_letter(texts[row].as_py()):
                    names[row], scores[row] = "und", 0.0
            yield common.batch(out, [*(batch.column(i) for i in range(kept)), names, scores])
    return run


def identify(docs: DataFrame, model: Model, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per document: the ``keep`` columns, lang_pred, score."""
    base = docs.select(*[F.col(c) for c in keep], F.col(text).alias("body"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])
    schema = f"{head}, lang_pred string, score double"
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return common.map_arrow(base, _score(shared, len(keep), common.arrow_schema(schema)), schema)


def learn(docs: DataFrame) -> Model:
    """From all documents that are not held out."""
    rows = docs.filter(common.fold_of(F.col("doc_id")) != 0)
    return fit(rows.select(F.col("doc_id").alias("id"), "lang", "text"))


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose language is recognised, with all their columns; where no language could be learned, those
    with a letter."""
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("body"))
    return identify(row, model, keep=("row",), text="body").filter("lang_pred <> 'und'").select("row.*")


def op1_langid(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", (common.fold_of(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")
