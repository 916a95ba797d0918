import random

import pytest
from pyspark.sql import functions as F

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu"]
EXTRA = ("score", "row", "body", "key", "n", "a", "b", "spans", "label", "token", "comp", "th", "doc", "items")


def prose(seed: int, count: int) -> str:
    own = random.Random(seed)
    return " ".join(own.choice(WORDS) + own.choice(["", "s", "ing", ","]) for _ in range(count))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, repeated rows, odd characters."""
    long = prose(1, 30_000)
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "..!! 123 --"), (5, "word"), (6, prose(2, 200)), (7, prose(2, 200)),
        (7, prose(2, 200)), (8, long), (9, long + " tail"), (None, "nameless text"), (None, None),
        (10, "x" * 20_000), (11, "日本語 テキスト é́ ​ ﷺ"), (12, prose(3, 50)),
    ]


@pytest.fixture(scope="session")
def edges(spark, edge_rows):
    """The rows above with clashing columns beside them."""
    docs = spark.createDataFrame(edge_rows, "doc_id bigint, text string").repartition(3)
    lang = F.when(F.col("doc_id") % 2 == 0, "en").when(F.col("doc_id") % 3 == 0, "de")
    docs = docs.withColumns({"lang": lang, "source": F.lit("s"), "n_chars": F.length("text").cast("bigint")})
    return docs.withColumns({c: F.lit("clash") for c in EXTRA})


@pytest.fixture(scope="session")
def no_docs(edges):
    return edges.filter("doc_id < 0")


@pytest.fixture(scope="session")
def marks(spark):
    rows = [(6, 1, 0), (7, 0, 1), (8, 1, 0), (9, None, None), (12, 0, 1), (None, 1, 1), (6, 1, 0), (99, 0, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
