"""Connected components as table operations: alternating large-star and small-star steps until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import common


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, and what is seen of them while they are written: their number and a sum of their hashes.
    Equal sets show the same."""
    seen = Observation()
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    table = common.keep(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(mark).alias("h")), "components")
    return table, (seen.get["n"], seen.get["h"])


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) between numbers: one row (node, root) for each linked node that is not the smallest of its
    component. Nulls and links to oneself are ignored. Each round is written to the shared folder, so its plan stays
    short; minima are combined before the shuffle, and no neighbourhood is ever gathered in a row."""
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = _kept(pairs)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old = edges
        edges, now = _kept(small.union(low).distinct())
        common.drop(old)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots.kept_in = edges.kept_in
    return roots
