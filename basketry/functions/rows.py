"""Helpers on whole DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Like ``withColumn`` for a costly expression: it runs once per row.

    Spark moves a filter on a derived column below the projection that derives it, where the
    expression then runs a second time, once for each reference in the filter. Filters on the
    output of ``explode`` stay above it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
