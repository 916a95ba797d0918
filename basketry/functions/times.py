"""Event time. Events carry epoch milliseconds; engines of time windows want a timestamp."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def millis(span: timedelta) -> int:
    return span // timedelta(milliseconds=1)


def interval(span: timedelta) -> str:
    return f"{millis(span)} milliseconds"


def event_time(df: DataFrame) -> DataFrame:
    """Add ``event_time`` from the epoch-millisecond column ``timestamp``."""
    return df.withColumn("event_time", F.timestamp_millis("timestamp"))


def slice_of(ms: Column, width: timedelta) -> Column:
    """Number of the fixed slice of ``width`` that an epoch-millisecond value falls in."""
    return F.floor(ms / F.lit(millis(width)))


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, for results that other engines read."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz") if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in df.schema.fields
    ])
