"""What a stream remembers, read from its checkpoint as tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import millis


def stored_state(spark: SparkSession, checkpoint: str, **options) -> DataFrame:
    """Keys and values of a stateful operator after its last batch."""
    return spark.read.format("statestore").options(**options).load(checkpoint)


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a stream, with the batches their state is kept for."""
    return spark.read.format("state-metadata").load(checkpoint)


def open_sessions(spark: SparkSession, checkpoint: str, gap: timedelta) -> DataFrame:
    """Sessions that the watermark has not closed: user, first and last event."""
    rows = stored_state(spark, checkpoint)
    window = F.col("value.session_window")
    return rows.select(
        F.col("value.user_id").alias("user_id"), window["start"].alias("session_start"),
        (window["end"] - F.make_dt_interval(secs=F.lit(millis(gap) / 1000))).alias("session_end"))


def seen_users(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Users that the first-order rule has seen."""
    return stored_state(spark, checkpoint, stateVarName="seen").select(F.col("user_map_key.user_id").alias("user_id"))
