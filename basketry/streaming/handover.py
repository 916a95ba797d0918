"""Rows that one stream hands to the streams behind it: each batch whole, once, and split by event time.

A stream that follows a folder knows files by path. A batch that runs again after a failure and writes its files anew
would therefore be read twice. So a batch is written aside and takes its place by one renaming, which has to be atomic, as
Spark's own checkpoints need it to be; when the batch runs again, its place is taken and it writes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import files
from ..functions.times import millis

BATCH = "batch_id"
ON_TIME, LATE, REJECTS = "on_time", "late", "rejects"


@dataclass(frozen=True)
class HandOver:
    """Tables below a folder, one partition per batch."""

    folder: str

    def table(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def write(self, rows: DataFrame, name: str, batch_id: int) -> None:
        spark = rows.sparkSession
        place = f"{self.table(name)}/{BATCH}={batch_id}"
        if files.exists(spark, place):
            return
        aside = f"{self.folder}/_aside/{name}-{batch_id}"
        rows.write.mode("overwrite").parquet(aside)
        files.move(spark, aside, place)

    def follow(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        """The table as a stream, also before its first batch."""
        files.make(spark, self.table(name))
        return spark.readStream.schema(_with_batch(schema)).parquet(self.table(name)).drop(BATCH)

    def read(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        files.make(spark, self.table(name))
        return spark.read.schema(_with_batch(schema)).parquet(self.table(name))


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])


def late_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("lateness_ms", T.LongType())])


@dataclass(frozen=True)
class EventClock:
    """The latest event time up to each batch. A batch that runs again sees what it saw before."""

    folder: str

    def before(self, spark: SparkSession, batch_id: int) -> int | None:
        older = [n for n in self._batches(spark) if n < batch_id]
        return spark.read.schema("latest_ms bigint").json(f"{self.folder}/{max(older)}").first().latest_ms if older else None

    def set(self, spark: SparkSession, batch_id: int, latest_ms: int | None) -> None:
        row = spark.createDataFrame([(latest_ms,)], "latest_ms bigint").coalesce(1)
        row.write.mode("overwrite").json(f"{self.folder}/{batch_id}")
        for number in [n for n in self._batches(spark) if n < batch_id - 1]:  # no batch looks back further
            files.remove(spark, f"{self.folder}/{number}")

    def _batches(self, spark: SparkSession) -> list[int]:
        return [int(n) for n in files.names(spark, self.folder) if files.exists(spark, f"{self.folder}/{n}/_SUCCESS")]


def split_by_time(
    handover: HandOver, read: Callable[[DataFrame], DataFrame], delay: timedelta, complete: Column,
    ms: str = "timestamp",
) -> Callable[[DataFrame, int], None]:
    """A batch writer that reads messages once and hands on every row: to ``on_time``; to ``late``, with
    ``lateness_ms``, where the row is older than the watermark of the batches before it; to ``rejects`` where it is not
    complete. A stream with the same delay that follows ``on_time`` drops nothing, as its watermark is never ahead.
    """
    clock = EventClock(f"{handover.folder}/_clock")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = clock.before(spark, batch_id)
        watermark = F.lit(None if latest is None else latest - millis(delay)).cast("bigint")
        lateness = watermark - F.col(ms)
        kind = F.when(~F.coalesce(complete, F.lit(False)), REJECTS).when(lateness > 0, LATE).otherwise(ON_TIME)
        rows = read(batch).withColumn("kind", kind).withColumn("lateness_ms", lateness).persist()
        try:
            held = {r.kind: r.latest for r in rows.groupBy("kind").agg(F.max(ms).alias("latest")).collect()}
            seen = [x for x in (latest, held.get(ON_TIME)) if x is not None]
            clock.set(spark, batch_id, max(seen, default=None))
            for kind in held:
                own = rows.filter(F.col("kind") == kind).drop("kind")
                handover.write(own if kind == LATE else own.drop("lateness_ms"), kind, batch_id)
        finally:
            rows.unpersist()

    return write
