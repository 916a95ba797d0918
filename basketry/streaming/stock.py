"""Running stock from a stream of movements that arrive out of order."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import files
from ..functions.times import millis
from ..operators.changes import running_stock_from, stock_levels
from .handover import LATE, EventClock, HandOver
from .sync import SyncedTable

LEVELS = "product_id bigint, stock bigint, batch bigint, __deleted boolean"
STOCK = "stock"
# Movements of a product that one group may hold, and products beyond that which a batch names.
WHOLE_ROWS = 100_000
MOST_BUSY = 1_000


@dataclass(frozen=True)
class RunningStock:
    """Movements wait until the watermark has passed them, and are then released in time order.

    Each batch takes the movements that are due from those that waited and those that came, computes their levels from
    the level of each product so far, hands them on, and keeps the rest for the next batch. Levels are a synced table
    by product, so a batch reads and writes what it touches. Movements behind the watermark are kept in a table of
    their own. A product with more than ``WHOLE_ROWS`` movements in a batch spreads over time slices, as in the batch
    form; the others are one group each. Batches may run again at any point: each reads what the batch before it left.
    """

    folder: str
    schema: T.StructType
    order: tuple[str, ...]
    delay: timedelta

    @property
    def out(self) -> HandOver:
        return HandOver(self.folder)

    def write_batch(self, movements: DataFrame, batch_id: int) -> None:
        spark = movements.sparkSession
        clock = EventClock(f"{self.folder}/_clock")
        before = clock.before(spark, batch_id)
        rows = movements.select(*self.schema.names).persist()
        try:
            newest = rows.agg(F.max("timestamp").alias("ms")).first().ms
            latest = max((x for x in (before, newest) if x is not None), default=None)
            clock.set(spark, batch_id, latest)
            late = F.lit(False) if before is None else F.col("timestamp") < before - millis(self.delay)
            self.out.write(rows.filter(late), LATE, batch_id)
            until = None if latest is None else latest - millis(self.delay)
            self._release(rows.filter(~F.coalesce(late, F.lit(False))), batch_id, F.col("timestamp") < F.lit(until))
        finally:
            rows.unpersist()

    def close(self, spark: SparkSession, batch_id: int) -> None:
        """Release all that still waits, when no more movements will come."""
        self._release(spark.createDataFrame([], self.schema), batch_id, F.lit(True))

    def read(self, spark: SparkSession) -> DataFrame:
        fields = [T.StructField(n, T.LongType()) for n in ("delta", "stock")]
        return self.out.read(spark, STOCK, T.StructType([*self.schema.fields, *fields])).drop("batch_id")

    def _release(self, new: DataFrame, batch_id: int, due) -> None:
        spark = new.sparkSession
        levels = SyncedTable(f"{self.folder}/levels", LEVELS, ("product_id",), ("batch",))
        known = levels.read(spark, before=batch_id).select("product_id", "stock")
        waiting = self._waiting(spark, batch_id - 1).unionByName(new)
        due = F.coalesce(due, F.lit(False))
        ready = waiting.filter(due)
        moved = stock_levels(ready).select(F.col("product_id").alias("moved"), F.col("stock").alias("change"), "movements")
        # One row per product that moves, with its level so far; null where it has none.
        moved = moved.join(known, F.col("product_id").eqNullSafe(F.col("moved")), "left").persist()
        try:
            before = moved.filter(F.col("stock").isNotNull()).select("product_id", "stock")
            running = running_stock_from(before, ready, list(self.order), busy=self._busy(moved))
            self.out.write(running, STOCK, batch_id)
            levels.write_batch(moved.select(
                F.col("moved").alias("product_id"),
                (F.coalesce("stock", F.lit(0)) + F.col("change")).alias("stock"),
                F.lit(batch_id).cast("bigint").alias("batch"), F.lit(False).alias("__deleted")), batch_id)
            place = f"{self.folder}/waiting/{batch_id}"
            if not files.exists(spark, f"{place}/_SUCCESS"):
                waiting.filter(~due).write.mode("overwrite").parquet(place)
            files.remove(spark, f"{self.folder}/waiting/{batch_id - 2}")
        finally:
            moved.unpersist()

    @staticmethod
    def _busy(moved: DataFrame) -> list[int | None] | None:
        """Products with too many movements for one group; none stands for all of them, where they are too many to name."""
        rows = moved.filter(F.col("movements") > WHOLE_ROWS).select("moved").limit(MOST_BUSY + 1).collect()
        return [r.moved for r in rows] if len(rows) <= MOST_BUSY else None

    def _waiting(self, spark: SparkSession, batch_id: int) -> DataFrame:
        place = f"{self.folder}/waiting/{batch_id}"
        if not files.exists(spark, f"{place}/_SUCCESS"):
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(place)
