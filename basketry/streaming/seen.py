"""The first-order rule without state that grows with all users."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import fraud
from ..schemas import FRAUD_ALERT
from .handover import HandOver
from .sync import SyncedTable

USERS = "user_id string, first_ms bigint, __deleted boolean"
ALERTS = "alerts"


@dataclass(frozen=True)
class SeenUsers:
    """Users who have ordered live in a synced table, not in the state of a query.

    A batch folds into one row per user, its earliest order, and meets the table by key: what the table does not know is
    a first order. The fold is small, so Spark sends it to the files rather than the users to the batch; only the
    column of ids is read. A batch that runs again sees the table as it was before it.
    """

    folder: str
    threshold: float
    compact_every: int = 16

    @property
    def users(self) -> SyncedTable:
        return SyncedTable(f"{self.folder}/users", USERS, ("user_id",), ("first_ms",), compact_every=self.compact_every)

    def write_batch(self, orders: DataFrame, batch_id: int, **replay) -> None:
        spark = orders.sparkSession
        first = F.min(F.struct("timestamp", "order_id", "total_amount")).alias("first")
        own = orders.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(first).persist()
        try:
            seen = self.users.rows(spark, before=batch_id).select("user_id")
            # The known users of the batch are looked up first, and only these are taken from it.
            known = seen.join(own.select("user_id"), "user_id", "left_semi").distinct()
            new = own.join(known, "user_id", "left_anti").select("user_id", "first.*")
            hits = new.filter(F.col("total_amount") > self.threshold).withColumn(
                "event_time", F.timestamp_millis("timestamp"))
            HandOver(self.folder).write(fraud.high_value_alerts(hits, self.threshold, **replay), ALERTS, batch_id)
            self.users.write_batch(
                new.select("user_id", F.col("timestamp").alias("first_ms"), F.lit(False).alias("__deleted")), batch_id)
        finally:
            own.unpersist()

    def alerts(self, spark: SparkSession) -> DataFrame:
        return HandOver(self.folder).read(spark, ALERTS, T.StructType(FRAUD_ALERT.fields)).drop("batch_id")
