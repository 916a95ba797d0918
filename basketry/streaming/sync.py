"""A table kept equal to its source by a stream of change rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..operators.changes import latest_versions

BASES, DELTAS, FENCE = "bases", "deltas", "fence"
# Number of the base that a snapshot makes: before any batch.
SNAPSHOT = -1


@dataclass(frozen=True)
class SyncedTable:
    """Current rows by key: a base and the batches since.

    Each micro-batch appends its latest row per key as a folder of its own, so a small batch writes little whatever
    the size of the table. Every ``compact_every`` batches base and batches fold into a new base. Readers take the
    newest finished base and the batches behind it, and scan nothing else; what the base before last covered is
    removed, so a reader that began before a compaction still finds its files. A folder counts once it is finished
    and is never written again, so a batch cut off at any point, or run twice, leaves the same table. Rows of deleted
    keys stay as markers, so that an older change arriving late does not bring them back.

    A snapshot of the source can be loaded as the first base. Changes up to its fence, the position of the source's log
    at which it was taken, are in it already and are passed over, so none of them wins against it or brings back a key
    that was deleted before.
    """

    path: str
    schema: str
    key: tuple[str, ...]
    order: tuple[str, ...]
    deleted: str = "__deleted"
    compact_every: int = 16

    def load_snapshot(self, snapshot: DataFrame, fence: int) -> None:
        """Start from a full copy of the source, unless this table has started already. ``snapshot`` has the table's
        columns; the first order column is set to the fence."""
        spark = snapshot.sparkSession
        if self._finished(spark, BASES) or self._finished(spark, DELTAS):
            return
        spark.createDataFrame([(fence,)], "fence bigint").coalesce(1).write.mode("overwrite").json(f"{self.path}/{FENCE}")
        rows = snapshot.withColumn(self.order[0], F.lit(fence)).select(*self._columns(spark))
        rows.write.mode("overwrite").parquet(self._folder(BASES, SNAPSHOT))

    def fence(self, spark: SparkSession) -> int | None:
        """Up to where the log is part of the snapshot."""
        if not files.exists(spark, f"{self.path}/{FENCE}/_SUCCESS"):
            return None
        return spark.read.schema("fence bigint").json(f"{self.path}/{FENCE}").first().fence

    def write_batch(self, changes: DataFrame, batch_id: int) -> None:
        spark = changes.sparkSession
        fence = self.fence(spark)
        if fence is not None:
            changes = changes.filter(F.col(self.order[0]) > fence)
        bases, deltas = self._finished(spark, BASES), self._finished(spark, DELTAS)
        if batch_id not in deltas and batch_id > max(bases, default=SNAPSHOT):
            new = self._latest(changes.select(*self._columns(spark)))
            new.write.mode("overwrite").parquet(self._folder(DELTAS, batch_id))
        if (batch_id + 1) % self.compact_every == 0 and batch_id not in bases:
            self._versions(spark).write.mode("overwrite").parquet(self._folder(BASES, batch_id))
            self._clear(spark, bases, deltas)

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The table as it is, or as it was before a batch: a batch that runs again must not see itself."""
        return self._versions(spark, before).filter(f"not {self.deleted}")

    def live(self, spark: SparkSession, before: int | None = None) -> list[str]:
        """The folders that hold the table."""
        bases, deltas = (
            [n for n in self._finished(spark, kind) if before is None or n < before] for kind in (BASES, DELTAS))
        base = max(bases, default=SNAPSHOT)
        folders = [self._folder(DELTAS, n) for n in deltas if n > base]
        return ([self._folder(BASES, base)] if bases else []) + folders

    def rows(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """All versions in those folders."""
        folders = self.live(spark, before)
        return spark.read.schema(self.schema).parquet(*folders) if folders else spark.createDataFrame([], self.schema)

    def _versions(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        return self._latest(self.rows(spark, before))

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_versions(rows, list(self.key), list(self.order))

    def _columns(self, spark: SparkSession) -> list[str]:
        return spark.createDataFrame([], self.schema).columns

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}/{number}"

    def _clear(self, spark: SparkSession, bases: list[int], deltas: list[int]) -> None:
        """Remove what the newest base of ``bases`` (the one before the current) had already replaced."""
        before = max(bases, default=SNAPSHOT)
        old = [(BASES, n) for n in bases if n < before] + [(DELTAS, n) for n in deltas if n <= before]
        for kind, number in old:
            files.remove(spark, self._folder(kind, number))

    def _finished(self, spark: SparkSession, kind: str) -> list[int]:
        """Numbers of the folders that were written to the end; at most about twice ``compact_every`` of them."""
        top = f"{self.path}/{kind}"
        return sorted(int(n) for n in files.names(spark, top) if files.exists(spark, f"{top}/{n}/_SUCCESS"))
