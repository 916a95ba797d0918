"""Read-side queries over the stored result tables: only the newest partitions, or the rows of one user."""

from __future__ import annotations

import re
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files

LATEST_ALERTS = 100
LATEST_ALERTS_OF_USER = 50
LATEST_WINDOWS = 2

QUARANTINE = "_quarantine"
UNREADABLE = "file string, reason string, found_at timestamp"
_NAMED = re.compile(r"error while reading file (\S+\.parquet)")


@dataclass(frozen=True)
class Stored:
    """A result table as files below one folder per time, with a key that every row should have.

    Folders are found by name, so nothing of older ones is opened. A file that cannot be read is noted in a table beside
    the data, with the reason, and from then on left out; the rows of all others are served.
    """

    spark: SparkSession
    path: str
    schema: str
    partition: str
    key: str

    def folders(self) -> list[str]:
        """Names of the time folders, newest first."""
        names = [n for n in files.names(self.spark, self.path) if n.startswith(f"{self.partition}=")]
        return sorted(names, reverse=True)

    def rows(self, folders: list[str] | None = None, where: Column | None = None) -> DataFrame:
        """Rows of some folders (else of all) that meet a condition, from the files that can be read."""
        while True:
            found = self._read(folders, where)
            try:
                # Every value is read once, as damage may be anywhere in a file.
                found.agg(F.sum(F.xxhash64(*found.columns).cast("decimal(38,0)"))).collect()
                return found.filter(F.col(self.key).isNotNull())
            except (PySparkException, Py4JJavaError) as error:
                bad = _NAMED.search(str(error))
                if bad is None or not self._note(bad.group(1), str(error)):
                    raise

    def newest(self, limit: int, what: Column | None = None) -> DataFrame:
        """Rows of the newest folders that together hold ``limit`` rows, or as many different ``what``."""
        names, take = self.folders(), 1
        count = F.count(F.lit(1)) if what is None else F.count_distinct(what)
        while True:
            rows = self.rows(names[:take])
            if take >= len(names) or rows.agg(count.alias("n")).first().n >= limit:
                return rows
            take *= 2

    def unreadable(self) -> DataFrame:
        """The files left out: file, reason, found_at."""
        files.make(self.spark, f"{self.path}/{QUARANTINE}/files")
        return self.spark.read.schema(UNREADABLE).json(f"{self.path}/{QUARANTINE}/files")

    def nameless(self) -> int:
        """How many rows are left out for want of a key."""
        return self._read(None, F.col(self.key).isNull()).count()

    def _noted(self) -> set[str]:
        noted = files.exists(self.spark, f"{self.path}/{QUARANTINE}")
        return {r.file for r in self.unreadable().collect()} if noted else set()

    def _read(self, folders: list[str] | None, where: Column | None) -> DataFrame:
        schema = f"{self.schema}, {self.partition} string"
        noted = self._noted()
        if not noted and folders is None:
            files.make(self.spark, self.path)
            names = [self.path]
        else:
            places = [f"{self.path}/{n}" for n in (self.folders() if folders is None else folders)]
            names = places if not noted else [
                f for place in places for f in files.files(self.spark, place) if _plain(f) not in noted]
        if not names:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", self.path).parquet(*names)
        return rows if where is None else rows.filter(where)

    def _note(self, file: str, reason: str) -> bool:
        """Whether the file was not known yet."""
        if _plain(file) in self._noted():
            return False
        causes = [x for x in reason.splitlines() if x.startswith("Caused by: ") and "FAILED_READ_FILE" not in x]
        text = (causes[-1].removeprefix("Caused by: ") if causes else reason)[:500]
        row = self.spark.createDataFrame([(_plain(file), text)], "file string, reason string")
        row.withColumn("found_at", F.current_timestamp()).coalesce(1).write.mode("append").json(
            f"{self.path}/{QUARANTINE}/files")
        return True


def _plain(file: str) -> str:
    """A file's address without the marks of its host, as different readers write it."""
    return re.sub(r"^([a-z0-9]+):/+", r"\1:/", file)


def latest_alerts(alerts: Stored, limit: int = LATEST_ALERTS) -> DataFrame:
    return _latest(alerts.newest(limit), limit)


def alerts_by_user(alerts: Stored, user_id: str, limit: int = LATEST_ALERTS_OF_USER) -> DataFrame:
    return _latest(alerts.rows(where=F.col("user_id") == user_id), limit)


def _latest(alerts: DataFrame, limit: int) -> DataFrame:
    return alerts.drop("day").orderBy(F.desc("detected_at"), "alert_id").limit(limit)


def sessions_list(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "session_id",
        "user_id",
        F.col("session_start").alias("start_time"),
        F.col("session_end").alias("end_time"),
        "page_views",
        "product_views",
        F.col("add_to_cart_count").alias("add_to_carts"),
        F.col("purchase_count").alias("purchases"),
        F.col("total_revenue").alias("revenue"),
    )


def sessions_by_user(sessions: Stored, user_id: str) -> DataFrame:
    return sessions_list(sessions.rows(where=F.col("user_id") == user_id))


def latest_revenue(flat: Stored, limit: int = LATEST_WINDOWS) -> DataFrame:
    """The newest windows of the stored revenue rows, by ``hour``, with their best category; the lowest name among
    equals."""
    rows = flat.newest(limit, F.col("window_start_timestamp"))
    best = F.struct(-F.col("category_revenue"), F.col("category"))
    return (
        rows.groupBy(
            F.col("window_start_timestamp").alias("window_start"), F.col("window_end_timestamp").alias("window_end")
        )
        .agg(
            F.max("gmv").alias("total_gmv"),
            F.max("order_count").alias("order_count"),
            F.max("average_order_value").alias("avg_order_value"),
            F.min_by("category", F.when(F.col("category").isNotNull(), best)).alias("top_category"),
        )
        .orderBy(F.desc("window_start"))
        .limit(limit)
    )
