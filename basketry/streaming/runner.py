"""Run a stream over what its source holds now and read the result table."""

from __future__ import annotations

import json
import logging
import threading
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from .. import files
from ..session import STREAM_CONF, work_dir


@dataclass(frozen=True)
class StreamRun:
    """Folders of one stream: its result table and its checkpoint. Running it again continues."""

    spark: SparkSession
    folder: str

    @classmethod
    def new(cls, spark: SparkSession, label: str) -> StreamRun:
        return cls(spark, work_dir(spark, label))

    @property
    def table(self) -> str:
        return f"{self.folder}/table"

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/checkpoint"

    def drain(self, stream: DataFrame) -> list[dict]:
        """Process all input present at the start, append results to the table, stop.

        The file sink lists each batch's files in its log once, so a batch that runs again after a
        failure adds nothing twice. Returns the progress of every batch.
        """
        writer = (
            stream.writeStream.format("parquet").outputMode("append").option("path", self.table)
        )
        return self._run(writer)

    def drain_batches(
        self, stream: DataFrame, write: Callable[[DataFrame, int], None], mode: str = "append"
    ) -> list[dict]:
        return self._run(stream.writeStream.outputMode(mode).foreachBatch(write))

    def _run(self, writer) -> list[dict]:
        with stream_settings(self.spark):
            query = (
                writer.option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
            )
            query.awaitTermination()
        return [json.loads(p.json) for p in query.recentProgress]

    def read(self, like: DataFrame) -> DataFrame:
        """The result table, with the schema of ``like`` even where nothing was written."""
        return self.spark.read.schema(like.schema).parquet(self.table)


class stream_settings:
    """Apply the streaming settings while a query starts and runs; restore the session's after."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.before: dict[str, str | None] = {}

    def __enter__(self):
        for key, value in STREAM_CONF.items():
            self.before[key] = self.spark.conf.get(key, None)
            self.spark.conf.set(key, value)

    def __exit__(self, *exc):
        for key, value in self.before.items():
            if value is None:
                self.spark.conf.unset(key)
            else:
                self.spark.conf.set(key, value)


def forget_last_batch(spark: SparkSession, checkpoints: str) -> None:
    """Leave every query below a folder of checkpoints as one that was stopped after its last batch had written its
    results and before the batch was noted as done; started again, it runs that batch again."""
    for query in files.names(spark, checkpoints):
        commits = f"{checkpoints}/{query}/commits"
        done = [int(n) for n in files.names(spark, commits) if n.isdigit()]
        if done:
            files.remove(spark, f"{commits}/{max(done)}")


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    run = StreamRun.new(stream.sparkSession, label)
    run.drain(stream)
    return run.read(stream)


class Counters(StreamingQueryListener):
    """Counts of rows in, state rows and late rows per query name; replaces printing of rows."""

    def __init__(self):
        self._lock = threading.Lock()
        self.totals: Counter[tuple[str, str]] = Counter()
        self.failed: list[str] = []

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        name = p.name or str(p.id)
        with self._lock:
            self.totals[name, "batches"] += 1
            self.totals[name, "input_rows"] += p.numInputRows
            for op in p.stateOperators:
                self.totals[name, "late_rows"] += op.numRowsDroppedByWatermark
                self.totals[name, "state_updates"] += op.numRowsUpdated

    def log(self, title: str) -> None:
        """The totals so far as one log line."""
        with self._lock:
            totals = {f"{name}.{what}": n for (name, what), n in sorted(self.totals.items())}
        logging.getLogger("basketry").info("%s: %s", title, json.dumps(totals))

    def onQueryTerminated(self, event):
        if event.exception:
            with self._lock:
                self.failed.append(event.exception)
