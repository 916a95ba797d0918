"""The stream forms of the jobs: watermarks, windows, keyed state, dead letters, change feeds."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import event_time, interval
from ..operators import changes, fraud, revenue, sessions
from ..schemas import ORDER
from ..sources import messages
from .fraud import first_order_hits, rapid_hits
from .handover import HandOver
from .sync import SyncedTable

# --- fixed values: how far events may be out of order -----------------------------------------
CLICK_DELAY = timedelta(seconds=30)
ORDER_DELAY = timedelta(seconds=10)
# ----------------------------------------------------------------------------------------------


def watermarked(df: DataFrame, delay: timedelta) -> DataFrame:
    return event_time(df).withWatermark("event_time", interval(delay))


def session_stream(clicks: DataFrame, gap: timedelta = sessions.SESSION_GAP) -> DataFrame:
    return sessions.session_metrics_streaming(watermarked(clicks, CLICK_DELAY), gap)


def revenue_stream(orders: DataFrame, width: timedelta = revenue.REVENUE_WINDOW) -> DataFrame:
    return revenue.revenue_metrics(watermarked(orders, ORDER_DELAY), width)


def rapid_order_stream(orders: DataFrame, within: timedelta = fraud.RAPID_WITHIN, **replay) -> DataFrame:
    return fraud.rapid_alerts(rapid_hits(watermarked(orders, ORDER_DELAY), within), within, **replay)


def first_order_stream(
    orders: DataFrame, threshold: float = fraud.HIGH_VALUE_THRESHOLD, **replay
) -> DataFrame:
    return fraud.high_value_alerts(first_order_hits(orders, threshold), threshold, **replay)


def alert_stream(
    orders: DataFrame,
    within: timedelta = fraud.RAPID_WITHIN,
    threshold: float = fraud.HIGH_VALUE_THRESHOLD,
    **replay,
) -> DataFrame:
    rapid = rapid_order_stream(orders, within, **replay)
    return rapid.unionByName(first_order_stream(orders, threshold, **replay))


def stamped(messages_stream: DataFrame) -> DataFrame:
    return messages_stream.withColumn("received_at", F.current_timestamp())


def dead_letter_split(folder: str, publish=None, schema=ORDER):
    """A batch writer that parses messages once and puts good rows and dead letters into the tables ``valid`` and
    ``dead_letters`` below the folder; ``publish`` gets the dead letters as well.

    Streams follow ``valid``, so its batches are handed over once. Dead letters are partitioned by day first, for
    expiry; the time they carry is the one logged with the batch, so a batch that runs again after a failure replaces
    exactly what it wrote.
    """
    handover = HandOver(folder)

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = messages.parse_safe(batch, schema, ["order_id", "user_id"])
        parsed = parsed.withColumn("batch_id", F.lit(batch_id)).persist()
        try:
            handover.write(messages.accepted(parsed), "valid", batch_id)
            bad = messages.rejected(parsed, at=F.col("received_at"))
            day = F.date_format("timestamp", "yyyy-MM-dd")
            _overwrite(
                bad.withColumn("dt", day).withColumn("batch_id", F.lit(batch_id)),
                f"{folder}/dead_letters", "dt", "batch_id",
            )
            if publish is not None:
                publish(bad, batch_id)
        finally:
            parsed.unpersist()

    return write


def split_dead_letters(messages_stream: DataFrame, run, schema=ORDER) -> list[dict]:
    """Drain a topic into the two tables of the run's folder."""
    return run.drain_batches(stamped(messages_stream), dead_letter_split(run.folder, schema=schema))


def _overwrite(df: DataFrame, path: str, *partition_by: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def price_feed_stream(product_messages: DataFrame) -> DataFrame:
    return changes.price_feed(messages.parse_product_changes(product_messages))


def order_feed_stream(order_messages: DataFrame) -> DataFrame:
    return changes.order_feed(messages.parse_order_changes(order_messages))


def keep_products(run, stream: DataFrame, counted: str, compact_every: int = 16) -> SyncedTable:
    """Follow a keyed aggregate by product: each batch hands on the products that changed, and the row with the
    highest count of what it has seen is the current one."""
    rows = stream.withColumn("__deleted", F.lit(False))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    synced = SyncedTable(run.table, schema, ("product_id",), (counted,), compact_every=compact_every)
    run.drain_batches(rows, synced.write_batch, mode="update")
    return synced
