"""The jobs as they run in production, by name.

    python -m basketry.plans.jobs --job daily --input <tables> --output <folder> [--date 2024-01-17]
    python -m basketry.plans.jobs --job sessions --topics <folder or broker> --output <folder>

Stream jobs read topics (Kafka with ``--bootstrap``, else files of lines below ``--topics``), write
their result topic and, where there is one, their analytics table.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import changes, daily, fraud, quality, revenue, sessions
from ..session import build_session, prepare
from ..sources import messages, tables
from ..sources.topics import publish_batch, read_topic, to_wire, write_topic
from ..streaming import jobs as streams
from ..streaming.handover import HandOver, split_by_time
from ..streaming.runner import Counters, stream_settings
from ..streaming.sync import SyncedTable

CHECKPOINT_EVERY = "60s"
CHECKPOINT_CONF = "spark.sql.streaming.stateStore.maintenanceInterval"


@dataclass(frozen=True)
class Options:
    output: str
    input: str | None = None
    topics: str | None = None
    bootstrap: str | None = None
    date: str | None = None
    snapshot: str | None = None  # a full copy of the products, taken at
    fence: int = 0  # this position of their log, in its milliseconds
    drain: bool = False  # process what is there and stop, instead of running on
    every: str | None = None  # pause between batches; none: as fast as possible
    checkpoint_every: str = CHECKPOINT_EVERY  # full snapshots of state; changes are logged with every batch
    within: timedelta = fraud.RAPID_WITHIN
    threshold: float = fraud.HIGH_VALUE_THRESHOLD

    @property
    def day(self) -> str:
        return self.date or (date.today() - timedelta(days=1)).isoformat()


# --- daily job --------------------------------------------------------------------------------


def daily_reports(lines: DataFrame, day: str) -> dict[str, DataFrame]:
    """The three daily tables of one day's order lines."""
    reports = (
        daily.daily_revenue(lines, ordered=False),
        daily.top_cities(lines),
        daily.order_funnel(lines, ordered=False).withColumn("order_date", F.lit(day)),
    )
    return dict(zip(quality.DAILY_TABLES, reports))


def run_daily(spark: SparkSession, options: Options) -> DataFrame:
    """Read the day's partition once, replace the day in the three tables, check them, and return
    the failed checks. ``input`` is a table of order lines partitioned by ``order_date``."""
    lines = tables.scan_day(spark, options.input, options.day)
    lines = lines.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd")).persist()
    try:
        reports = daily_reports(lines, options.day)
        for name, report in reports.items():
            tables.replace_day(report, f"{options.output}/{name}", options.day)
        daily.daily_summary(lines).show(truncate=False)
    finally:
        lines.unpersist()
    written = {
        name: spark.read.schema(report.schema).parquet(f"{options.output}/{name}")
        .filter(F.col("order_date") == options.day) for name, report in reports.items()
    }
    return quality.daily_checks(written).filter(~F.col("passed"))


# --- stream jobs ------------------------------------------------------------------------------


def _topic(spark: SparkSession, options: Options, topic: str, group: str) -> DataFrame:
    return read_topic(spark, topic, bootstrap=options.bootstrap, path=options.topics, group=group)


def _start(options: Options, lines: DataFrame, topic: str):
    writer = write_topic(
        lines, topic, f"{options.output}/checkpoints/{topic}",
        bootstrap=options.bootstrap, path=f"{options.output}/topics", query_name=topic,
    )
    return _trigger(writer, options).start()


def _publish(options: Options, stream: DataFrame, topic: str, name: str, write: Callable):
    """One query for the result topic and the result table, so its state is kept once.

    A batch that runs again after a failure replaces the table partitions and topic files it wrote,
    as its id is part of their paths. A Kafka topic may see such a batch twice.
    """

    def both(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write(batch, f"{options.output}/tables/{name}", batch_id=batch_id)
            publish_batch(
                to_wire(batch), topic, batch_id, bootstrap=options.bootstrap, path=f"{options.output}/topics"
            )
        finally:
            batch.unpersist()

    writer = stream.writeStream.queryName(topic).option(
        "checkpointLocation", f"{options.output}/checkpoints/{topic}"
    ).foreachBatch(both)
    return _trigger(writer, options).start()


def _trigger(writer, options: Options):
    if options.drain:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=options.every or "0 seconds")


def _split(options: Options, lines: DataFrame, name: str, write: Callable):
    """Run the query that reads a topic and hands its rows on; with ``drain`` to its end."""
    writer = lines.writeStream.queryName(name).option("checkpointLocation", f"{options.output}/checkpoints/{name}")
    query = _trigger(writer.foreachBatch(write), options).start()
    if options.drain:
        query.awaitTermination()
    return query


def _on_time(
    spark: SparkSession, options: Options, lines: DataFrame, name: str, schema: T.StructType, delay: timedelta,
    complete: Column,
) -> tuple[DataFrame, object]:
    """The rows of a topic that come in time, as a stream. Late rows and rows that no operator can use are kept in tables
    of their own, ``late`` and ``rejects`` beside ``on_time``."""
    handover = HandOver(f"{options.output}/tables/{name}")
    write = split_by_time(handover, lambda batch: messages.parse_strict(batch, schema), delay, complete)
    split = _split(options, lines, name, write)
    return handover.follow(spark, "on_time", schema), split


def _wait(queries: list) -> None:
    for q in queries:
        q.awaitTermination()


def run_sessions(spark: SparkSession, options: Options) -> None:
    raw = _topic(spark, options, schemas.TOPIC_CLICKS, "session-aggregator")
    with stream_settings(spark):
        clicks, split = _on_time(
            spark, options, raw, "clicks", schemas.CLICKSTREAM, streams.CLICK_DELAY, sessions.complete())
        out = streams.session_stream(clicks)
        _wait([_publish(options, out, schemas.TOPIC_SESSIONS, "user_sessions", tables.write_sessions), split])


def run_revenue(spark: SparkSession, options: Options) -> None:
    raw = _topic(spark, options, schemas.TOPIC_ORDERS, "revenue-calculator")

    def write(batch: DataFrame, path: str, batch_id: int) -> None:
        tables.write_revenue(revenue.revenue_flat(batch), path, batch_id=batch_id)

    with stream_settings(spark):
        orders, split = _on_time(
            spark, options, raw, "orders", schemas.ORDER, streams.ORDER_DELAY, F.col("timestamp").isNotNull())
        out = streams.revenue_stream(orders)
        _wait([_publish(options, out, schemas.TOPIC_REVENUE, "real_time_revenue", write), split])


def run_fraud(spark: SparkSession, options: Options) -> None:
    raw = _topic(spark, options, schemas.TOPIC_ORDERS, "fraud-detector")
    handover = HandOver(f"{options.output}/tables")

    def publish(bad: DataFrame, batch_id: int) -> None:
        lines = messages.envelope(bad)
        publish_batch(lines, schemas.TOPIC_DLQ, batch_id, bootstrap=options.bootstrap, path=f"{options.output}/topics")

    with stream_settings(spark):
        # The topic is read and parsed once; both rules follow the table of good rows.
        write = streams.dead_letter_split(f"{options.output}/tables", publish)
        split = _split(options, streams.stamped(raw), schemas.TOPIC_ORDERS, write)
        orders = handover.follow(spark, "valid", schemas.ORDER)
        alerts = streams.alert_stream(orders, options.within, options.threshold)
        _wait([_publish(options, alerts, schemas.TOPIC_ALERTS, "fraud_alerts", tables.write_alerts), split])


def product_table(folder: str, **options) -> SyncedTable:
    return SyncedTable(f"{folder}/products", schemas.PRODUCT_LOG, ("product_id",), ("__source_ts_ms",), **options)


def snapshot_rows(products: DataFrame) -> DataFrame:
    """A full copy of the products as rows of the change log."""
    empty = products.sparkSession.createDataFrame([], schemas.PRODUCT_LOG)
    return changes.with_snapshot(products, empty)


def _sync(options: Options, products: DataFrame):
    """Keep the table of current products, from a snapshot on if there is one."""
    synced = product_table(f"{options.output}/tables")
    if options.snapshot:
        spark = products.sparkSession
        synced.load_snapshot(snapshot_rows(spark.read.parquet(options.snapshot)), options.fence)
    log = T.StructType.fromDDL(schemas.PRODUCT_LOG)
    required = ["product_id", "__source_ts_ms", "__deleted"]
    rows = messages.accepted(messages.parse_safe(products, log, required))
    writer = rows.writeStream.queryName("products").option(
        "checkpointLocation", f"{options.output}/checkpoints/products"
    ).foreachBatch(synced.write_batch)
    return _trigger(writer, options).start()


def run_cdc(spark: SparkSession, options: Options) -> None:
    products = _topic(spark, options, schemas.TOPIC_CDC_PRODUCTS, "cdc-product-processor")
    orders = _topic(spark, options, schemas.TOPIC_CDC_ORDERS, "cdc-order-processor")
    with stream_settings(spark):
        _wait([
            _start(options, streams.price_feed_stream(products), "cdc.price-changes"),
            _start(options, streams.order_feed_stream(orders), "cdc.order-changes"),
            _sync(options, products),
        ])


JOBS: dict[str, Callable[[SparkSession, Options], DataFrame | None]] = {
    "sessions": run_sessions,
    "revenue": run_revenue,
    "fraud": run_fraud,
    "cdc": run_cdc,
    "daily": run_daily,
}
DEFAULT_JOB = "sessions"


def run_job(spark: SparkSession, options: Options, name: str | None = None) -> DataFrame | None:
    name = name or DEFAULT_JOB
    if name not in JOBS:
        raise ValueError(f"unknown job {name!r}; choose one of {', '.join(JOBS)}")
    prepare(spark).conf.set(CHECKPOINT_CONF, options.checkpoint_every)
    counters = Counters()
    spark.streams.addListener(counters)
    try:
        return JOBS[name](spark, options)
    finally:
        spark.streams.removeListener(counters)
        counters.log(f"job {name}")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="basketry")
    parser.add_argument("--job", default=DEFAULT_JOB)
    parser.add_argument("--output", required=True)
    parser.add_argument("--input")
    parser.add_argument("--topics")
    parser.add_argument("--bootstrap")
    parser.add_argument("--date")
    parser.add_argument("--snapshot")
    parser.add_argument("--fence", type=int, default=0)
    parser.add_argument("--drain", action="store_true")
    parser.add_argument("--every")
    parser.add_argument("--checkpoint-every", default=CHECKPOINT_EVERY)
    args = vars(parser.parse_args(argv))
    job = args.pop("job")
    failed = run_job(build_session(f"basketry-{job}"), Options(**args), job)
    if failed is not None and failed.take(1):
        failed.show(truncate=False)
        raise SystemExit("daily tables failed their checks")


if __name__ == "__main__":
    main()
