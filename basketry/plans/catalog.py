"""Registered queries: every operator applied to the whole tables of a folder.

The tables hold one order per user and day or so, all order dates are midnight and amounts go up to
half a million. Where the reference values of a rule would find nothing in them, the parameter is
set here; the operators keep their own defaults.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import files
from ..functions import alerts as scoring
from ..functions.times import event_time, plain
from ..operators import changes, daily, fraud, quality, revenue, serving, sessions
from ..schemas import (
    CLICKSTREAM, CONTRACTS, ORDER, PRODUCT_LOG, TOPIC_ALERTS, TOPIC_CDC_ORDERS, TOPIC_CDC_PRODUCTS, TOPIC_CLICKS, TOPIC_DLQ, TOPIC_ORDERS,
    TOPIC_REVENUE, TOPIC_SESSIONS, get_schema,
)
from ..session import prepare, work_dir
from ..sources import feeds, messages, tables
from ..sources.feeds import table
from ..sources.topics import read_table_stream, to_wire
from ..streaming import jobs
from ..streaming.handover import LATE, HandOver, late_schema
from ..streaming.runner import StreamRun, forget_last_batch, run_to_table
from ..streaming.seen import SeenUsers
from ..streaming.state import open_sessions, seen_users
from ..streaming.stock import RunningStock
from ..streaming.sync import SyncedTable
from .jobs import product_table, snapshot_rows

Query = Callable[[SparkSession, str], DataFrame]

DAY = timedelta(days=1)
LONG_GAP = timedelta(hours=6)
RAPID_PURCHASES = timedelta(days=1)
RAPID_PLACED = timedelta(days=30)
THRESHOLD_PURCHASES = 100.0
THRESHOLD_PLACED = 250_000.0
PROCESS_DATE = "1998-10-03"
AS_OF = "2001-08-01"
ALERT_USER = "963"
SESSION_USER = "7"

QUERIES: dict[str, Query] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(fn(prepare(spark), folder))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


# --- inputs -----------------------------------------------------------------------------------


def _clicks(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.clicks(table(spark, folder, "events"))


def _click_stream(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.clicks(read_table_stream(spark, folder, "events"))


def _purchases(spark: SparkSession, folder: str) -> DataFrame:
    return event_time(feeds.purchase_orders(table(spark, folder, "events")))


def _purchase_stream(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.purchase_orders(read_table_stream(spark, folder, "events"))


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    return event_time(feeds.placed_orders(table(spark, folder, "orders")))


def _placed_with_region(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.with_region(_placed(spark, folder), table(spark, folder, "customer"), table(spark, folder, "nation"))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.order_lines(table(spark, folder, "lineitem"), table(spark, folder, "part"))


def _sold_items(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder).select("order_id", "category", "total_price")
    return _placed(spark, folder).select("order_id", "event_time", "order_status").join(lines, "order_id")


# What each report reads; the feed joins no table beyond it.
REVENUE_COLUMNS = ("order_id", "customer_id", "order_date", "category", "amount", "quantity", "status")
CITY_COLUMNS = ("order_id", "order_date", "city", "amount", "status")
STATUS_COLUMNS = ("order_id", "amount", "status")
PRODUCT_COLUMNS = ("order_date", "product_id", "amount", "quantity", "status")
REPORT_COLUMNS = tuple(dict.fromkeys(REVENUE_COLUMNS + CITY_COLUMNS))


def _delivered(spark: SparkSession, folder: str, columns: tuple[str, ...], day: str | None = None) -> DataFrame:
    return feeds.daily_orders(spark, folder, day=day, statuses=(daily.DELIVERED,), columns=columns)


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)


def _alert_columns(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("related_events", F.array_join("related_events", ","))


def _product_row() -> T.StructType:
    return T.StructType([
        T.StructField("product_id", T.IntegerType()),
        T.StructField("sku", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("price", T.DoubleType()),
    ])


def _unwrapped(part: DataFrame) -> DataFrame:
    return messages.unwrap(feeds.product_changes(part).select("value"), _product_row())


# --- daily job --------------------------------------------------------------------------------


@query
def daily_orders_scan(spark, folder):
    return feeds.daily_orders(spark, folder, day=PROCESS_DATE)


@query
def daily_revenue(spark, folder):
    return daily.daily_revenue(_delivered(spark, folder, REVENUE_COLUMNS))


@query
def daily_top_cities(spark, folder):
    return daily.top_cities(_delivered(spark, folder, CITY_COLUMNS))


@query
def order_funnel(spark, folder):
    funnel = daily.order_funnel(feeds.daily_orders(spark, folder, columns=STATUS_COLUMNS))
    return funnel.withColumn("percentage", F.col("percentage").cast("double"))


@query
def daily_summary(spark, folder):
    return daily.daily_summary(feeds.daily_orders(spark, folder, columns=STATUS_COLUMNS))


@query
def top_products(spark, folder):
    return daily.top_products(_delivered(spark, folder, PRODUCT_COLUMNS))


@query
def customer_cohorts(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("order_date")
    )
    return daily.customer_cohorts(orders)


@query
def dq_daily(spark, folder):
    # Three reports of one read: the lines are kept on disk, as the daily job does.
    lines = feeds.daily_orders(spark, folder, columns=REPORT_COLUMNS).persist(StorageLevel.DISK_ONLY)
    reports = (
        daily.daily_revenue(lines, ordered=False),
        daily.top_cities(lines),
        daily.order_funnel(lines, ordered=False),
    )
    return quality.daily_checks(dict(zip(quality.DAILY_TABLES, reports)))


@query
def dq_contract(spark, folder):
    events = table(spark, folder, "events")
    checked = {
        "clickstream": feeds.clicks(events),
        "order": feeds.purchase_orders(events),
        "inventory": feeds.stock_events(events),
        "fraud_alert": fraud.fraud_alerts(_purchases(spark, folder), RAPID_PURCHASES, THRESHOLD_PURCHASES),
    }
    parts = [quality.contract_checks(df, name, CONTRACTS[name]) for name, df in checked.items()]
    return reduce(DataFrame.unionByName, parts)


# --- sessions ---------------------------------------------------------------------------------


@query
def session_metrics(spark, folder):
    return sessions.session_metrics(_clicks(spark, folder))


@query
def session_metrics_6h(spark, folder):
    return sessions.session_metrics(_clicks(spark, folder), LONG_GAP)


@query
def session_metrics_stream(spark, folder):
    return run_to_table(jobs.session_stream(_click_stream(spark, folder), LONG_GAP), "sessions")


@query
def sessions_json(spark, folder):
    out = sessions.session_metrics(_clicks(spark, folder), LONG_GAP)
    for column in ("session_start", "session_end"):
        out = out.withColumn(column, F.unix_millis(column))
    return to_wire(out)


def _stored_sessions(spark, folder):
    """The session table as its job writes it, read back."""
    path = work_dir(spark, "user-sessions")
    rows = sessions.session_metrics(_clicks(spark, folder), LONG_GAP)
    tables.write_sessions(rows, path)
    return serving.Stored(spark, path, _ddl(rows), "day", "session_id")


@query
def sessions_list(spark, folder):
    return serving.sessions_list(_stored_sessions(spark, folder).rows())


@query
def sessions_by_user(spark, folder):
    return serving.sessions_by_user(_stored_sessions(spark, folder), SESSION_USER)


# --- revenue ----------------------------------------------------------------------------------


@query
def revenue_1min(spark, folder):
    return revenue.revenue_windows(_purchases(spark, folder))


@query
def revenue_1day(spark, folder):
    return revenue.revenue_windows(fraud.with_first_order_flag(_placed(spark, folder)), DAY)


@query
def revenue_fractions(spark, folder):
    """Amounts of four decimals: they are added as they are, and only the window's total is rounded."""
    orders = _purchases(spark, folder).withColumn("total_amount", F.col("total_amount") / 100)
    totals = revenue.revenue_windows(orders, DAY).select("window_start", "gmv", "average_order_value")
    items = orders.select("event_time", "order_status", F.col("items")[0]["category"].alias("category"),
                          F.col("total_amount").alias("total_price"))
    by_category = revenue.item_revenue(items, DAY).select("window_start", "category", "revenue")
    return by_category.join(totals, "window_start")


@query
def revenue_by_category(spark, folder):
    return revenue.revenue_by_category(_purchases(spark, folder))


@query
def revenue_by_category_1day(spark, folder):
    return revenue.item_revenue(_sold_items(spark, folder), DAY)


@query
def orders_by_region(spark, folder):
    return revenue.orders_by_region(_placed_with_region(spark, folder), DAY)


@query
def revenue_flat(spark, folder):
    return revenue.revenue_flat_rows(_purchases(spark, folder)).drop("ingestion_timestamp")


@query
def revenue_1min_stream(spark, folder):
    metrics = run_to_table(jobs.revenue_stream(_purchase_stream(spark, folder)), "revenue")
    return metrics.drop("revenue_by_category", "orders_by_region")


@query
def revenue_maps_stream(spark, folder):
    metrics = run_to_table(jobs.revenue_stream(_purchase_stream(spark, folder)), "revenue-maps")

    def entries(kind: str, column: str) -> DataFrame:
        return metrics.select(
            "window_start", F.lit(kind).alias("kind"), F.explode(column).alias("key", "value")
        ).withColumn("value", F.col("value").cast("double"))

    return entries("category", "revenue_by_category").unionByName(entries("region", "orders_by_region"))


@query
def revenue_top_category(spark, folder):
    return revenue.top_categories(revenue.revenue_by_category(_purchases(spark, folder), DAY))


@query
def revenue_summary(spark, folder):
    # The bounds of the week reach the orders scan, and only its orders meet the lines.
    last = F.lit(AS_OF).cast("date")
    orders = feeds.between_days(table(spark, folder, "orders"), F.date_sub(last, 6), last)
    placed = event_time(feeds.placed_orders(orders))
    lines = _lines(spark, folder).select("order_id", "category", "total_price")
    sold = placed.select("order_id", "event_time", "order_status").join(lines, "order_id")
    return revenue.revenue_summary(placed, sold, AS_OF)


@query
def revenue_realtime(spark, folder):
    path = work_dir(spark, "real-time-revenue")
    rows = revenue.revenue_flat_rows(_purchases(spark, folder))
    tables.write_revenue(rows, path)
    return serving.latest_revenue(serving.Stored(spark, path, _ddl(rows), "hour", "window_start_timestamp"))


# --- fraud ------------------------------------------------------------------------------------


@query
def risk_score(spark, folder):
    flagged = fraud.with_first_order_flag(_placed(spark, folder))
    return flagged.select(
        "order_id",
        "total_amount",
        "is_first_order",
        scoring.risk_score(F.col("total_amount"), F.col("is_first_order")).alias("risk_score"),
    )


@query
def rapid_orders(spark, folder):
    alerts = fraud.rapid_orders(_purchases(spark, folder), RAPID_PURCHASES, detected_at=F.col("event_time"))
    return _alert_columns(alerts)


@query
def high_value_first_order(spark, folder):
    alerts = fraud.high_value_first_order(
        _placed(spark, folder), THRESHOLD_PLACED, detected_at=F.col("event_time")
    )
    return _alert_columns(alerts)


@query
def location_anomaly(spark, folder):
    return _alert_columns(fraud.location_anomaly(_purchases(spark, folder), detected_at=F.col("event_time")))


def _placed_alerts(spark, folder):
    return fraud.fraud_alerts(
        _placed(spark, folder), RAPID_PLACED, THRESHOLD_PLACED, detected_at=F.col("event_time")
    )


@query
def fraud_alerts(spark, folder):
    return _alert_columns(_placed_alerts(spark, folder))


def _stored_alerts(spark, folder):
    path = work_dir(spark, "fraud-alerts")
    rows = _placed_alerts(spark, folder)
    tables.write_alerts(rows, path)
    return serving.Stored(spark, path, _ddl(rows), "day", "alert_id")


@query
def unreadable_files(spark, folder):
    """Alerts of a table in which a damaged file lies beside those of the newest day, and what is noted of that file."""
    alerts = _stored_alerts(spark, folder)
    spark.createDataFrame([("damage",)], "value string").coalesce(1).write.text(f"{alerts.path}/_damage")
    [broken] = files.files(spark, f"{alerts.path}/_damage")
    files.move(spark, broken, f"{alerts.path}/{alerts.folders()[0]}/broken/damage.parquet")
    rows = alerts.rows()
    noted = alerts.unreadable().select(
        F.lit("unreadable").alias("kind"), F.regexp_extract("file", "[^/]+$", 0).alias("name"))
    return rows.select(F.lit("alert").alias("kind"), F.col("alert_id").alias("name")).unionByName(noted)


@query
def latest_alerts(spark, folder):
    return _alert_columns(serving.latest_alerts(_stored_alerts(spark, folder)))


@query
def alerts_by_user(spark, folder):
    return _alert_columns(serving.alerts_by_user(_stored_alerts(spark, folder), ALERT_USER))


@query
def rapid_orders_stream(spark, folder):
    alerts = jobs.rapid_order_stream(
        _purchase_stream(spark, folder), RAPID_PURCHASES, detected_at=F.col("event_time")
    )
    return _alert_columns(run_to_table(alerts, "rapid-orders"))


@query
def high_value_first_order_stream(spark, folder):
    alerts = jobs.first_order_stream(
        _purchase_stream(spark, folder), THRESHOLD_PURCHASES, detected_at=F.col("event_time")
    )
    return _alert_columns(run_to_table(alerts, "first-orders"))


@query
def fraud_alerts_stream(spark, folder):
    alerts = jobs.alert_stream(
        _purchase_stream(spark, folder), RAPID_PURCHASES, THRESHOLD_PURCHASES, detected_at=F.col("event_time")
    )
    return _alert_columns(run_to_table(alerts, "alerts"))


# --- messages and dead letters ----------------------------------------------------------------


def _parsed_orders(spark, folder):
    raw = feeds.order_messages(table(spark, folder, "orders"))
    return messages.parse_safe(raw, ORDER, ["order_id", "user_id"])


@query
def dlq_valid(spark, folder):
    rows = messages.accepted(_parsed_orders(spark, folder))
    item = F.explode("items").alias("item")
    return rows.select("order_id", "user_id", "order_status", "total_amount", "timestamp", "is_first_order", item).select(
        "order_id", "user_id", "order_status", "total_amount", "timestamp", "is_first_order", "item.product_id",
        "item.category", "item.quantity", "item.total_price"
    )


@query
def dlq_rejected(spark, folder):
    return messages.rejected(_parsed_orders(spark, folder)).select("error", "original")


@query
def dlq_stream(spark, folder):
    run = StreamRun.new(spark, "dead-letters")
    jobs.split_dead_letters(feeds.order_messages(read_table_stream(spark, folder, "orders")), run)
    valid = spark.read.parquet(f"{run.folder}/valid")
    dead = spark.read.parquet(f"{run.folder}/dead_letters")
    return valid.select(
        F.lit("valid").alias("kind"), F.col("order_id").alias("payload"), F.lit("").alias("error")
    ).unionByName(dead.select(F.lit("dead").alias("kind"), F.col("original").alias("payload"), "error"))


def _arriving(rows: DataFrame, by: Column, number: int) -> list[DataFrame]:
    """The rows in so many parts, one after the other by arrival."""
    ends = rows.agg(F.min(by).alias("low"), F.max(by).alias("high")).first()
    if ends.low is None:
        return [rows]
    part = F.floor((by - F.lit(ends.low)) * F.lit(number) / F.lit(ends.high - ends.low + 1))
    return [rows.filter(part == i) for i in range(number)]


def _in_halves(spark: SparkSession, label: str, rows: DataFrame, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stream over the earlier half of the rows by time, stopped, and started anew from its checkpoint over the rest:
    what is still open in between comes back from the stored state."""
    run = StreamRun.new(spark, label)
    landing = f"{run.folder}/landing"
    bounds = rows.agg(((F.min("timestamp") + F.max("timestamp")) / 2).alias("middle")).first()
    early = F.col("timestamp") < F.lit(bounds.middle)
    for part in (early, ~early):
        rows.filter(part).write.mode("append").parquet(landing)
        stream = make(spark.readStream.schema(rows.schema).parquet(landing))
        StreamRun(spark, run.folder).drain(stream)
    return run.read(stream)


@query
def restart_sessions_stream(spark, folder):
    return _in_halves(spark, "restart", _clicks(spark, folder), lambda clicks: jobs.session_stream(clicks, LONG_GAP))


@query
def restart_revenue_stream(spark, folder):
    orders = feeds.purchase_orders(table(spark, folder, "events"))
    out = _in_halves(spark, "restart", orders, jobs.revenue_stream)
    return out.drop("revenue_by_category", "orders_by_region")


@query
def open_sessions_state(spark, folder):
    """The sessions that a stream has not closed yet, read from its stored state."""
    run = StreamRun.new(spark, "open-sessions")
    run.drain(jobs.session_stream(_click_stream(spark, folder), LONG_GAP))
    return open_sessions(spark, run.checkpoint, LONG_GAP)


@query
def seen_users_state(spark, folder):
    """The users that the first-order rule remembers, read from its stored state."""
    run = StreamRun.new(spark, "seen-users")
    run.drain(jobs.first_order_stream(_purchase_stream(spark, folder), THRESHOLD_PURCHASES))
    return seen_users(spark, run.checkpoint)


@query
def first_order_bounded_stream(spark, folder):
    """The first-order rule over four batches, with the users seen in a table."""
    run = StreamRun.new(spark, "seen")
    landing = f"{run.folder}/landing"
    orders = feeds.purchase_orders(table(spark, folder, "events"))
    seen = SeenUsers(run.table, THRESHOLD_PURCHASES, compact_every=3)
    replay = {"detected_at": F.col("event_time")}
    for part in _arriving(orders, F.col("timestamp"), 4):
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(orders.schema).parquet(landing)
        run.drain_batches(stream, lambda batch, number: seen.write_batch(batch, number, **replay))
    return _alert_columns(seen.alerts(spark))


@query
def late_rows_stream(spark, folder):
    """Hourly click counts when all ``error`` events arrive after everything else: the ones whose
    hour has closed by then are dropped."""
    run = StreamRun.new(spark, "late-rows")
    landing = f"{run.folder}/landing"
    events = event_time(_clicks(spark, folder)).select("event_time", "event_type")
    is_late = F.col("event_type") == "ERROR"
    events.filter(~is_late).write.parquet(landing)
    stream = (
        spark.readStream.schema(events.schema).parquet(landing)
        .withWatermark("event_time", "10 seconds")
        .groupBy(F.window("event_time", "1 hour"))
        .agg(F.count("*").alias("events"))
        .select(F.col("window.start").alias("window_start"), "events")
    )
    run.drain(stream)
    events.filter(is_late).write.mode("append").parquet(landing)
    run.drain(stream)
    return run.read(stream)


# --- change data ------------------------------------------------------------------------------


@query
def cdc_unwrap(spark, folder):
    return _unwrapped(table(spark, folder, "part")).select(
        "product_id",
        "sku",
        "name",
        "price",
        F.col("__op").alias("op"),
        F.col("__table").alias("source_table"),
        F.col("__source_ts_ms").alias("source_ts_ms"),
        F.col("__deleted").alias("is_deleted"),
    )


@query
def cdc_rejected(spark, folder):
    envelopes = feeds.product_changes(table(spark, folder, "part")).select("value")
    return messages.rejected(messages.read_envelopes(envelopes, _product_row())).select("error", "original")


def _product_messages(part: DataFrame) -> DataFrame:
    return messages.flatten_json(_unwrapped(part))


@query
def cdc_products_parsed(spark, folder):
    return messages.parse_product_changes(_product_messages(table(spark, folder, "part")))


@query
def cdc_orders_parsed(spark, folder):
    return messages.parse_order_changes(feeds.order_changes(table(spark, folder, "orders")))


@query
def cdc_price_feed(spark, folder):
    return changes.price_feed(
        messages.parse_product_changes(_product_messages(table(spark, folder, "part")))
    )


@query
def cdc_order_feed(spark, folder):
    return changes.order_feed(
        messages.parse_order_changes(feeds.order_changes(table(spark, folder, "orders")))
    )


@query
def cdc_price_feed_stream(spark, folder):
    stream = _product_messages(read_table_stream(spark, folder, "part"))
    return run_to_table(jobs.price_feed_stream(stream), "price-feed")


@query
def cdc_order_feed_stream(spark, folder):
    stream = feeds.order_changes(read_table_stream(spark, folder, "orders"))
    return run_to_table(jobs.order_feed_stream(stream), "order-feed")


def _state(changes_log: DataFrame) -> DataFrame:
    state = changes.current_state(changes_log, ["product_id"], ["__source_ts_ms"])
    return state.select("product_id", "sku", "name", "price", F.col("__op").alias("op"))


@query
def cdc_current_state(spark, folder):
    part = table(spark, folder, "part")
    snapshot = part.select(
        F.col("p_partkey").cast("int").alias("product_id"),
        F.concat("p_brand", F.lit("-"), "p_partkey").alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
    )
    log = _unwrapped(part).filter(F.col("__op") != "r")
    return _state(changes.with_snapshot(snapshot, log))


@query
def cdc_current_state_stream(spark, folder):
    """The state table as a stream of change rows keeps it: four batches, one of which folds the table."""
    run = StreamRun.new(spark, "product-sync")
    landing = f"{run.folder}/landing"
    log = _unwrapped(table(spark, folder, "part"))
    log.repartition(4, F.pmod(F.xxhash64("product_id", "__op", "__source_ts_ms"), F.lit(4))).write.parquet(landing)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    synced = SyncedTable(run.table, PRODUCT_LOG, ("product_id",), ("__source_ts_ms",), compact_every=3)
    run.drain_batches(stream, synced.write_batch)
    return synced.read(spark).select("product_id", "sku", "name", "price", F.col("__op").alias("op"))


@query
def cdc_snapshot_then_stream(spark, folder):
    """A snapshot taken in the middle of the last round of changes, then the whole log in four batches with a stop
    after two: what the snapshot holds already, deletes among it, stays as it is."""
    run = StreamRun.new(spark, "product-snapshot")
    part = table(spark, folder, "part")
    log = _unwrapped(part)
    fence = log.agg((F.max("__source_ts_ms") - F.floor(F.count_distinct("product_id") / 2)).alias("ms")).first().ms
    products = changes.current_state(log.filter(F.col("__source_ts_ms") <= fence), ["product_id"], ["__source_ts_ms"])
    synced = product_table(run.folder, compact_every=3)
    synced.load_snapshot(snapshot_rows(products.select("product_id", "sku", "name", "price")), fence)
    landing = f"{run.folder}/landing"
    parts = F.pmod(F.xxhash64("product_id", "__op", "__source_ts_ms"), F.lit(4))
    for half in (parts < 2, parts >= 2):
        log.filter(half).repartition(2, parts).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(landing)
        StreamRun(spark, run.folder).drain_batches(stream, synced.write_batch)
    return synced.read(spark).select("product_id", "sku", "name", "price")


@query
def price_changes(spark, folder):
    return changes.price_changes(_unwrapped(table(spark, folder, "part")))


@query
def stock_running(spark, folder):
    moves = feeds.stock_movements(table(spark, folder, "lineitem"))
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "movement_type", "quantity"]
    return changes.running_stock(moves, order)


@query
def inventory_latest(spark, folder):
    return changes.latest_inventory(feeds.stock_events(table(spark, folder, "events")))


@query
def stock_level_stream(spark, folder):
    moves = feeds.stock_movements(read_table_stream(spark, folder, "lineitem"))
    run = StreamRun.new(spark, "stock-levels")
    kept = jobs.keep_products(run, changes.stock_levels(moves), "movements")
    return kept.read(spark).drop("__deleted")


@query
def stock_running_stream(spark, folder):
    """Stock after each movement, from messages in three batches in which movements are up to a month out of order."""
    run = StreamRun.new(spark, "stock-running")
    landing = f"{run.folder}/landing"
    lineitem = table(spark, folder, "lineitem")
    # A movement arrives up to a month after its time.
    arrival = F.unix_date(F.to_date("l_shipdate")) + F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(30))
    order = ("l_orderkey", "l_linenumber", "l_suppkey", "movement_type", "quantity")
    for part in _arriving(lineitem, arrival, 3):
        feeds.movement_messages(part).write.mode("append").parquet(landing)
        lines = spark.readStream.schema("value string").parquet(landing)
        moves = feeds.movements_of_messages(messages.accepted(messages.parse_events(lines, "inventory_movements")))
        stock = RunningStock(run.table, moves.schema, order, timedelta(days=31))
        done = run.drain_batches(moves, stock.write_batch)
    stock.close(spark, done[-1]["batchId"] + 1)
    return stock.read(spark)


@query
def inventory_latest_stream(spark, folder):
    events = feeds.stock_events(read_table_stream(spark, folder, "events"))
    run = StreamRun.new(spark, "inventory")
    kept = jobs.keep_products(run, changes.latest_inventory(events, counted=True), "events")
    return kept.read(spark).drop("__deleted", "events")


@query
def order_events_nested(spark, folder):
    """Order events item by item: an order of any size fits."""
    events = feeds.order_events(_placed(spark, folder), _lines(spark, folder))
    return events.select("order_id", "user_id", "order_status", "item.*")


@query
def order_events_parts(spark, folder):
    """Nested order events in parts, written as messages, parsed by the schema of that name, and taken apart again."""
    events = feeds.order_event_parts(_placed(spark, folder), _lines(spark, folder), most=3)
    fields = F.struct("order_id", "user_id", "order_status", "total_amount", "timestamp", "items")
    lines = events.select(F.to_json(fields).alias("value"))
    rows = messages.accepted(messages.parse_safe(lines, get_schema("order"), ["order_id", "user_id"]))
    item = F.explode_outer("items").alias("item")
    return rows.select("order_id", "user_id", "order_status", "total_amount", item).select(
        "order_id", "user_id", "order_status", "total_amount", "item.product_id", "item.product_name", "item.category",
        "item.quantity", "item.total_price")


@query
def order_items_parsed(spark, folder):
    """Order items from their messages, and what is wrong with those that cannot be used."""
    parsed = messages.parse_events(feeds.order_item_messages(table(spark, folder, "lineitem")), "order_items")
    good = messages.accepted(parsed).select(
        F.lit("").alias("error"), "order_id", "product_id", "quantity", F.col("unit_price").cast("double").alias("unit_price"),
        F.col("total_price").cast("double").alias("total_price"))
    bad = messages.rejected(parsed).groupBy("error").agg(F.count(F.lit(1)).cast("int").alias("order_id"))
    none = {c: F.lit(None).cast(t) for c, t in good.dtypes if c not in ("error", "order_id")}
    return good.unionByName(bad.withColumns(none))


# --- result tables ----------------------------------------------------------------------------


@query
def daily_revenue_table(spark, folder):
    """All days loaded, then one day run again and merged again: each row is there once."""
    path = work_dir(spark, "daily-revenue")
    report = daily.daily_revenue(_delivered(spark, folder, REVENUE_COLUMNS), ordered=False)
    tables.write_daily(report, path, mode="append")
    one_day = daily.daily_revenue(_delivered(spark, folder, REVENUE_COLUMNS, day=PROCESS_DATE), ordered=False)
    tables.replace_day(one_day, path, PROCESS_DATE)
    tables.write_daily(one_day, path, mode="merge", keys=["order_date", "category"])
    return spark.read.schema(report.schema).parquet(path)


@query
def daily_rerun_table(spark, folder):
    """All days loaded, then one run again after its orders were cancelled: nothing of that day is left."""
    path = work_dir(spark, "daily-rerun")
    lines = _delivered(spark, folder, REVENUE_COLUMNS)
    report = daily.daily_revenue(lines, ordered=False)
    tables.write_daily(report, path)
    gone = lines.withColumn("status", F.when(F.col("order_date") != PROCESS_DATE, F.col("status")))
    tables.replace_day(daily.daily_revenue(gone, ordered=False), path, PROCESS_DATE)
    return spark.read.schema(report.schema).parquet(path)


@query
def user_sessions_table(spark, folder):
    path = work_dir(spark, "user-sessions")
    out = sessions.session_metrics(_clicks(spark, folder), LONG_GAP)
    tables.write_sessions(out, path)
    return spark.read.parquet(path).select(*out.columns)


@query
def real_time_revenue_table(spark, folder):
    path = work_dir(spark, "real-time-revenue")
    out = revenue.revenue_flat_rows(_purchases(spark, folder))
    tables.write_revenue(out, path)
    return spark.read.parquet(path).select(*out.columns).drop("ingestion_timestamp")


@query
def fraud_alerts_table(spark, folder):
    path = work_dir(spark, "fraud-alerts")
    out = fraud.fraud_alerts(
        _purchases(spark, folder), RAPID_PURCHASES, THRESHOLD_PURCHASES, detected_at=F.col("event_time")
    )
    tables.write_alerts(out, path)
    return _alert_columns(spark.read.parquet(path).select(*out.columns))


# --- jobs, over topics of files ---------------------------------------------------------------


def _job(spark: SparkSession, name: str, topics: dict[str, DataFrame], **options) -> str:
    """Write the topics, run the job over them to the end, and return its output folder."""
    from .jobs import Options, run_job

    base = work_dir(spark, f"job-{name}")
    for topic, lines in topics.items():
        lines.select("value").write.text(f"{base}/topics/{topic}")
    run_job(spark, Options(output=f"{base}/out", topics=f"{base}/topics", drain=True, **options), name)
    return f"{base}/out"


def _job_again(spark: SparkSession, name: str, out: str, more: dict[str, DataFrame] | None = None, **options) -> None:
    """Run a job on, from where it stopped, after more lines have come to its topics."""
    from .jobs import Options, run_job

    topics = f"{out.rsplit('/', 1)[0]}/topics"
    for topic, lines in (more or {}).items():
        lines.select("value").write.mode("append").text(f"{topics}/{topic}")
    run_job(spark, Options(output=out, topics=topics, drain=True, **options), name)


def _topic_rows(spark: SparkSession, out: str, topic: str, fields: str) -> DataFrame:
    lines = spark.read.schema("value string").text(f"{out}/topics/{topic}")
    return lines.select(F.from_json("value", fields).alias("m")).select("m.*")


@query
def job_sessions(spark, folder):
    """Sessions of the click topic, with whether the result topic has each of them too."""
    out = _job(spark, "sessions", {TOPIC_CLICKS: to_wire(_clicks(spark, folder))})
    told = _topic_rows(spark, out, TOPIC_SESSIONS, "user_id string, session_id string").distinct()
    told = told.withColumn("published", F.lit(True))
    kept = spark.read.parquet(f"{out}/tables/user_sessions").drop("day", "batch")
    return kept.join(told, ["user_id", "session_id"], "left")


@query
def late_sessions_stream(spark, folder):
    """Sessions of the click topic when all ``ERROR`` events come after everything else, and those of them that the
    watermark had passed by then: each event is in a session or in the table of late rows."""
    clicks = _clicks(spark, folder)
    is_late = F.col("event_type") == "ERROR"
    out = _job(spark, "sessions", {TOPIC_CLICKS: to_wire(clicks.filter(~is_late))})
    _job_again(spark, "sessions", out, {TOPIC_CLICKS: to_wire(clicks.filter(is_late))})
    kept = spark.read.parquet(f"{out}/tables/user_sessions")
    late = HandOver(f"{out}/tables/clicks").read(spark, LATE, late_schema(CLICKSTREAM))
    return kept.select(
        F.lit("session").alias("kind"), "user_id", F.col("session_id").alias("id"),
        F.unix_millis("session_end").alias("ms"), F.col("duration_seconds").alias("amount")
    ).unionByName(late.select(
        F.lit("late").alias("kind"), "user_id", F.col("event_id").alias("id"), F.col("timestamp").alias("ms"),
        F.col("lateness_ms").alias("amount")))


@query
def late_revenue_stream(spark, folder):
    """Revenue of the order topic when all first orders come after everything else, and those that were late."""
    orders = feeds.purchase_orders(table(spark, folder, "events"))
    is_late = F.coalesce(F.col("is_first_order"), F.lit(False))
    out = _job(spark, "revenue", {TOPIC_ORDERS: to_wire(orders.filter(~is_late))})
    _job_again(spark, "revenue", out, {TOPIC_ORDERS: to_wire(orders.filter(is_late))})
    kept = _topic_rows(spark, out, TOPIC_REVENUE, "window_start timestamp, gmv double, order_count bigint")
    late = HandOver(f"{out}/tables/orders").read(spark, LATE, late_schema(ORDER))
    return kept.select(
        F.lit("window").alias("kind"), F.lit("").alias("id"), F.unix_millis("window_start").alias("ms"),
        F.col("gmv").alias("amount"), F.col("order_count").alias("n")
    ).unionByName(late.select(
        F.lit("late").alias("kind"), F.col("order_id").alias("id"), F.col("timestamp").alias("ms"),
        F.col("total_amount").alias("amount"), F.col("lateness_ms").alias("n")))


@query
def job_revenue(spark, folder):
    orders = feeds.purchase_orders(table(spark, folder, "events"))
    out = _job(spark, "revenue", {TOPIC_ORDERS: to_wire(orders)})
    told = _topic_rows(spark, out, TOPIC_REVENUE, "window_start timestamp, gmv double")
    told = told.select(F.col("window_start").alias("window_start_timestamp"), F.col("gmv").alias("published_gmv"))
    kept = spark.read.parquet(f"{out}/tables/real_time_revenue").drop("hour", "batch", "ingestion_timestamp")
    return kept.join(told, "window_start_timestamp", "left")


def _order_topic(spark, folder):
    """Purchases as order messages, and messages of all placed orders that were cut off."""
    orders = to_wire(feeds.purchase_orders(table(spark, folder, "events")))
    key = F.col("o_orderkey").cast("string")
    cut_off = table(spark, folder, "orders").select(F.concat(F.lit('{"order_id":"'), key, F.lit('","user_id"')).alias("value"))
    return orders.union(cut_off)


@query
def job_fraud(spark, folder):
    """Alerts and dead letters of the order topic, both as table and as topic."""
    topics = {TOPIC_ORDERS: _order_topic(spark, folder)}
    return _fraud_results(spark, _job(spark, "fraud", topics, within=RAPID_PURCHASES, threshold=THRESHOLD_PURCHASES))


@query
def job_fraud_retry(spark, folder):
    """The same when every query of the job stops before it has noted its last batch, and runs that batch again."""
    topics = {TOPIC_ORDERS: _order_topic(spark, folder)}
    options = {"within": RAPID_PURCHASES, "threshold": THRESHOLD_PURCHASES}
    out = _job(spark, "fraud", topics, **options)
    forget_last_batch(spark, f"{out}/checkpoints")
    _job_again(spark, "fraud", out, **options)
    return _fraud_results(spark, out)


def _fraud_results(spark, out):
    alerts = spark.read.parquet(f"{out}/tables/fraud_alerts").select("alert_id", "description")
    dead = spark.read.parquet(f"{out}/tables/dead_letters").select("original", "error")
    told = _topic_rows(spark, out, TOPIC_ALERTS, "alert_id string, description string")
    lost = _topic_rows(spark, out, TOPIC_DLQ, "original string, error string")
    parts = [("alert", alerts), ("dead", dead), ("alert told", told), ("dead told", lost)]
    return reduce(DataFrame.unionByName, [
        rows.toDF("payload", "note").select(F.lit(kind).alias("kind"), "payload", "note") for kind, rows in parts
    ])


@query
def job_daily(spark, folder):
    """The daily job for one day, run twice, and all three of its tables."""
    from .jobs import Options, run_job

    base = work_dir(spark, "job-daily")
    lines = feeds.daily_orders(spark, folder, columns=REPORT_COLUMNS)
    tables.write_daily(lines, f"{base}/in")
    options = Options(output=f"{base}/out", input=f"{base}/in", date=PROCESS_DATE)
    for _ in range(2):
        run_job(spark, options, "daily")
    parts = {"daily_revenue_by_category": ("category", "gmv", "order_count"), "daily_top_cities": ("city", "gmv", "order_count"),
             "daily_order_funnel": ("status", "gmv", "count")}
    found = []
    for name, columns in parts.items():
        schema = f"{columns[0]} string, gmv double, {columns[2]} bigint, order_date string"
        rows = spark.read.schema(schema).parquet(f"{base}/out/{name}")
        found.append(rows.select(
            F.lit(name).alias("report"), "order_date", *[F.col(c).alias(n) for c, n in zip(columns, ("name", "gmv", "n"))]))
    return reduce(DataFrame.unionByName, found)


@query
def job_cdc(spark, folder):
    out = _job(spark, "cdc", {
        TOPIC_CDC_PRODUCTS: _product_messages(table(spark, folder, "part")),
        TOPIC_CDC_ORDERS: feeds.order_changes(table(spark, folder, "orders")),
    })
    return reduce(DataFrame.unionByName, [
        spark.read.schema("value string").text(f"{out}/topics/{topic}").select(F.lit(topic).alias("topic"), "value")
        for topic in ("cdc.price-changes", "cdc.order-changes")
    ])
