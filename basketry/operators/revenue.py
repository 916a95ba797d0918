"""Revenue of fixed time windows over all orders that count as sales."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import MONEY, exact, money_sum, ratio, round2
from ..functions.times import interval
from ..schemas import REVENUE_STATUSES

REVENUE_WINDOW = timedelta(minutes=1)


def sales(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status").isin(*REVENUE_STATUSES))


def _window(width: timedelta) -> Column:
    return F.window("event_time", interval(width))


def _bounds() -> list[Column]:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def revenue_windows(orders: DataFrame, width: timedelta = REVENUE_WINDOW) -> DataFrame:
    """Scalars per window of a static DataFrame with ``event_time``."""
    total = round2(F.coalesce(money_sum(F.col("total_amount")), F.lit(0.0)))
    users = F.count_distinct("user_id") + F.max(F.col("user_id").isNull().cast("int"))
    return (
        sales(orders)
        .groupBy(_window(width))
        .agg(
            F.min("event_time").alias("first_event_ts"),
            F.max("event_time").alias("last_event_ts"),
            total.alias("gmv"),
            F.count("*").alias("order_count"),
            users.cast("bigint").alias("unique_users"),
            F.count_if("is_first_order").alias("first_time_orders"),
        )
        .select(
            *_bounds(),
            "first_event_ts",
            "last_event_ts",
            "gmv",
            "order_count",
            round2(F.col("gmv") / F.col("order_count")).alias("average_order_value"),
            "unique_users",
            "first_time_orders",
        )
    )


def item_revenue(items: DataFrame, width: timedelta = REVENUE_WINDOW) -> DataFrame:
    """Item revenue per window and category, from one row per sold item."""
    return (
        sales(items)
        .filter(F.col("category").isNotNull() & F.col("total_price").isNotNull())
        .groupBy(_window(width), "category")
        .agg(money_sum(F.col("total_price")).alias("revenue"))
        .select(*_bounds(), "category", "revenue")
    )


def revenue_by_category(orders: DataFrame, width: timedelta = REVENUE_WINDOW) -> DataFrame:
    """The same from order events with nested items."""
    items = orders.select("event_time", "order_status", F.explode("items").alias("item"))
    return item_revenue(
        items.select("event_time", "order_status", "item.category", "item.total_price"), width
    )


def orders_by_region(orders: DataFrame, width: timedelta = REVENUE_WINDOW) -> DataFrame:
    return (
        sales(orders)
        .filter(F.col("shipping_address_region").isNotNull())
        .groupBy(_window(width), F.col("shipping_address_region").alias("region"))
        .agg(F.count("*").alias("order_count"))
        .select(*_bounds(), "region", "order_count")
    )


def top_categories(by_category: DataFrame) -> DataFrame:
    """Best category per window; the lowest name among equals."""
    return by_category.groupBy("window_start", "window_end").agg(
        F.min_by("category", F.struct(-F.col("revenue"), F.col("category"))).alias("top_category")
    )


def _folded(orders: DataFrame, width: timedelta) -> DataFrame:
    """Each order fans out into one row per fact it contributes to (the order itself, its user, its region, each
    item). These fold by (window, kind, key), so no task ever holds the users of a window."""
    nothing = F.lit(None).cast(MONEY)

    def fact(kind: str, key: Column, amount: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"), amount.alias("amount"))

    priced = F.filter(
        F.coalesce("items", F.array()),
        lambda i: i["category"].isNotNull() & i["total_price"].isNotNull(),
    )
    facts = F.concat(
        F.array(
            fact("order", F.lit(None).cast("string"), exact(F.col("total_amount"))),
            fact("user", F.col("user_id"), nothing),
        ),
        F.filter(
            F.array(fact("region", F.col("shipping_address_region"), nothing)),
            lambda f: f["key"].isNotNull(),
        ),
        F.transform(priced, lambda i: fact("category", i["category"], exact(i["total_price"]))),
    )
    return (
        sales(orders)
        .select(
            "event_time",
            F.coalesce("is_first_order", F.lit(False)).alias("is_first"),
            F.explode(facts).alias("f"),
        )
        .groupBy(_window(width), F.col("f.kind").alias("kind"), F.col("f.key").alias("key"))
        .agg(
            F.count("*").alias("n"),
            F.sum("f.amount").alias("amount"),
            F.count_if("is_first").alias("first_orders"),
            F.min("event_time").alias("first_event_ts"),
            F.max("event_time").alias("last_event_ts"),
        )
    )


def _of(kind: str, value: Column) -> Column:
    return F.when(F.col("kind") == kind, value)


def _scalars() -> list[Column]:
    return [
        F.min("first_event_ts").alias("first_event_ts"),
        F.max("last_event_ts").alias("last_event_ts"),
        round2(F.coalesce(F.sum(_of("order", F.col("amount"))).cast("double"), F.lit(0.0))).alias("gmv"),
        F.sum(_of("order", F.col("n"))).alias("order_count"),
        F.count_if(F.col("kind") == "user").alias("unique_users"),
        F.sum(_of("order", F.col("first_orders"))).alias("first_time_orders"),
    ]


def revenue_metrics(orders: DataFrame, width: timedelta = REVENUE_WINDOW) -> DataFrame:
    """The whole metrics row, with its maps, for static and streaming input alike. The second grouping meets one row
    per key and turns categories and regions into maps."""

    def as_map(kind: str, value: Column) -> Column:
        return F.map_from_entries(F.collect_list(_of(kind, F.struct(F.col("key"), value))))

    return (
        _folded(orders, width).groupBy("window")
        .agg(
            *_scalars(),
            as_map("category", F.col("amount").cast("double")).alias("revenue_by_category"),
            as_map("region", F.col("n")).alias("orders_by_region"),
        )
        .select(
            *_bounds(),
            "first_event_ts",
            "last_event_ts",
            "gmv",
            "order_count",
            round2(F.col("gmv") / F.col("order_count")).alias("average_order_value"),
            "unique_users",
            "revenue_by_category",
            "orders_by_region",
            "first_time_orders",
        )
    )


def revenue_flat_rows(
    orders: DataFrame, width: timedelta = REVENUE_WINDOW, ingested_at: Column | None = None
) -> DataFrame:
    """The layout of the analytics table straight from static orders: one row per category and one per region beside
    the window's totals, without maps."""
    folded = _folded(orders, width)
    totals = folded.groupBy("window").agg(*_scalars())
    entries = folded.filter(F.col("kind").isin("category", "region")).select(
        F.col("window").alias("of_window"),
        _of("region", F.col("key")).alias("region"),
        _of("category", F.col("key")).alias("category"),
        _of("category", F.col("amount").cast("double")).alias("category_revenue"),
    )
    return totals.join(entries, F.col("window") == F.col("of_window"), "left").select(
        F.col("window.start").alias("window_start_timestamp"),
        F.col("window.end").alias("window_end_timestamp"),
        "gmv",
        "order_count",
        round2(F.col("gmv") / F.col("order_count")).alias("average_order_value"),
        "unique_users",
        "first_time_orders",
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingestion_timestamp"),
        "region",
        "category",
        "category_revenue",
    )


def revenue_flat(metrics: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Metrics rows in the layout of the analytics table: one row per category and one per region."""
    entry = "struct<region:string,category:string,category_revenue:double>"
    categories = F.transform(
        F.map_entries("revenue_by_category"),
        lambda e: F.struct(
            F.lit(None).cast("string").alias("region"),
            e["key"].alias("category"),
            e["value"].alias("category_revenue"),
        ).cast(entry),
    )
    regions = F.transform(
        F.map_keys("orders_by_region"),
        lambda key: F.struct(
            key.alias("region"),
            F.lit(None).cast("string").alias("category"),
            F.lit(None).cast("double").alias("category_revenue"),
        ).cast(entry),
    )
    return metrics.select(
        F.col("window_start").alias("window_start_timestamp"),
        F.col("window_end").alias("window_end_timestamp"),
        "gmv",
        "order_count",
        "average_order_value",
        "unique_users",
        "first_time_orders",
        F.explode_outer(F.concat(categories, regions)).alias("entry"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingestion_timestamp"),
    ).select("*", "entry.*").drop("entry")


def revenue_summary(orders: DataFrame, lines: DataFrame, as_of: str) -> DataFrame:
    """Sales of the as-of day and of the seven days that end with it.

    ``orders`` holds one row per order and ``lines`` one per item, with category and price; both
    carry ``event_time``.
    """
    end = F.lit(as_of).cast("date")
    day = F.col("event_time").cast("date")

    def spans(df: DataFrame) -> DataFrame:
        recent = df.filter((day > F.date_sub(end, 7)) & (day <= end))
        periods = F.when(day == end, F.array(F.lit("today"), F.lit("week"))).otherwise(F.array(F.lit("week")))
        return recent.withColumn("period", F.explode(periods))

    totals = (
        spans(sales(orders))
        .groupBy("period")
        .agg(money_sum(F.col("total_amount")).alias("gmv"), F.count("*").alias("order_count"))
    )
    best = (
        spans(sales(lines))
        .groupBy("period", "category")
        .agg(F.sum(exact(F.col("total_price"))).alias("revenue"))
        .groupBy("period")
        .agg(F.min_by("category", F.struct(-F.col("revenue"), F.col("category"))).alias("top_category"))
    )
    return totals.join(best, "period", "left").select(
        "period",
        "gmv",
        "order_count",
        round2(ratio(F.col("gmv"), F.col("order_count"))).alias("avg_order"),
        "top_category",
    )
