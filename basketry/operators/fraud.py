"""Fraud rules over order events."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.alerts import (
    SCORE_HIGH_VALUE_FIRST_ORDER,
    SCORE_LOCATION_ANOMALY,
    SCORE_RAPID_ORDERS,
    alert_rows,
)
from ..functions.times import millis, slice_of

# --- fixed values -----------------------------------------------------------------------------
RAPID_WITHIN = timedelta(minutes=5)
SLICE_FACTOR = 6
HIGH_VALUE_THRESHOLD = 5000.0
TEXT_RAPID = "User placed 3 orders within %d minutes. First: %s, Last: %s"
TEXT_HIGH_VALUE = "First order from user is high value: %.2f TRY (threshold: %.2f)"
TEXT_LOCATION = "Order from new city for existing user"
# ----------------------------------------------------------------------------------------------


def slice_width(within: timedelta) -> timedelta:
    return within * SLICE_FACTOR


def is_created(min_amount: float | None = None) -> Column:
    created = (F.col("order_status") == "CREATED") & F.col("user_id").isNotNull()
    return created if min_amount is None else created & (F.col("total_amount") > min_amount)


def time_slices(created: DataFrame, within: timedelta = RAPID_WITHIN) -> DataFrame:
    """New orders by (user, time slice). Each order appears in its own slice; one that comes less
    than ``within`` after the start of its slice also appears in the slice before, to be looked
    ahead to. So every rule hit is complete inside the slice of its first order, few rows are
    doubled, and a user with very many orders spreads over as many groups as slices."""
    width = slice_width(within)
    own, ms = F.col("own_slice"), F.col("timestamp")
    early = ms < own * millis(width) + millis(within)
    slices = F.when(early, F.array(own, own - 1)).otherwise(F.array(own))
    return created.withColumn("own_slice", slice_of(ms, width)).withColumn("slice", F.explode(slices))


def rapid_orders(
    orders: DataFrame,
    within: timedelta = RAPID_WITHIN,
    min_amount: float | None = None,
    detected_at: Column | None = None,
) -> DataFrame:
    """One alert per order that is followed by two more of the same user in less than ``within``."""
    in_slice = Window.partitionBy("user_id", "slice").orderBy("timestamp", "order_id")
    hits = (
        time_slices(orders.filter(is_created(min_amount)), within)
        .select("user_id", "slice", "own_slice", "timestamp", "order_id")
        .withColumn("second", F.lead("order_id", 1).over(in_slice))
        .withColumn("third", F.lead(F.struct("timestamp", "order_id"), 2).over(in_slice))
        .filter(F.col("own_slice") == F.col("slice"))
        .filter(F.col("third.timestamp") - F.col("timestamp") < millis(within))
        .select(
            "user_id",
            F.col("order_id").alias("first"),
            "second",
            F.col("third.order_id").alias("order_id"),
            F.timestamp_millis("third.timestamp").alias("event_time"),
        )
    )
    return rapid_alerts(hits, within, detected_at)


def rapid_alerts(
    hits: DataFrame, within: timedelta = RAPID_WITHIN, detected_at: Column | None = None
) -> DataFrame:
    return alert_rows(
        hits,
        "RAPID_ORDERS",
        SCORE_RAPID_ORDERS,
        F.format_string(TEXT_RAPID, F.lit(within // timedelta(minutes=1)), "first", "order_id"),
        F.array("first", "second", "order_id"),
        detected_at,
    )


def high_value_first_order(
    orders: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD, detected_at: Column | None = None
) -> DataFrame:
    """Users whose first order, of any status, is above the threshold."""
    firsts = (
        orders.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.min(F.struct("timestamp", "order_id", "total_amount")).alias("o"))
        .filter(F.col("o.total_amount") > threshold)
        .select("user_id", "o.order_id", "o.total_amount", F.timestamp_millis("o.timestamp").alias("event_time"))
    )
    return high_value_alerts(firsts, threshold, detected_at)


def high_value_alerts(
    hits: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD, detected_at: Column | None = None
) -> DataFrame:
    return alert_rows(
        hits,
        "HIGH_VALUE_FIRST_ORDER",
        SCORE_HIGH_VALUE_FIRST_ORDER,
        F.format_string(TEXT_HIGH_VALUE, F.col("total_amount"), F.lit(threshold)),
        F.array("order_id"),
        detected_at,
    )


def location_anomaly(orders: DataFrame, detected_at: Column | None = None) -> DataFrame:
    """First order of a known user from a region that user has not ordered from before."""
    first_by_region = (
        orders.filter(F.col("user_id").isNotNull() & F.col("shipping_address_region").isNotNull())
        .groupBy("user_id", "shipping_address_region")
        .agg(F.min(F.struct("timestamp", "order_id")).alias("o"))
    )
    # One row per region is left of each user.
    of_user = Window.partitionBy("user_id")
    hits = (
        first_by_region.withColumn("earliest", F.min("o").over(of_user))
        .filter(F.col("o") > F.col("earliest"))
        .select("user_id", "o.order_id", F.timestamp_millis("o.timestamp").alias("event_time"))
    )
    return alert_rows(
        hits, "LOCATION_ANOMALY", SCORE_LOCATION_ANOMALY, F.lit(TEXT_LOCATION), F.array("order_id"), detected_at
    )


def fraud_alerts(
    orders: DataFrame,
    within: timedelta = RAPID_WITHIN,
    threshold: float = HIGH_VALUE_THRESHOLD,
    detected_at: Column | None = None,
) -> DataFrame:
    return rapid_orders(orders, within, detected_at=detected_at).unionByName(
        high_value_first_order(orders, threshold, detected_at)
    )


def with_first_order_flag(orders: DataFrame) -> DataFrame:
    """Add ``is_first_order``: the order is its user's earliest."""
    firsts = (
        orders.groupBy("user_id")
        .agg(F.min(F.struct("timestamp", "order_id")).alias("o"))
        .select(F.col("o.order_id").alias("order_id"), F.lit(True).alias("is_first"))
    )
    return (
        orders.drop("is_first_order")
        .join(firsts, "order_id", "left")
        .withColumn("is_first_order", F.coalesce("is_first", F.lit(False)))
        .drop("is_first")
    )
