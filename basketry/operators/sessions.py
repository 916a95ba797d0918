"""User sessions: events of one user with no pause longer than the gap."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import exact
from ..functions.times import millis, slice_of

SESSION_GAP = timedelta(minutes=30)


def usable(clicks: DataFrame) -> DataFrame:
    """Events that can belong to a session."""
    return clicks.filter(complete())


def unusable(clicks: DataFrame) -> DataFrame:
    """The rest, for the reject table."""
    return clicks.filter(~complete())


def complete() -> Column:
    return F.col("user_id").isNotNull() & F.col("event_type").isNotNull() & F.col("timestamp").isNotNull()


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


# Per-event measures; both forms below sum them.
def _measures() -> list[Column]:
    spent = F.when(
        _is("PURCHASE") & F.col("price").isNotNull(),
        exact(F.col("price")) * F.coalesce("quantity", F.lit(1)),
    )
    return [
        F.count_if(_is("PAGE_VIEW")).alias("page_views"),
        F.count_if(_is("PRODUCT_VIEW")).alias("product_views"),
        F.count_if(_is("ADD_TO_CART")).alias("add_to_cart_count"),
        F.count_if(_is("PURCHASE")).alias("purchase_count"),
        F.sum(spent).cast("decimal(38,10)").alias("revenue"),
        F.max("timestamp").alias("last_ms"),
        F.min(F.struct("timestamp", "event_id", "session_id", "device_type", "geo_region"))
        .alias("opening"),
    ]


def _result() -> list[Column]:
    first_ms = F.col("opening.timestamp")
    views, purchases = F.col("product_views"), F.col("purchase_count")
    return [
        F.col("user_id"),
        F.col("opening.session_id").alias("session_id"),
        F.timestamp_millis(first_ms).alias("session_start"),
        F.timestamp_millis("last_ms").alias("session_end"),
        F.floor((F.col("last_ms") - first_ms) / 1000).alias("duration_seconds"),
        F.col("page_views"),
        views,
        F.col("add_to_cart_count"),
        purchases,
        F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
        F.col("opening.device_type").alias("device_type"),
        F.col("opening.geo_region").alias("geo_region"),
        F.col("primary_category"),
        F.when(views > 0, purchases / views).otherwise(0.0).alias("conversion_rate"),
    ]


_SUMS = ("page_views", "product_views", "add_to_cart_count", "purchase_count", "revenue")


def _combine() -> list[Column]:
    return [F.sum(c).alias(c) for c in _SUMS] + [
        F.max("last_ms").alias("last_ms"),
        F.min("opening").alias("opening"),
    ]


def session_metrics(clicks: DataFrame, gap: timedelta = SESSION_GAP) -> DataFrame:
    """Session table of a static DataFrame.

    Events inside one time slice no longer than the gap always share a session. So events first
    fold into (user, slice, viewed category) rows, with partial sums on the map side, and sessions
    are found among those rows. However many events one user has, the window over that user sees
    at most one row per slice and category.
    """
    viewed = F.when(_is("PRODUCT_VIEW"), F.col("category"))
    slices = (
        usable(clicks)
        .withColumn("slice", slice_of(F.col("timestamp"), gap))
        .withColumn("viewed", viewed)
        .groupBy("user_id", "slice", "viewed")
        .agg(*_measures())
    )
    of_user = Window.partitionBy("user_id").orderBy("slice")
    pause = F.col("slice_first") - F.col("previous_last")
    opens = F.col("previous_last").isNull() | (pause > millis(gap))
    marked = (
        slices.withColumn(
            "previous_last",
            F.max("last_ms").over(of_user.rangeBetween(Window.unboundedPreceding, -1)),
        )
        .withColumn("slice_first", F.min("opening.timestamp").over(Window.partitionBy("user_id", "slice")))
        .withColumn(
            "session_ms",
            F.max(F.when(opens, F.col("slice_first")))
            .over(of_user.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
        )
    )
    # Most viewed category, the lowest name among equals.
    order = F.when(F.col("viewed").isNotNull(), F.struct(-F.col("product_views"), F.col("viewed")))
    return (
        marked.groupBy("user_id", "session_ms", "viewed")
        .agg(*_combine())
        .groupBy("user_id", "session_ms")
        .agg(*_combine(), F.min_by("viewed", order).alias("primary_category"))
        .select(*_result())
    )


def session_metrics_streaming(clicks: DataFrame, gap: timedelta = SESSION_GAP) -> DataFrame:
    """The same table from a stream with a watermark on ``event_time``: one row per closed session."""
    viewed = F.when(_is("PRODUCT_VIEW"), F.col("category"))
    return (
        usable(clicks)
        .groupBy("user_id", F.session_window("event_time", f"{millis(gap)} milliseconds"))
        .agg(*_measures(), F.mode(viewed, True).alias("primary_category"))
        .select(*_result())
    )
