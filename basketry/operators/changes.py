"""Change rows: feeds, current state, price history, stock levels."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import ratio, round2
from ..functions.times import slice_of
from ..sources.messages import op_label


def price_feed(products: DataFrame) -> DataFrame:
    """Updates of products as small JSON messages."""
    return products.filter(F.col("operation") == "u").select(
        F.to_json(F.struct(F.lit("price_change").alias("type"), "sku", "price")).alias("value")
    )


def order_feed(orders: DataFrame) -> DataFrame:
    """Changes of orders as small JSON messages, with what kind of change it was."""
    return orders.filter(F.col("order_id") > 0).select(
        op_label(F.col("operation")).alias("change"),
        F.to_json(F.struct(
            F.lit("order_change").alias("type"),
            F.col("order_number").alias("order"),
            F.col("order_status").alias("status"),
        )).alias("value"),
    )


def latest_versions(changes: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Last version per key, deleted ones included.

    A keyed aggregation with partial results on the map side, so a key with very many versions
    sends one row per task.
    """
    values = [c for c in changes.columns if c not in key]
    last = F.max_by(F.struct(*values), F.struct(*order)).alias("last")
    return changes.groupBy(*key).agg(last).select(*key, "last.*")


def current_state(changes: DataFrame, key: list[str], order: list[str], deleted: str = "__deleted") -> DataFrame:
    """The table that a log of change rows adds up to: last version per key, deletes removed."""
    return latest_versions(changes, key, order).filter(~F.col(deleted))


def with_snapshot(snapshot: DataFrame, changes: DataFrame, ts_ms: int = 0) -> DataFrame:
    """Change log that starts with a snapshot of the table, as rows of operation ``r``."""
    rows = (
        snapshot.withColumn("__op", F.lit("r"))
        .withColumn("__table", F.lit(None).cast("string"))
        .withColumn("__source_ts_ms", F.lit(ts_ms).cast("bigint"))
        .withColumn("__deleted", F.lit(False))
    )
    return rows.select(*changes.columns).unionByName(changes)


def price_changes(
    changes: DataFrame,
    key: str = "product_id",
    ts: str = "__source_ts_ms",
    price: str = "price",
    slice_width: timedelta = timedelta(hours=1),
) -> DataFrame:
    """Consecutive versions of a product whose price differs.

    The previous price of the first version in a slice comes from a window over one row per
    (product, slice), so no window holds more than one slice of a product's versions.
    """
    versions = changes.filter(~F.col("__deleted")).select(
        F.col(key), F.col(ts), F.col(price).cast("double").alias("price")
    ).withColumn("slice", slice_of(F.col(ts), slice_width))
    of_key = Window.partitionBy(key).orderBy("slice")
    carried = (
        versions.groupBy(key, "slice")
        .agg(F.max(F.struct(ts, "price")).alias("last"))
        .select(key, "slice", F.lag("last").over(of_key).getField("price").alias("carried"))
    )
    in_slice = Window.partitionBy(key, "slice").orderBy(ts, "price")
    first_of_slice = F.row_number().over(in_slice) == 1
    return (
        versions.join(carried, [key, "slice"])
        .withColumn(
            "previous_price",
            F.when(first_of_slice, F.col("carried")).otherwise(F.lag("price").over(in_slice)),
        )
        .filter(F.col("previous_price") != F.col("price"))
        .select(
            key,
            F.col(ts).alias("changed_ms"),
            "previous_price",
            F.col("price").alias("new_price"),
            round2(F.col("price") - F.col("previous_price")).alias("delta"),
            round2(ratio(F.col("price") - F.col("previous_price"), F.col("previous_price")) * 100)
            .alias("delta_percent"),
        )
    )


def signed_quantity() -> Column:
    """IN adds, OUT takes away, ADJUSTMENT carries its own sign; anything else changes nothing."""
    kind, quantity = F.col("movement_type"), F.coalesce("quantity", F.lit(0))
    return F.when(kind.isin("IN", "ADJUSTMENT"), quantity).when(kind == "OUT", -quantity).otherwise(0)


def running_stock(
    movements: DataFrame, order: list[str], slice_width: timedelta = timedelta(days=1)
) -> DataFrame:
    """Stock level after each movement of a product.

    The level at the start of a slice is a running sum over one row per (product, slice); inside a
    slice it runs over the movements. A product with a third of all movements thus spreads over as
    many groups as it has slices.
    """
    moves = movements.withColumn("delta", signed_quantity()).withColumn(
        "slice", slice_of(F.col("timestamp"), slice_width)
    )
    before = Window.partitionBy("product_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    opening = (
        moves.groupBy("product_id", "slice")
        .agg(F.sum("delta").alias("slice_delta"))
        .select(
            F.col("product_id").alias("of_product"),
            F.col("slice").alias("of_slice"),
            F.coalesce(F.sum("slice_delta").over(before), F.lit(0)).alias("opening"),
        )
    )
    same = F.col("product_id").eqNullSafe(F.col("of_product")) & (F.col("slice") == F.col("of_slice"))
    so_far = (
        Window.partitionBy("product_id", "slice").orderBy("timestamp", *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        moves.join(opening, same)
        .withColumn("stock", F.col("opening") + F.sum("delta").over(so_far))
        .drop("slice", "of_product", "of_slice", "opening")
    )


def running_stock_from(
    levels: DataFrame, movements: DataFrame, order: list[str], slice_width: timedelta = timedelta(days=1),
    busy: list[int | None] | None = None,
) -> DataFrame:
    """``running_stock`` of movements that go on from ``levels`` (product_id, stock), which lie before all of them. The
    level of a product takes part as one more movement, so no row of a busy product has to meet it in a join.

    With ``busy`` only these products spread over slices. The movements of any other fit in one group and are shuffled
    and sorted once; so ``busy`` has to name each product with more movements than a task should sort.
    """
    known = {"product_id": F.col("product_id"), "movement_type": F.lit("ADJUSTMENT"), "quantity": F.col("stock"),
             "timestamp": F.lit(-1 << 62)}
    opening = levels.select(*[
        known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in movements.schema.fields])
    rows = opening.withColumn("carried", F.lit(True)).unionByName(movements.withColumn("carried", F.lit(False)))
    if busy is None:
        out = running_stock(rows, order, slice_width)
    else:
        sliced = F.coalesce(F.col("product_id").isin([p for p in busy if p is not None]), F.lit(None in busy))
        out = _whole_stock(rows.filter(~sliced), order)
        if busy:
            out = out.unionByName(running_stock(rows.filter(sliced), order, slice_width))
    return out.filter(~F.col("carried")).drop("carried")


def _whole_stock(movements: DataFrame, order: list[str]) -> DataFrame:
    """``running_stock`` in one group per product. Movements without a time have no place in either."""
    so_far = (
        Window.partitionBy("product_id").orderBy("timestamp", *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    moves = movements.filter(F.col("timestamp").isNotNull()).withColumn("delta", signed_quantity())
    return moves.withColumn("stock", F.sum("delta").over(so_far))


def stock_levels(movements: DataFrame) -> DataFrame:
    """Stock of each product after all its movements, and how many there were; for static and streaming input."""
    return movements.groupBy("product_id").agg(
        F.sum(signed_quantity()).alias("stock"), F.count(F.lit(1)).alias("movements")
    )


def latest_inventory(events: DataFrame, counted: bool = False) -> DataFrame:
    """Last known stock and price of each product; events without a value do not clear it. ``counted`` adds how many
    events there were, which orders the versions of a product in a stream."""

    def last_known(column: str) -> Column:
        at = F.when(F.col(column).isNotNull(), F.struct("timestamp", "event_id"))
        return F.max_by(column, at).alias(column.replace("new_", ""))

    return events.groupBy("product_id").agg(
        last_known("new_stock"),
        last_known("new_price"),
        F.max("timestamp").alias("updated_ms"),
        *([F.count(F.lit(1)).alias("events")] if counted else []),
    )
