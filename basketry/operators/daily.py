"""Reports of the daily job over order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import money_sum, ratio

# Fixed value: the status of orders that count in the reports.
DELIVERED = "DELIVERED"


def daily_revenue(lines: DataFrame, ordered: bool = True) -> DataFrame:
    out = (
        lines.filter(F.col("status") == DELIVERED)
        .groupBy("order_date", "category")
        .agg(
            money_sum(F.col("amount")).alias("gmv"),
            F.count("order_id").alias("order_count"),
            F.sum("quantity").alias("units_sold"),
            ratio(money_sum(F.col("amount")), F.count("amount")).alias("aov"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
        .withColumn("revenue_per_customer", ratio(F.col("gmv"), F.col("unique_customers")))
    )
    return out.orderBy(F.desc("gmv")) if ordered else out


def top_cities(lines: DataFrame, top_n: int = 10) -> DataFrame:
    best_first = Window.partitionBy("order_date").orderBy(F.desc("gmv"), "city")
    return (
        lines.filter(F.col("status") == DELIVERED)
        .groupBy("order_date", "city")
        .agg(money_sum(F.col("amount")).alias("gmv"), F.count("order_id").alias("order_count"))
        .withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= top_n)
    )


def order_funnel(lines: DataFrame, ordered: bool = True) -> DataFrame:
    # The share needs the total over the few status rows, not a second pass over the lines.
    rows = F.sum("n").over(Window.partitionBy())
    out = (
        lines.groupBy("status")
        .agg(
            F.count("order_id").alias("count"),
            money_sum(F.col("amount")).alias("gmv"),
            F.count("*").alias("n"),
        )
        .withColumn("percentage", (F.col("count") / rows * 100).cast("decimal(5,2)"))
        .drop("n")
    )
    return out.orderBy(F.desc("count")) if ordered else out


def daily_summary(lines: DataFrame) -> DataFrame:
    delivered = F.when(F.col("status") == DELIVERED, F.col("amount"))
    return lines.agg(money_sum(delivered).alias("total_gmv"), F.count("*").alias("orders_processed"))


def top_products(lines: DataFrame, top_n: int = 10) -> DataFrame:
    """Best products of each day by delivered revenue."""
    best_first = Window.partitionBy("order_date").orderBy(F.desc("revenue"), "product_id")
    return (
        lines.filter(F.col("status") == DELIVERED)
        .groupBy("order_date", "product_id")
        .agg(money_sum(F.col("amount")).alias("revenue"), F.sum("quantity").alias("units_sold"))
        .withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= top_n)
    )


def customer_cohorts(orders: DataFrame) -> DataFrame:
    """Customers by month of first order and months since; ``orders`` has customer_id, order_date.

    Orders first fold to one row per customer and month, so the window over a customer sees months
    and not orders.
    """
    month_no = F.year("day") * 12 + F.month("day")
    active = (
        orders.select("customer_id", F.to_date("order_date").alias("day"))
        .select("customer_id", month_no.alias("month_no"))
        .distinct()
    )
    first = F.min("month_no").over(Window.partitionBy("customer_id"))
    start = F.col("first_month") - 1
    return (
        active.withColumn("first_month", first)
        .groupBy("first_month", (F.col("month_no") - F.col("first_month")).alias("months_since"))
        .agg(F.count("*").alias("customers"))
        .select(
            F.format_string("%04d-%02d", F.floor(start / 12).cast("int"), (start % 12 + 1).cast("int"))
            .alias("cohort_month"),
            F.col("months_since").cast("bigint").alias("months_since"),
            "customers",
        )
    )
