"""Adapters: a star schema with an event table (orders, lineitem, part, customer, nation, events)
read as the feeds of a shop: clicks, order events, daily order lines, product and order changes,
stock movements.

Every adapter is a projection or a chain of key joins. No join carries a broadcast hint: Spark
broadcasts a side when its measured size allows it and otherwise shuffles both sides and splits
skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rows import with_computed

# --- fixed values: codes of the source tables and what they stand for -------------------------
CLICK_TYPES = {
    "signup": "PAGE_VIEW",
    "view": "PRODUCT_VIEW",
    "click": "ADD_TO_CART",
    "purchase": "PURCHASE",
    "error": "ERROR",
}
ORDER_EVENT_STATUS = {"F": "CREATED", "O": "PAYMENT_COMPLETED", "P": "CANCELLED"}
BATCH_STATUS = {"F": "DELIVERED", "O": "SHIPPED", "P": "PROCESSING"}
STOCK_EVENT_TYPES = {
    "signup": "PRODUCT_ACTIVATED",
    "view": "STOCK_UPDATE",
    "click": "PRICE_CHANGE",
    "purchase": "STOCK_RESERVED",
    "error": "UNKNOWN",
}
MOVEMENT_OF_FLAG = {"R": "IN", "A": "OUT", "N": "ADJUSTMENT"}
DEVICES = ("mobile", "desktop", "tablet")
DAILY_COLUMNS = (
    "order_id", "customer_id", "order_date", "category", "subcategory", "amount", "quantity", "city", "status",
    "product_id",
)
# ----------------------------------------------------------------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _recode(col: Column, codes: dict[str, str]) -> Column:
    out = None
    for code, label in codes.items():
        out = F.when(col == code, label) if out is None else out.when(col == code, label)
    return out


def _epoch_ms(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _k() -> Column:
    """The number inside ``props``, for example 7 in ``{"k": 7}``."""
    return F.get_json_object("props", "$.k").cast("int")


def clicks(events: DataFrame) -> DataFrame:
    k = F.col("k")
    return events.withColumn("k", _k()).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("s"), "event_id").alias("session_id"),
        _recode(F.col("event_type"), CLICK_TYPES).alias("event_type"),
        F.concat(F.lit("P"), k).alias("product_id"),
        F.when(k % 10 != 9, F.concat(F.lit("cat_"), k % 5)).alias("category"),
        F.when(k % 11 != 10, F.col("value")).alias("price"),
        F.when(k % 4 != 0, k % 4).cast("int").alias("quantity"),
        _epoch_ms("ts").alias("timestamp"),
        F.element_at(F.array(*map(F.lit, DEVICES)), (F.col("event_id") % 3 + 1).cast("int"))
        .alias("device_type"),
        F.concat(F.lit("region_"), F.col("event_id") % 5).alias("geo_region"),
        F.concat(F.lit("/product/P"), k).alias("page_url"),
        F.lit(None).cast("string").alias("referrer"),
    )


def purchase_orders(events: DataFrame) -> DataFrame:
    """Purchases as order events with one item, at their real time of day."""
    k = F.col("k")
    category = F.when(k % 10 != 9, F.concat(F.lit("cat_"), k % 5))
    item = F.struct(
        F.concat(F.lit("P"), k).alias("product_id"),
        F.concat(F.lit("Product "), k).alias("product_name"),
        category.alias("category"),
        F.lit(1).alias("quantity"),
        F.col("value").alias("unit_price"),
        F.col("value").alias("total_price"),
    )
    return events.filter(F.col("event_type") == "purchase").withColumn("k", _k()).select(
        F.concat(F.lit("o"), "event_id").alias("order_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("s"), "event_id").alias("session_id"),
        F.lit("CREATED").alias("order_status"),
        F.array(item).alias("items"),
        F.col("value").alias("subtotal"),
        F.lit(0.0).alias("discount_amount"),
        F.lit(0.0).alias("shipping_cost"),
        F.col("value").alias("total_amount"),
        F.lit("TRY").alias("currency"),
        F.lit("credit_card").alias("payment_method"),
        F.when(k % 7 != 6, F.concat(F.lit("region_"), F.col("event_id") % 5))
        .alias("shipping_address_region"),
        _epoch_ms("ts").alias("timestamp"),
        F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("is_first_order"),
    )


def _regions(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left").select(
        "c_custkey", F.col("n_name").alias("region")
    )


def between_days(orders: DataFrame, first: Column, last: Column) -> DataFrame:
    """Orders from the first day to the last, as bounds of the raw date column that reach the scan."""
    after = last.cast("timestamp_ntz") + F.expr("interval 1 day")
    return orders.filter((F.col("o_orderdate") >= first.cast("timestamp_ntz")) & (F.col("o_orderdate") < after))


def placed_orders(orders: DataFrame) -> DataFrame:
    """Orders as order events without their items and region."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        _recode(F.col("o_orderstatus"), ORDER_EVENT_STATUS).alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        _epoch_ms("o_orderdate").alias("timestamp"),
    )


def with_region(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Order events with the region of their user, null where it is not known."""
    regions = _regions(customer, nation).select(
        F.col("c_custkey").cast("string").alias("user_id"), F.col("region").alias("shipping_address_region")
    )
    return orders.join(regions, "user_id", "left")


def order_lines(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Order lines with the category of their product, null where the product is not known."""
    return lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"], "left").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("total_price"),
    )


def daily_orders(
    spark: SparkSession,
    folder: str,
    day: str | None = None,
    statuses: tuple[str, ...] | None = None,
    columns: tuple[str, ...] = DAILY_COLUMNS,
) -> DataFrame:
    """Order lines of the daily job. Day and status become filters of the ``orders`` scan; tables that none of the
    ``columns`` needs are not read. A line keeps its place where product or customer is not known."""
    orders = table(spark, folder, "orders")
    if day is not None:
        orders = between_days(orders, F.lit(day), F.lit(day))
    if statuses is not None:
        codes = [code for code, label in BATCH_STATUS.items() if label in statuses]
        orders = orders.filter(F.col("o_orderstatus").isin(codes))
    lineitem = table(spark, folder, "lineitem")
    rows = lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])
    made = {
        "order_id": F.col("o_orderkey").cast("string"),
        "customer_id": F.col("o_custkey").cast("string"),
        "order_date": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "amount": F.col("l_extendedprice"),
        "quantity": F.col("l_quantity").cast("int"),
        "status": _recode(F.col("o_orderstatus"), BATCH_STATUS),
        "product_id": F.col("l_partkey").cast("string"),
    }
    if {"category", "subcategory"} & set(columns):
        part = table(spark, folder, "part")
        rows = rows.join(part, F.col("l_partkey") == part["p_partkey"], "left")
        made |= {"category": F.col("p_type"), "subcategory": F.col("p_brand")}
    if "city" in columns:
        regions = _regions(table(spark, folder, "customer"), table(spark, folder, "nation"))
        rows = rows.join(regions, F.col("o_custkey") == F.col("c_custkey"), "left")
        made["city"] = F.col("region")
    return rows.select(*[made[c].alias(c) for c in columns])


def order_messages(orders: DataFrame) -> DataFrame:
    """Orders as topic messages with one to three items. The priority of an order decides how its message is broken,
    and else the last digit of its key how odd it is: a time with an exponent, quantities with a fraction (both can
    be read), a flag that is none, an id that is an object (neither can)."""
    key, odd = F.col("o_orderkey"), F.col("o_orderkey") % 10
    quantity = F.when(odd == 2, F.lit("5.7"))
    items = F.array_join(F.transform(F.sequence(F.lit(1), (key % 3 + 1).cast("int")), lambda i: F.concat(
        F.lit('{"product_id":"P'), i, F.lit('","category":"c'), i, F.lit('","quantity":'),
        F.coalesce(quantity, i.cast("string")), F.lit(',"total_price":'), i, F.lit(".5}"),
    )), ",")
    ms = _epoch_ms("o_orderdate")
    order_id = F.when(odd == 4, F.lit('{"x":1}')).otherwise(F.concat(F.lit('"'), key, F.lit('"')))
    user = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.concat(F.lit('"user_id":"'), "o_custkey", F.lit('",')))
    amount = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("n/a")).otherwise(
        F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    whole = F.concat(
        F.lit('{"order_id":'), order_id, F.lit(","), F.coalesce(user, F.lit("")), F.lit('"order_status":"'),
        _recode(F.col("o_orderstatus"), ORDER_EVENT_STATUS), F.lit('","total_amount":"'), amount,
        F.lit('","timestamp":'), F.when(odd == 1, F.concat(F.floor(ms / 1000), F.lit("E3"))).otherwise(ms.cast("string")),
        F.lit(',"items":['), items, F.lit('],"is_first_order":'),
        F.when(odd == 3, F.lit('"yes"')).otherwise(F.lit("true")), F.lit(',"channel":"web"}'),
    )
    cut_off = F.concat(F.lit('{"order_id":"'), "o_orderkey", F.lit('","user_id"'))
    message = F.when(F.col("o_orderpriority") == "5-LOW", cut_off).otherwise(whole)
    return with_computed(orders, "value", message).select("value")


def product_changes(part: DataFrame) -> DataFrame:
    """Change envelopes of products: a snapshot, a price rise, then by size a delete (followed by a
    tombstone), an update at the same price, or a price cut. Of the largest size one more message is cut off."""
    raised = (F.col("p_retailprice") + F.col("p_size")).cast("decimal(10,2)")
    version = F.posexplode(F.array(
        F.struct(F.lit("r").alias("op"), F.col("p_retailprice").cast("decimal(10,2)").alias("price")),
        F.struct(F.lit("u").alias("op"), raised.alias("price")),
        F.struct(
            F.when(F.col("p_size") <= 10, "d").otherwise("u").alias("op"),
            F.when(F.col("p_size") <= 25, raised).otherwise((raised - 5).cast("decimal(10,2)"))
            .alias("price"),
        ),
        F.when(F.col("p_size") <= 10, F.struct(
            F.lit("tombstone").alias("op"), F.lit(None).cast("decimal(10,2)").alias("price")
        )).when(F.col("p_size") == 50, F.struct(
            F.lit("broken").alias("op"), F.lit(None).cast("decimal(10,2)").alias("price")
        )),
    )).alias("step", "v")
    rows = part.select("p_partkey", "p_name", "p_brand", "p_size", version).filter("v is not null")
    image = F.struct(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.col("p_brand"), F.lit("-"), F.col("p_partkey")).alias("sku"),
        F.col("p_name").alias("name"),
        F.col("v.price").alias("price"),
    )
    envelope = F.to_json(F.struct(
        F.when(F.col("v.op").isin("u", "d"), image).alias("before"),
        F.when(F.col("v.op") != "d", image).alias("after"),
        F.col("v.op").alias("op"),
        F.struct(
            F.lit("products").alias("table"),
            (F.lit(1_700_000_000_000) + F.col("step") * 60_000 + F.col("p_partkey")).alias("ts_ms"),
        ).alias("source"),
    ))
    cut_off = F.concat(F.lit('{"before":{"product_id":'), "p_partkey")
    message = F.when(F.col("v.op") == "broken", cut_off).when(F.col("v.op") != "tombstone", envelope)
    return with_computed(rows, "value", message).select(F.col("p_partkey").alias("key"), "value")


def order_changes(orders: DataFrame) -> DataFrame:
    """Flat change rows of orders as messages. Low-priority ones are cut off, others lack fields."""
    op = F.when(F.col("o_orderstatus") == "F", "c").when(F.col("o_orderstatus") == "O", "u")
    whole = F.to_json(F.struct(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit("ORD-"), "o_orderkey").alias("order_number"),
        _recode(F.col("o_orderstatus"), ORDER_EVENT_STATUS).alias("order_status"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED",
               F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("total_amount"),
        F.concat(F.lit("city_"), F.col("o_custkey") % 25).alias("shipping_city"),
        op.alias("__op"),
    ))
    cut_off = F.concat(F.lit('{"order_id":'), "o_orderkey")
    message = F.when(F.col("o_orderpriority") == "5-LOW", cut_off).otherwise(whole)
    return with_computed(orders, "value", message).select("value")


def stock_movements(lineitem: DataFrame) -> DataFrame:
    """Order lines as stock movements. Rows with all sort columns equal are interchangeable."""
    return lineitem.select(
        F.col("l_partkey").alias("product_id"),
        _recode(F.col("l_returnflag"), MOVEMENT_OF_FLAG).alias("movement_type"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        _epoch_ms("l_shipdate").alias("timestamp"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
    )


def movement_messages(lineitem: DataFrame) -> DataFrame:
    """The same movements as messages of the ``inventory_movements`` schema; the reason names the order line."""
    moves = stock_movements(lineitem)
    line = F.concat_ws("|", "l_orderkey", "l_linenumber", "l_suppkey")
    fields = F.struct(
        F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit((1 << 31) - 1)).alias("movement_id"), "product_id",
        "movement_type", "quantity", line.alias("reason"), F.timestamp_millis("timestamp").alias("created_at"))
    return moves.select(F.to_json(fields).alias("value"))


def movements_of_messages(rows: DataFrame) -> DataFrame:
    """Parsed ``inventory_movements`` rows with the order line that the reason names."""
    line = F.split("reason", r"\|")
    return rows.select(
        F.col("product_id").cast("bigint").alias("product_id"), "movement_type",
        F.col("quantity").cast("bigint").alias("quantity"), F.unix_millis("created_at").alias("timestamp"),
        line[0].cast("bigint").alias("l_orderkey"), line[1].cast("int").alias("l_linenumber"),
        line[2].cast("int").alias("l_suppkey"))


def stock_events(events: DataFrame) -> DataFrame:
    k = F.col("k")
    stock = F.col("event_type").isin("view", "purchase")
    return events.withColumn("k", _k()).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("P"), k).alias("product_id"),
        _recode(F.col("event_type"), STOCK_EVENT_TYPES).alias("event_type"),
        F.lit(None).cast("int").alias("previous_stock"),
        F.when(stock, F.floor("value")).cast("int").alias("new_stock"),
        F.lit(None).cast("double").alias("previous_price"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("new_price"),
        F.concat(F.lit("WH-"), F.col("user_id") % 5).alias("warehouse_id"),
        _epoch_ms("ts").alias("timestamp"),
    )


def order_event_parts(orders: DataFrame, lines: DataFrame, most: int = 500) -> DataFrame:
    """Order events with their items nested, as order messages hold them: an order of more lines than ``most`` comes in
    several events, so no event and no group is larger. ``part`` counts from 0; one without items is a single event."""
    item = F.struct(
        F.col("line_number").alias("line"), "product_id", "product_name", "category",
        F.col("quantity").cast("int").alias("quantity"), F.col("total_price").cast("double").alias("total_price"))
    part = F.floor((F.col("line_number") - 1) / most).cast("int").alias("part")
    nested = lines.select("order_id", part, item.alias("item")).groupBy("order_id", "part").agg(
        F.array_sort(F.collect_list("item")).alias("items"))
    items = F.transform("items", lambda x: x.dropFields("line"))
    none = F.array().cast("array<struct<product_id:string,product_name:string,category:string,quantity:int,total_price:double>>")
    return orders.join(nested, "order_id", "left").withColumns(
        {"part": F.coalesce("part", F.lit(0)), "items": F.coalesce(items, none)})


def order_item_messages(lineitem: DataFrame) -> DataFrame:
    """Order lines as messages of the ``order_items`` schema. The seventh line of an order comes without a quantity, the
    sixth with one that is no number."""
    line, quantity = F.col("l_linenumber"), F.col("l_quantity").cast("int").cast("string")
    told = F.when(line == 6, "many").when(line < 6, quantity)
    unit = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")) / 100
    fields = F.struct(
        F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit((1 << 31) - 1)).alias("item_id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), told.alias("quantity"),
        unit.alias("unit_price"), F.col("l_extendedprice").alias("total_price"))
    return lineitem.select(F.to_json(fields).alias("value"))


def order_events(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Order events with one ``item`` per row, so an order of any size fits; one without items has a null item."""
    item = F.struct("line_number", "product_id", "product_name", "category", "quantity", "total_price")
    return orders.join(lines.select("order_id", item.alias("item")), "order_id", "left")
