"""Event and table schemas, their allowed values, and lookup by name."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------------
CLICK_EVENT_TYPES = (
    "PAGE_VIEW",
    "PRODUCT_VIEW",
    "ADD_TO_CART",
    "REMOVE_FROM_CART",
    "CHECKOUT_START",
    "PURCHASE",
)
ORDER_STATUSES = (
    "CREATED",
    "PAYMENT_PENDING",
    "PAYMENT_COMPLETED",
    "CONFIRMED",
    "SHIPPED",
    "DELIVERED",
    "CANCELLED",
    "REFUNDED",
)
INVENTORY_EVENT_TYPES = (
    "STOCK_UPDATE",
    "STOCK_RESERVED",
    "STOCK_RELEASED",
    "PRICE_CHANGE",
    "PRODUCT_ACTIVATED",
    "PRODUCT_DEACTIVATED",
)
ALERT_TYPES = (
    "RAPID_ORDERS",
    "LOCATION_ANOMALY",
    "HIGH_VALUE_FIRST_ORDER",
    "SUSPICIOUS_PATTERN",
)
REVENUE_STATUSES = ("CREATED", "PAYMENT_COMPLETED")
MOVEMENT_TYPES = ("IN", "OUT", "ADJUSTMENT")

TOPIC_CLICKS = "clickstream.events"
TOPIC_ORDERS = "transactions.orders"
TOPIC_INVENTORY = "inventory.updates"
TOPIC_CDC_PRODUCTS = "cdc.public.products"
TOPIC_CDC_ORDERS = "cdc.public.orders"
TOPIC_CDC_ORDER_ITEMS = "cdc.public.order_items"
TOPIC_CDC_MOVEMENTS = "cdc.public.inventory_movements"
TOPIC_SESSIONS = "analytics.sessions"
TOPIC_REVENUE = "analytics.revenue"
TOPIC_ALERTS = "alerts.fraud"
TOPIC_DLQ = "dlq.fraud-detector"
# ----------------------------------------------------------------------------------------------


MONEY = "decimal(10,2)"

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    MONEY: T.DecimalType(10, 2),
}


def _struct(columns: str) -> T.StructType:
    """Schema from ``name type [not null], ...``; unlike DDL parsing this needs no running session."""
    fields = []
    for column in columns.split(", "):
        name, kind, *rest = column.split(" ")
        fields.append(T.StructField(name, _TYPES[kind], nullable=not rest))
    return T.StructType(fields)

CLICKSTREAM = _struct(
    "event_id string not null, user_id string not null, session_id string not null, "
    "event_type string not null, product_id string, category string, price double, quantity int, "
    "timestamp bigint not null, device_type string not null, geo_region string not null, "
    "page_url string, referrer string"
)
ORDER_ITEM = _struct(
    "product_id string not null, product_name string not null, category string not null, "
    "quantity int not null, unit_price double not null, total_price double not null"
)
ORDER = T.StructType(
    _struct("order_id string not null, user_id string not null, session_id string not null, "
            "order_status string not null").fields
    + [T.StructField("items", T.ArrayType(ORDER_ITEM), False)]
    + _struct("subtotal double not null, discount_amount double not null, "
              "shipping_cost double not null, total_amount double not null, "
              "currency string not null, payment_method string not null, "
              "shipping_address_region string not null, timestamp bigint not null, "
              "is_first_order boolean not null").fields
)
INVENTORY = _struct(
    "event_id string not null, product_id string not null, event_type string not null, "
    "previous_stock int, new_stock int, previous_price double, new_price double, "
    "warehouse_id string not null, timestamp bigint not null"
)
FRAUD_ALERT = _struct(
    "alert_id string not null, user_id string not null, order_id string, "
    "alert_type string not null, risk_score double not null, description string not null, "
    "detected_at timestamp not null, related_events array<string> not null"
)
SESSION = _struct(
    "user_id string, session_id string, session_start timestamp, session_end timestamp, "
    "duration_seconds bigint, page_views bigint, product_views bigint, add_to_cart_count bigint, "
    "purchase_count bigint, total_revenue double, device_type string, geo_region string, "
    "primary_category string, conversion_rate double"
)
CDC_PRODUCT = _struct("product_id int, sku string, name string, price double, operation string")
CDC_ORDER = _struct(
    "order_id int, order_number string, order_status string, total_amount double, "
    "shipping_city string, operation string"
)
BATCH_ORDER = _struct(
    "order_id string, customer_id string, order_date string, category string, subcategory string, "
    "amount double, quantity int, city string, status string"
)

PRODUCTS = _struct(
    "product_id int not null, sku string not null, name string not null, category string not null, "
    f"subcategory string, brand string, price {MONEY} not null, original_price {MONEY}, "
    "stock_quantity int, is_active boolean, seller_id string, created_at timestamp, "
    "updated_at timestamp"
)
CUSTOMERS = _struct(
    "customer_id int not null, email string not null, first_name string, last_name string, "
    "phone string, city string, district string, registration_date timestamp, is_premium boolean, "
    "total_orders int"
)
ORDERS = _struct(
    "order_id int not null, order_number string not null, customer_id int, "
    f"order_status string not null, total_amount {MONEY} not null, discount_amount {MONEY}, "
    f"shipping_amount {MONEY}, payment_method string, shipping_city string, "
    "shipping_district string, created_at timestamp, updated_at timestamp"
)
ORDER_ITEMS = _struct(
    "item_id int not null, order_id int, product_id int, quantity int not null, "
    f"unit_price {MONEY} not null, total_price {MONEY} not null, created_at timestamp"
)
INVENTORY_MOVEMENTS = _struct(
    "movement_id int not null, product_id int, movement_type string not null, "
    "quantity int not null, reason string, created_at timestamp"
)
# Change rows of products as the log and the synced table hold them.
PRODUCT_LOG = (
    "product_id int, sku string, name string, price double, __op string, __table string, "
    "__source_ts_ms bigint, __deleted boolean"
)


@dataclass(frozen=True)
class Contract:
    """A schema plus the values its enumerated columns may take."""

    schema: T.StructType
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


CONTRACTS = {
    "clickstream": Contract(CLICKSTREAM, {"event_type": CLICK_EVENT_TYPES}),
    "order": Contract(ORDER, {"order_status": ORDER_STATUSES}),
    "inventory": Contract(INVENTORY, {"event_type": INVENTORY_EVENT_TYPES}),
    "fraud_alert": Contract(FRAUD_ALERT, {"alert_type": ALERT_TYPES}),
    "order_items": Contract(ORDER_ITEMS),
    "inventory_movements": Contract(INVENTORY_MOVEMENTS, {"movement_type": ("IN", "OUT", "ADJUSTMENT")}),
}


def get_schema(name: str) -> T.StructType | None:
    contract = CONTRACTS.get(name)
    return contract.schema if contract else None
