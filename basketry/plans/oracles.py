"""The registered queries once more, as SQL over the same tables, written independently of the
operators: plain windows and aggregates, no slices, no partial states."""

from __future__ import annotations

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS

# --- inputs -----------------------------------------------------------------------------------

K = "CAST(regexp_extract(props, '[0-9]+') AS INTEGER)"

CLICKS = f"""
clicks AS (
  SELECT event_id AS id, CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
         's' || event_id AS session_id,
         CASE event_type WHEN 'signup' THEN 'PAGE_VIEW' WHEN 'view' THEN 'PRODUCT_VIEW'
              WHEN 'click' THEN 'ADD_TO_CART' WHEN 'purchase' THEN 'PURCHASE' ELSE 'ERROR' END AS event_type,
         CASE WHEN k % 10 <> 9 THEN 'cat_' || (k % 5) END AS category,
         CASE WHEN k % 11 <> 10 THEN CAST(value AS DECIMAL(18,2)) END AS price,
         CASE WHEN k % 4 <> 0 THEN k % 4 END AS quantity,
         epoch_us(ts) // 1000 AS ms,
         CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
         'region_' || (event_id % 5) AS geo_region
  FROM (SELECT *, {K} AS k FROM events))"""

PURCHASES = f"""
purchases AS (
  SELECT 'o' || event_id AS order_id, CAST(user_id AS VARCHAR) AS user_id,
         CAST(value AS DECIMAL(18,2)) AS amount, value AS total_amount, epoch_us(ts) // 1000 AS ms,
         CASE WHEN k % 10 <> 9 THEN 'cat_' || (k % 5) END AS category,
         CASE WHEN k % 7 <> 6 THEN 'region_' || (event_id % 5) END AS region,
         k % 3 = 0 AS is_first
  FROM (SELECT *, {K} AS k FROM events WHERE event_type = 'purchase'))"""

PLACED = """
placed AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
         CASE o_orderstatus WHEN 'F' THEN 'CREATED' WHEN 'O' THEN 'PAYMENT_COMPLETED'
              WHEN 'P' THEN 'CANCELLED' END AS order_status,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_totalprice AS total_amount,
         n_name AS region, epoch_us(o_orderdate) // 1000 AS ms
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"""

LINES = """
lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS line_number,
         CAST(l_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
         CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

DAILY = """
daily AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         strftime(o_orderdate, '%Y-%m-%d') AS order_date, p_type AS category, p_brand AS subcategory,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_quantity AS INTEGER) AS quantity,
         n_name AS city,
         CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'SHIPPED' ELSE 'PROCESSING' END AS status,
         CAST(l_partkey AS VARCHAR) AS product_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
       LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"""

CHANGES = """
versions AS (
  SELECT p_partkey, p_name, p_brand, p_size, step,
         CASE WHEN step = 0 THEN 'r' WHEN step = 2 AND p_size <= 10 THEN 'd' ELSE 'u' END AS op,
         CAST(CASE WHEN step = 0 THEN CAST(p_retailprice AS DECIMAL(10,2))
                   WHEN step = 2 AND p_size > 25
                     THEN CAST(p_retailprice AS DECIMAL(10,2)) + p_size - 5
                   ELSE CAST(p_retailprice AS DECIMAL(10,2)) + p_size END AS DOUBLE) AS price
  FROM part CROSS JOIN (VALUES (0), (1), (2)) AS s(step)),
changes AS (
  SELECT CAST(p_partkey AS INTEGER) AS product_id, p_brand || '-' || p_partkey AS sku, p_name AS name,
         price, op, 1700000000000 + step * 60000 + p_partkey AS ts_ms
  FROM versions)"""


def _ts(ms: str) -> str:
    return f"make_timestamp(CAST(({ms}) * 1000 AS BIGINT))"


def _round2(x: str) -> str:
    return f"floor(({x}) * 100 + 0.5) / 100"


# --- daily job --------------------------------------------------------------------------------

DAILY_REVENUE = """
  SELECT order_date, category, CAST(sum(amount) AS DOUBLE) AS gmv, count(order_id) AS order_count,
         CAST(sum(quantity) AS BIGINT) AS units_sold,
         CAST(sum(amount) AS DOUBLE) / count(amount) AS aov,
         count(DISTINCT customer_id) AS unique_customers,
         CAST(sum(amount) AS DOUBLE) / count(DISTINCT customer_id) AS revenue_per_customer
  FROM daily WHERE status = 'DELIVERED' GROUP BY order_date, category"""

TOP_CITIES = """
  SELECT order_date, city, gmv, order_count, rank FROM (
    SELECT order_date, city, CAST(sum(amount) AS DOUBLE) AS gmv, count(*) AS order_count,
           CAST(row_number() OVER (PARTITION BY order_date ORDER BY sum(amount) DESC, city) AS INTEGER) AS rank
    FROM daily WHERE status = 'DELIVERED' GROUP BY order_date, city) WHERE rank <= 10"""

FUNNEL = """
  SELECT status, count(*) AS count, CAST(sum(amount) AS DOUBLE) AS gmv,
         CAST(CAST(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM daily) * 100 AS DECIMAL(5,2)) AS DOUBLE)
           AS percentage
  FROM daily GROUP BY status"""

TOP_PRODUCTS = """
  SELECT order_date, product_id, revenue, units_sold, rank FROM (
    SELECT order_date, product_id, CAST(sum(amount) AS DOUBLE) AS revenue,
           CAST(sum(quantity) AS BIGINT) AS units_sold,
           CAST(row_number() OVER (PARTITION BY order_date ORDER BY sum(amount) DESC, product_id) AS INTEGER)
             AS rank
    FROM daily WHERE status = 'DELIVERED' GROUP BY order_date, product_id) WHERE rank <= 10"""

COHORTS = """
WITH months AS (
  SELECT DISTINCT o_custkey, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m FROM orders),
firsts AS (SELECT o_custkey, min(m) AS f FROM months GROUP BY o_custkey)
SELECT printf('%04d-%02d', f // 12, f % 12 + 1) AS cohort_month, CAST(m - f AS BIGINT) AS months_since,
       count(*) AS customers
FROM months JOIN firsts USING (o_custkey) GROUP BY f, m - f"""


def _table_checks(name: str, source: str, columns: list[str]) -> str:
    parts = [f"SELECT '{name}' AS table_name, 'row_count' AS check_name, count(*) AS value, "
             f"count(*) > 0 AS passed FROM {source}"]
    parts += [f"SELECT '{name}', 'nulls:{c}', count(*) - count({c}), count(*) = count({c}) FROM {source}"
              for c in columns]
    return " UNION ALL ".join(parts)


DQ_DAILY = f"""
WITH {DAILY}, a AS ({DAILY_REVENUE}), b AS ({TOP_CITIES}), c AS ({FUNNEL})
{_table_checks('daily_revenue_by_category', 'a', ['order_date', 'category', 'gmv', 'order_count',
               'units_sold', 'aov', 'unique_customers', 'revenue_per_customer'])}
UNION ALL {_table_checks('daily_top_cities', 'b', ['order_date', 'city', 'gmv', 'order_count', 'rank'])}
UNION ALL {_table_checks('daily_order_funnel', 'c', ['status', 'count', 'gmv', 'percentage'])}"""


def _contract(name: str, source: str, bad: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{check}' AS check_name, "
        f"count(*) FILTER (WHERE {cond}) AS value, count(*) FILTER (WHERE {cond}) = 0 AS passed FROM {source}"
        for check, cond in bad.items()
    )


def _required(columns: str, missing: dict[str, str] | None = None) -> dict[str, str]:
    return {f"required:{c}": (missing or {}).get(c, "false") for c in columns.split()}


DQ_CONTRACT = " UNION ALL ".join([
    _contract("clickstream", "events", {
        **_required("event_id user_id session_id event_type timestamp device_type geo_region"),
        "allowed:event_type": "event_type = 'error'",
    }),
    _contract("order", f"(SELECT *, {K} AS k FROM events WHERE event_type = 'purchase')", {
        **_required(
            "order_id user_id session_id order_status items subtotal discount_amount shipping_cost "
            "total_amount currency payment_method shipping_address_region timestamp is_first_order",
            {"shipping_address_region": "k % 7 = 6", "is_first_order": "k % 3 = 2"},
        ),
        "allowed:order_status": "false",
    }),
    _contract("inventory", "events", {
        **_required("event_id product_id event_type warehouse_id timestamp"),
        "allowed:event_type": "event_type = 'error'",
    }),
    _contract("fraud_alert", "events", {
        **_required("alert_id user_id alert_type risk_score description detected_at related_events"),
        "allowed:alert_type": "false",
    }),
])

# --- sessions ---------------------------------------------------------------------------------


def _sessions(gap_ms: int, more: str = "", source: str = "clicks") -> str:
    """CTEs that end in ``sessions``, with the times in milliseconds as well."""
    return f"""{CLICKS},{more}
marked AS (
  SELECT *, lag(ms) OVER w AS prev FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY ms, event_id)),
numbered AS (
  SELECT *, sum(CASE WHEN prev IS NULL OR ms - prev > {gap_ms} THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY ms, event_id) AS s FROM marked),
placed_first AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, s ORDER BY ms, event_id) AS rn FROM numbered),
viewed AS (
  SELECT user_id, s, category,
         row_number() OVER (PARTITION BY user_id, s ORDER BY count(*) DESC, category) AS rn
  FROM numbered WHERE event_type = 'PRODUCT_VIEW' AND category IS NOT NULL GROUP BY user_id, s, category),
folded AS (
  SELECT user_id, s, min(ms) AS start_ms, max(ms) AS end_ms,
         count(*) FILTER (WHERE event_type = 'PAGE_VIEW') AS page_views,
         count(*) FILTER (WHERE event_type = 'PRODUCT_VIEW') AS product_views,
         count(*) FILTER (WHERE event_type = 'ADD_TO_CART') AS add_to_cart_count,
         count(*) FILTER (WHERE event_type = 'PURCHASE') AS purchase_count,
         coalesce(CAST(sum(price * coalesce(quantity, 1)) FILTER (WHERE event_type = 'PURCHASE') AS DOUBLE), 0.0)
           AS total_revenue
  FROM numbered GROUP BY user_id, s),
sessions AS (
  SELECT f.user_id, p.session_id, {_ts('start_ms')} AS session_start, {_ts('end_ms')} AS session_end,
         CAST((end_ms - start_ms) // 1000 AS BIGINT) AS duration_seconds, page_views, product_views,
         add_to_cart_count, purchase_count, total_revenue, p.device_type, p.geo_region,
         v.category AS primary_category,
         CASE WHEN product_views > 0 THEN CAST(purchase_count AS DOUBLE) / product_views ELSE 0.0 END
           AS conversion_rate,
         start_ms, end_ms
  FROM folded f JOIN placed_first p ON f.user_id = p.user_id AND f.s = p.s AND p.rn = 1
       LEFT JOIN viewed v ON f.user_id = v.user_id AND f.s = v.s AND v.rn = 1)"""


SESSION_COLUMNS = (
    "user_id, session_id, session_start, session_end, duration_seconds, page_views, product_views, "
    "add_to_cart_count, purchase_count, total_revenue, device_type, geo_region, primary_category, "
    "conversion_rate"
)
SESSION_LIST = (
    "session_id, user_id, session_start AS start_time, session_end AS end_time, page_views, product_views, "
    "add_to_cart_count AS add_to_carts, purchase_count AS purchases, total_revenue AS revenue"
)
LONG_GAP = 6 * HOUR_MS

SESSIONS_JSON = f"""
WITH {_sessions(LONG_GAP)}
SELECT '{{"user_id":"' || user_id || '","session_id":"' || session_id || '","session_start":' || start_ms
       || ',"session_end":' || end_ms || ',"duration_seconds":' || duration_seconds
       || ',"page_views":' || page_views || ',"product_views":' || product_views
       || ',"add_to_cart_count":' || add_to_cart_count || ',"purchase_count":' || purchase_count
       || ',"total_revenue":' || total_revenue || ',"device_type":"' || device_type
       || '","geo_region":"' || geo_region || '","primary_category":'
       || coalesce('"' || primary_category || '"', 'null')
       || ',"conversion_rate":' || conversion_rate || '}}' AS value
FROM sessions"""

# --- revenue ----------------------------------------------------------------------------------


def _revenue(source: str, width_ms: int, first: str, having: str = "") -> str:
    start = f"(ms // {width_ms}) * {width_ms}"
    return f"""
  SELECT {_ts(start)} AS window_start, {_ts(f'{start} + {width_ms}')} AS window_end,
         {_ts('min(ms)')} AS first_event_ts, {_ts('max(ms)')} AS last_event_ts,
         CAST(sum(amount) AS DOUBLE) AS gmv, count(*) AS order_count,
         {_round2('CAST(sum(amount) AS DOUBLE) / count(*)')} AS average_order_value,
         count(DISTINCT user_id) AS unique_users,
         count(*) FILTER (WHERE {first}) AS first_time_orders
  FROM {source} GROUP BY ms // {width_ms} {having}"""


def _categories(width_ms: int, source: str = "purchases", amount: str = "amount") -> str:
    start = f"(ms // {width_ms}) * {width_ms}"
    return f"""
  SELECT {_ts(start)} AS window_start, {_ts(f'{start} + {width_ms}')} AS window_end, category,
         CAST(sum({amount}) AS DOUBLE) AS revenue
  FROM {source} WHERE category IS NOT NULL GROUP BY ms // {width_ms}, category"""


def _top(inner: str) -> str:
    return f"""
  SELECT window_start, window_end, category AS top_category FROM (
    SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY revenue DESC, category) AS rn
    FROM ({inner})) WHERE rn = 1"""


SOLD = "(SELECT * FROM placed WHERE order_status IN ('CREATED', 'PAYMENT_COMPLETED'))"
CLOSED_MINUTES = "HAVING (ms // 60000) * 60000 + 60000 <= (SELECT max(ms) FROM purchases) - 10000"

def _flat(having: str = "", more: str = "") -> str:
    return f"""
WITH {PURCHASES}, w AS ({_revenue('purchases', 60000, 'is_first', having)}),
c AS (SELECT window_start, NULL AS region, category, revenue AS category_revenue FROM ({_categories(60000)})
      UNION ALL
      SELECT DISTINCT {_ts('(ms // 60000) * 60000')}, region, NULL, NULL FROM purchases
      WHERE region IS NOT NULL)
SELECT w.window_start AS window_start_timestamp, w.window_end AS window_end_timestamp, gmv, order_count,
       average_order_value, unique_users, first_time_orders, region, category, category_revenue{more}
FROM w LEFT JOIN c ON w.window_start = c.window_start"""


REVENUE_FLAT = _flat()

REVENUE_SUMMARY = f"""
WITH {PLACED}, {LINES},
sold AS (SELECT *, CAST({_ts('ms')} AS DATE) AS d FROM {SOLD}),
spans AS (SELECT 'today' AS period, DATE '2001-08-01' AS lo UNION ALL SELECT 'week', DATE '2001-07-26'),
totals AS (
  SELECT period, CAST(sum(amount) AS DOUBLE) AS gmv, count(*) AS order_count
  FROM spans JOIN sold ON d BETWEEN lo AND DATE '2001-08-01' GROUP BY period),
best AS (
  SELECT period, category, row_number() OVER (PARTITION BY period ORDER BY sum(price) DESC, category) AS rn
  FROM spans JOIN sold ON d BETWEEN lo AND DATE '2001-08-01' JOIN lines USING (order_id)
  GROUP BY period, category)
SELECT t.period, gmv, order_count, {_round2('gmv / order_count')} AS avg_order, category AS top_category
FROM totals t LEFT JOIN best b ON t.period = b.period AND b.rn = 1"""

# --- fraud ------------------------------------------------------------------------------------


def _alert(kind: str, score: float, text: str, related: str, source: str, where: str) -> str:
    return f"""
  SELECT sha256(user_id || '|{kind}|' || order_id) AS alert_id, user_id, order_id, '{kind}' AS alert_type,
         CAST({score} AS DOUBLE) AS risk_score, {text} AS description, {_ts('ms')} AS detected_at,
         {related} AS related_events
  FROM {source} WHERE {where}"""


def _rapid(source: str, within_ms: int, extra: str = "true") -> str:
    hits = f"""(
    SELECT user_id, order_id AS first, ms AS first_ms, lead(order_id, 1) OVER w AS second,
           lead(order_id, 2) OVER w AS order_id, lead(ms, 2) OVER w AS ms
    FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY ms, order_id))"""
    text = f"'User placed 3 orders within {within_ms // 60000} minutes. First: ' || first || ', Last: ' || order_id"
    related = "first || ',' || second || ',' || order_id"
    return _alert("RAPID_ORDERS", 0.85, text, related, hits, f"ms - first_ms < {within_ms} AND {extra}")


def _first(source: str, threshold: float) -> str:
    firsts = f"""(
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ms, order_id) AS rn FROM {source})"""
    text = (f"'First order from user is high value: ' || printf('%.2f', total_amount) "
            f"|| ' TRY (threshold: {threshold:.2f})'")
    return _alert("HIGH_VALUE_FIRST_ORDER", 0.75, text, "order_id", firsts,
                  f"rn = 1 AND total_amount > {threshold}")


CREATED = "(SELECT * FROM placed WHERE order_status = 'CREATED')"
PLACED_ALERTS = f"{_rapid(CREATED, 30 * DAY_MS)} UNION ALL {_first('placed', 250000.0)}"
CLOSED_THIRD = "ms <= (SELECT max(ms) FROM purchases) - 10000"

LOCATION = _alert(
    "LOCATION_ANOMALY", 0.65, "'Order from new city for existing user'", "order_id",
    """(SELECT *, row_number() OVER (PARTITION BY user_id, region ORDER BY ms, order_id) AS of_region,
               row_number() OVER (PARTITION BY user_id ORDER BY ms, order_id) AS of_user
        FROM purchases WHERE region IS NOT NULL)""",
    "of_region = 1 AND of_user > 1",
)

RISK = f"""
WITH {PLACED},
flagged AS (SELECT order_id, total_amount,
                   row_number() OVER (PARTITION BY user_id ORDER BY ms, order_id) = 1 AS is_first_order
            FROM placed)
SELECT order_id, total_amount, is_first_order,
       CASE WHEN total_amount < 0 THEN 0.95 WHEN total_amount = 0 THEN 0.0
            ELSE least(least(total_amount / CAST(200000 AS DOUBLE), CAST(0.9 AS DOUBLE))
                       + CASE WHEN is_first_order THEN CAST(0.1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END,
                       CAST(1 AS DOUBLE)) END AS risk_score
FROM flagged"""

# --- messages ---------------------------------------------------------------------------------

STATUS = """CASE o_orderstatus WHEN 'F' THEN 'CREATED' WHEN 'O' THEN 'PAYMENT_COMPLETED'
              WHEN 'P' THEN 'CANCELLED' END"""

MESSAGE = f"""
  SELECT o_orderkey AS k, o_orderkey % 10 AS odd, o_orderpriority AS priority, o_custkey, o_orderdate, o_totalprice,
         {STATUS} AS order_status, epoch_us(o_orderdate) // 1000 AS ms,
         (SELECT string_agg('{{"product_id":"P' || i || '","category":"c' || i || '","quantity":'
                            || CASE WHEN o_orderkey % 10 = 2 THEN '5.7' ELSE i::VARCHAR END
                            || ',"total_price":' || i || '.5}}', ',' ORDER BY i)
          FROM range(1, o_orderkey % 3 + 2) r(i)) AS items
  FROM orders"""

BROKEN = "(priority IN ('3-MEDIUM', '5-LOW') OR odd IN (3, 4))"

REJECTED = f"""
  SELECT CASE WHEN {BROKEN} THEN 'Malformed record' ELSE 'Missing required fields: userId or orderId' END AS error,
         CASE WHEN priority = '5-LOW' THEN '{{"order_id":"' || k || '","user_id"'
         ELSE '{{"order_id":' || CASE WHEN odd = 4 THEN '{{"x":1}}' ELSE '"' || k || '"' END || ','
              || CASE WHEN priority <> '4-NOT SPECIFIED' THEN '"user_id":"' || o_custkey || '",' ELSE '' END
              || '"order_status":"' || order_status || '","total_amount":"'
              || CASE WHEN priority = '3-MEDIUM' THEN 'n/a' ELSE CAST(o_totalprice AS DECIMAL(18,2))::VARCHAR END
              || '","timestamp":' || CASE WHEN odd = 1 THEN (ms // 1000) || 'E3' ELSE ms::VARCHAR END
              || ',"items":[' || items || '],"is_first_order":' || CASE WHEN odd = 3 THEN '"yes"' ELSE 'true' END
              || ',"channel":"web"}}' END AS original
  FROM ({MESSAGE}) WHERE {BROKEN} OR priority = '4-NOT SPECIFIED'"""

VALID = f"""
  SELECT k::VARCHAR AS order_id, o_custkey::VARCHAR AS user_id, order_status, o_totalprice AS total_amount,
         ms AS "timestamp", true AS is_first_order, odd, k
  FROM ({MESSAGE}) WHERE NOT {BROKEN} AND priority <> '4-NOT SPECIFIED'"""

VALID_ITEMS = f"""
  SELECT order_id, user_id, order_status, total_amount, "timestamp", is_first_order, 'P' || i AS product_id,
         'c' || i AS category, CAST(CASE WHEN odd = 2 THEN 5 ELSE i END AS INTEGER) AS quantity, i + 0.5::DOUBLE AS total_price
  FROM ({VALID}), LATERAL (SELECT unnest(range(1, k % 3 + 2)) AS i)"""

LATE_ROWS = f"""
WITH {CLICKS},
bounds AS (SELECT max(ms) FILTER (WHERE event_type <> 'ERROR') - 10000 AS before, max(ms) - 10000 AS final
           FROM clicks)
SELECT {_ts(f'(ms // {HOUR_MS}) * {HOUR_MS}')} AS window_start, count(*) AS events
FROM clicks, bounds
WHERE (event_type <> 'ERROR' OR (ms // {HOUR_MS} + 1) * {HOUR_MS} > before)
  AND (ms // {HOUR_MS} + 1) * {HOUR_MS} <= final
GROUP BY ms // {HOUR_MS}"""

# Clicks that come in two batches, errors last, against the watermark of the first.
IN_TIME = """
bound AS (SELECT max(ms) FILTER (WHERE event_type <> 'ERROR') - 30000 AS before FROM clicks),
in_time AS (SELECT clicks.* FROM clicks, bound WHERE event_type <> 'ERROR' OR ms >= before),"""

LATE_SESSIONS = f"""
WITH {_sessions(HOUR_MS // 2, IN_TIME, 'in_time')}
SELECT 'session' AS kind, user_id, session_id AS id, end_ms AS ms, duration_seconds AS amount
FROM sessions WHERE end_ms + {HOUR_MS // 2} <= (SELECT max(ms) FROM in_time) - 30000
UNION ALL
SELECT 'late', user_id, event_id, ms, before - ms FROM clicks, bound WHERE event_type = 'ERROR' AND ms < before"""

LATE_REVENUE = f"""
WITH {PURCHASES},
bound AS (SELECT max(ms) FILTER (WHERE NOT is_first) - 10000 AS before FROM purchases),
in_time AS (SELECT purchases.* FROM purchases, bound WHERE NOT is_first OR ms >= before)
SELECT 'window' AS kind, '' AS id, (ms // 60000) * 60000 AS ms, CAST(sum(amount) AS DOUBLE) AS amount, count(*) AS n
FROM in_time GROUP BY ms // 60000
HAVING (ms // 60000) * 60000 + 60000 <= (SELECT max(ms) FROM in_time) - 10000
UNION ALL
SELECT 'late', order_id, ms, total_amount, before - ms FROM purchases, bound WHERE is_first AND ms < before"""

OPEN_SESSIONS = f"""
WITH {_sessions(LONG_GAP)}
SELECT user_id, session_start, session_end FROM sessions
WHERE end_ms + {LONG_GAP} > (SELECT max(ms) FROM clicks) - 30000"""

# --- change data ------------------------------------------------------------------------------

CDC_ORDERS = f"""
  SELECT CASE WHEN low THEN 0 ELSE CAST(o_orderkey AS INTEGER) END AS order_id,
         CASE WHEN low THEN '' ELSE 'ORD-' || o_orderkey END AS order_number,
         CASE WHEN low THEN '' ELSE {STATUS} END AS order_status,
         CASE WHEN low OR o_orderpriority = '4-NOT SPECIFIED' THEN 0.0 ELSE o_totalprice END AS total_amount,
         CASE WHEN low THEN '' ELSE 'city_' || (o_custkey % 25) END AS shipping_city,
         CASE WHEN low THEN 'error' WHEN o_orderstatus = 'F' THEN 'c' WHEN o_orderstatus = 'O' THEN 'u'
              ELSE 'r' END AS operation
  FROM (SELECT *, o_orderpriority = '5-LOW' AS low FROM orders)"""

ORDER_FEED = f"""
SELECT CASE operation WHEN 'c' THEN 'create' WHEN 'u' THEN 'update' WHEN 'd' THEN 'delete' ELSE 'other' END
         AS change,
       '{{"type":"order_change","order":"' || order_number || '","status":"' || order_status || '"}}' AS value
FROM ({CDC_ORDERS}) WHERE order_id > 0"""

PRICE_FEED = f"""
WITH {CHANGES}
SELECT '{{"type":"price_change","sku":"' || sku || '","price":' || price || '}}' AS value
FROM changes WHERE op = 'u'"""

CURRENT_STATE = f"""
WITH {CHANGES}
SELECT product_id, sku, name, price, op FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY ts_ms DESC) AS rn FROM changes)
WHERE rn = 1 AND op <> 'd'"""

PRICE_CHANGES = f"""
WITH {CHANGES},
history AS (SELECT product_id, ts_ms AS changed_ms, price AS new_price,
                   lag(price) OVER (PARTITION BY product_id ORDER BY ts_ms) AS previous_price
            FROM changes WHERE op <> 'd')
SELECT product_id, changed_ms, previous_price, new_price,
       {_round2('new_price - previous_price')} AS delta,
       {_round2('(new_price - previous_price) / previous_price * 100')} AS delta_percent
FROM history WHERE previous_price <> new_price"""

STOCK = """
WITH moves AS (
  SELECT l_partkey AS product_id,
         CASE l_returnflag WHEN 'R' THEN 'IN' WHEN 'A' THEN 'OUT' ELSE 'ADJUSTMENT' END AS movement_type,
         CAST(l_quantity AS BIGINT) AS quantity, epoch_us(l_shipdate) // 1000 AS "timestamp", l_orderkey,
         l_linenumber, l_suppkey,
         CAST(CASE WHEN l_returnflag = 'A' THEN -l_quantity ELSE l_quantity END AS BIGINT) AS delta
  FROM lineitem)
SELECT *, CAST(sum(delta) OVER (
            PARTITION BY product_id
            ORDER BY "timestamp", l_orderkey, l_linenumber, l_suppkey, movement_type, quantity
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stock
FROM moves"""

INVENTORY = f"""
WITH e AS (
  SELECT 'P' || {K} AS product_id, epoch_us(ts) // 1000 AS ms, CAST(event_id AS VARCHAR) AS event_id,
         CASE WHEN event_type IN ('view', 'purchase') THEN CAST(floor(value) AS INTEGER) END AS stock,
         CASE WHEN event_type = 'click' THEN value END AS price
  FROM events),
s AS (SELECT product_id, stock, row_number() OVER (PARTITION BY product_id ORDER BY ms DESC, event_id DESC) AS rn
      FROM e WHERE stock IS NOT NULL),
p AS (SELECT product_id, price, row_number() OVER (PARTITION BY product_id ORDER BY ms DESC, event_id DESC) AS rn
      FROM e WHERE price IS NOT NULL)
SELECT u.product_id, s.stock, p.price, u.updated_ms
FROM (SELECT product_id, max(ms) AS updated_ms FROM e GROUP BY product_id) u
     LEFT JOIN s ON u.product_id = s.product_id AND s.rn = 1
     LEFT JOIN p ON u.product_id = p.product_id AND p.rn = 1"""

NESTED = f"""
WITH {PLACED}, {LINES}
SELECT order_id, user_id, order_status, line_number, product_id, product_name, category,
       CAST(quantity AS INTEGER) AS quantity, CAST(price AS DOUBLE) AS total_price
FROM placed LEFT JOIN lines USING (order_id)"""

JOB_FRAUD = f"""
WITH {PURCHASES},
alerts AS ({_rapid('purchases', DAY_MS, CLOSED_THIRD)} UNION ALL {_first('purchases', 100.0)}),
dead AS (SELECT '{{"order_id":"' || o_orderkey || '","user_id"' AS original FROM orders)
SELECT kind, alert_id AS payload, description AS note
FROM alerts, (VALUES ('alert'), ('alert told')) k(kind)
UNION ALL SELECT kind, original, 'Malformed record' FROM dead, (VALUES ('dead'), ('dead told')) k(kind)"""

ORACLES: dict[str, str] = {
    "daily_orders_scan": f"WITH {DAILY} SELECT order_id, customer_id, order_date, category, subcategory, "
                         "CAST(amount AS DOUBLE) AS amount, quantity, city, status, product_id "
                         "FROM daily WHERE order_date = '1998-10-03'",
    "daily_revenue": f"WITH {DAILY} {DAILY_REVENUE}",
    "daily_top_cities": f"WITH {DAILY} {TOP_CITIES}",
    "order_funnel": f"WITH {DAILY} {FUNNEL}",
    "daily_summary": f"WITH {DAILY} SELECT CAST(sum(amount) FILTER (WHERE status = 'DELIVERED') AS DOUBLE) "
                     "AS total_gmv, count(*) AS orders_processed FROM daily",
    "top_products": f"WITH {DAILY} {TOP_PRODUCTS}",
    "customer_cohorts": COHORTS,
    "dq_daily": DQ_DAILY,
    "dq_contract": DQ_CONTRACT,
    "session_metrics": f"WITH {_sessions(HOUR_MS // 2)} SELECT {SESSION_COLUMNS} FROM sessions",
    "session_metrics_6h": f"WITH {_sessions(LONG_GAP)} SELECT {SESSION_COLUMNS} FROM sessions",
    "session_metrics_stream": f"WITH {_sessions(LONG_GAP)} SELECT {SESSION_COLUMNS} FROM sessions "
                              f"WHERE end_ms + {LONG_GAP} <= (SELECT max(ms) FROM clicks) - 30000",
    "sessions_json": SESSIONS_JSON,
    "sessions_list": f"WITH {_sessions(LONG_GAP)} SELECT {SESSION_LIST} FROM sessions",
    "sessions_by_user": f"WITH {_sessions(LONG_GAP)} SELECT {SESSION_LIST} FROM sessions WHERE user_id = '7'",
    "revenue_1min": f"WITH {PURCHASES} {_revenue('purchases', 60000, 'is_first')}",
    "revenue_1day": f"WITH {PLACED} " + _revenue(
        "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ms, order_id) = 1 AS is_first "
        "FROM placed) WHERE order_status IN ('CREATED', 'PAYMENT_COMPLETED'))", DAY_MS, "is_first"),
    "revenue_fractions": f"""
WITH {PURCHASES}, cut AS (SELECT *, CAST(total_amount / 100 AS DECIMAL(18,4)) AS fine FROM purchases),
t AS (SELECT ms // {DAY_MS} AS d, CAST(sum(fine) AS DOUBLE) AS total, count(*) AS n FROM cut GROUP BY ms // {DAY_MS})
SELECT {_ts(f"d * {DAY_MS}")} AS window_start, category, CAST(sum(fine) AS DOUBLE) AS revenue,
       any_value({_round2("total")}) AS gmv, any_value({_round2(_round2("total") + " / n")}) AS average_order_value
FROM cut JOIN t ON d = ms // {DAY_MS} WHERE category IS NOT NULL GROUP BY d, category""",
    "revenue_by_category": f"WITH {PURCHASES} {_categories(60000)}",
    "revenue_by_category_1day": f"WITH {PLACED}, {LINES} " + _categories(
        DAY_MS, f"(SELECT ms, category, price FROM {SOLD} JOIN lines USING (order_id))", "price"),
    "orders_by_region": f"WITH {PLACED} SELECT {_ts(f'(ms // {DAY_MS}) * {DAY_MS}')} AS window_start, "
                        f"{_ts(f'(ms // {DAY_MS} + 1) * {DAY_MS}')} AS window_end, region, "
                        f"count(*) AS order_count FROM {SOLD} GROUP BY ms // {DAY_MS}, region",
    "revenue_flat": REVENUE_FLAT,
    "revenue_1min_stream": f"WITH {PURCHASES} {_revenue('purchases', 60000, 'is_first', CLOSED_MINUTES)}",
    "revenue_maps_stream": f"""
WITH {PURCHASES},
closed AS (SELECT *, (ms // 60000) * 60000 AS w FROM purchases
           WHERE (ms // 60000) * 60000 + 60000 <= (SELECT max(ms) FROM purchases) - 10000)
SELECT {_ts('w')} AS window_start, 'category' AS kind, category AS key, CAST(sum(amount) AS DOUBLE) AS value
FROM closed WHERE category IS NOT NULL GROUP BY w, category
UNION ALL
SELECT {_ts('w')}, 'region', region, CAST(count(*) AS DOUBLE)
FROM closed WHERE region IS NOT NULL GROUP BY w, region""",
    "revenue_top_category": f"WITH {PURCHASES} {_top(_categories(DAY_MS))}",
    "revenue_summary": REVENUE_SUMMARY,
    "revenue_realtime": f"""
WITH {PURCHASES}, w AS ({_revenue('purchases', 60000, 'is_first')}), t AS ({_top(_categories(60000))}),
newest AS (SELECT * FROM w ORDER BY window_start DESC LIMIT 2)
SELECT newest.window_start, newest.window_end, gmv AS total_gmv, order_count,
       average_order_value AS avg_order_value, top_category
FROM newest LEFT JOIN t ON newest.window_start = t.window_start""",
    "risk_score": RISK,
    "rapid_orders": f"WITH {PURCHASES} {_rapid('purchases', DAY_MS)}",
    "high_value_first_order": f"WITH {PLACED} {_first('placed', 250000.0)}",
    "location_anomaly": f"WITH {PURCHASES} {LOCATION}",
    "fraud_alerts": f"WITH {PLACED} {PLACED_ALERTS}",
    "latest_alerts": f"WITH {PLACED} SELECT * FROM ({PLACED_ALERTS}) ORDER BY detected_at DESC, alert_id LIMIT 100",
    "alerts_by_user": f"WITH {PLACED} SELECT * FROM ({PLACED_ALERTS}) WHERE user_id = '963' "
                      "ORDER BY detected_at DESC, alert_id LIMIT 50",
    "rapid_orders_stream": f"WITH {PURCHASES} {_rapid('purchases', DAY_MS, CLOSED_THIRD)}",
    "high_value_first_order_stream": f"WITH {PURCHASES} {_first('purchases', 100.0)}",
    "fraud_alerts_stream": f"WITH {PURCHASES} {_rapid('purchases', DAY_MS, CLOSED_THIRD)} "
                           f"UNION ALL {_first('purchases', 100.0)}",
    "dlq_valid": VALID_ITEMS,
    "dlq_rejected": REJECTED,
    "dlq_stream": f"SELECT 'valid' AS kind, order_id AS payload, '' AS error FROM ({VALID}) "
                  f"UNION ALL SELECT 'dead', original, error FROM ({REJECTED})",
    "late_rows_stream": LATE_ROWS,
    "late_sessions_stream": LATE_SESSIONS,
    "late_revenue_stream": LATE_REVENUE,
    "restart_sessions_stream": f"WITH {_sessions(LONG_GAP)} SELECT {SESSION_COLUMNS} FROM sessions "
                               f"WHERE end_ms + {LONG_GAP} <= (SELECT max(ms) FROM clicks) - 30000",
    "restart_revenue_stream": f"WITH {PURCHASES} {_revenue('purchases', 60000, 'is_first', CLOSED_MINUTES)}",
    "open_sessions_state": OPEN_SESSIONS,
    "seen_users_state": f"WITH {PURCHASES} SELECT DISTINCT user_id FROM purchases WHERE user_id IS NOT NULL",
    "first_order_bounded_stream": f"WITH {PURCHASES} {_first('purchases', 100.0)}",
    "unreadable_files": f"WITH {PLACED} SELECT 'alert' AS kind, alert_id AS name FROM ({PLACED_ALERTS}) "
                        "UNION ALL SELECT 'unreadable', 'damage.parquet'",
    "cdc_unwrap": f"WITH {CHANGES} SELECT product_id, sku, name, price, op, 'products' AS source_table, "
                  "ts_ms AS source_ts_ms, op = 'd' AS is_deleted FROM changes",
    "cdc_rejected": "SELECT 'Malformed record' AS error, '{\"before\":{\"product_id\":' || p_partkey AS original "
                    "FROM part WHERE p_size = 50",
    "cdc_products_parsed": f"WITH {CHANGES} SELECT product_id, sku, name, price, op AS operation FROM changes",
    "cdc_orders_parsed": CDC_ORDERS,
    "cdc_price_feed": PRICE_FEED,
    "cdc_order_feed": ORDER_FEED,
    "cdc_price_feed_stream": PRICE_FEED,
    "cdc_order_feed_stream": ORDER_FEED,
    "cdc_current_state": CURRENT_STATE,
    "cdc_current_state_stream": CURRENT_STATE,
    "cdc_snapshot_then_stream": f"SELECT product_id, sku, name, price FROM ({CURRENT_STATE})",
    "price_changes": PRICE_CHANGES,
    "stock_running": STOCK,
    "stock_running_stream": STOCK,
    "inventory_latest": INVENTORY,
    "inventory_latest_stream": INVENTORY,
    "stock_level_stream": """
SELECT l_partkey AS product_id, count(*) AS movements,
       CAST(sum(CASE WHEN l_returnflag = 'A' THEN -l_quantity ELSE l_quantity END) AS BIGINT) AS stock
FROM lineitem GROUP BY l_partkey""",
    "order_events_nested": NESTED,
    "order_events_parts": f"""
WITH {PLACED}, {LINES}
SELECT order_id, user_id, order_status, total_amount, product_id, product_name, category,
       CAST(quantity AS INTEGER) AS quantity, CAST(price AS DOUBLE) AS total_price
FROM placed LEFT JOIN lines USING (order_id)""",
    "order_items_parsed": """
SELECT '' AS error, CAST(l_orderkey AS INTEGER) AS order_id, CAST(l_partkey AS INTEGER) AS product_id,
       CAST(l_quantity AS INTEGER) AS quantity,
       CAST(CAST(floor(l_extendedprice * 100 / l_quantity) / 100 AS DECIMAL(10,2)) AS DOUBLE) AS unit_price,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS total_price
FROM lineitem WHERE l_linenumber < 6
UNION ALL
SELECT CASE l_linenumber WHEN 6 THEN 'Malformed record' ELSE 'Missing required fields: userId or orderId' END,
       CAST(count(*) AS INTEGER), NULL, NULL, NULL, NULL FROM lineitem WHERE l_linenumber > 5 GROUP BY l_linenumber""",
    "daily_revenue_table": f"WITH {DAILY} {DAILY_REVENUE}",
    "daily_rerun_table": f"WITH {DAILY} SELECT * FROM ({DAILY_REVENUE}) WHERE order_date <> '1998-10-03'",
    "user_sessions_table": f"WITH {_sessions(LONG_GAP)} SELECT {SESSION_COLUMNS} FROM sessions",
    "real_time_revenue_table": REVENUE_FLAT,
    "fraud_alerts_table": f"WITH {PURCHASES} {_rapid('purchases', DAY_MS)} "
                          f"UNION ALL {_first('purchases', 100.0)}",
    "job_sessions": f"WITH {_sessions(HOUR_MS // 2)} SELECT {SESSION_COLUMNS}, true AS published FROM sessions "
                    f"WHERE end_ms + {HOUR_MS // 2} <= (SELECT max(ms) FROM clicks) - 30000",
    "job_revenue": _flat(CLOSED_MINUTES, ", gmv AS published_gmv"),
    "job_fraud": JOB_FRAUD,
    "job_fraud_retry": JOB_FRAUD,
    "job_daily": f"""
WITH {DAILY}, day AS (SELECT * FROM daily WHERE order_date = '1998-10-03')
SELECT 'daily_revenue_by_category' AS report, order_date, category AS name, gmv, order_count AS n
FROM ({DAILY_REVENUE.replace('FROM daily', 'FROM day')})
UNION ALL SELECT 'daily_top_cities', order_date, city, gmv, order_count FROM ({TOP_CITIES.replace('FROM daily', 'FROM day')})
UNION ALL SELECT 'daily_order_funnel', '1998-10-03', status, gmv, count FROM ({FUNNEL.replace('FROM daily', 'FROM day')})""",
    "job_cdc": f"SELECT 'cdc.price-changes' AS topic, value FROM ({PRICE_FEED}) "
               f"UNION ALL SELECT 'cdc.order-changes', value FROM ({ORDER_FEED})",
}
