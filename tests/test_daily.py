"""The golden day: eight orders, expected values worked out by hand."""

import os

import pytest

from basketry.operators import daily, quality
from basketry.schemas import BATCH_ORDER

DAY = "2024-01-17"
ORDERS = [
    ("ORD-001", "USR-001", "Elektronik", 64999.0, 1, "Istanbul", "DELIVERED"),
    ("ORD-002", "USR-002", "Moda", 3499.0, 2, "Ankara", "DELIVERED"),
    ("ORD-003", "USR-003", "Elektronik", 9999.0, 1, "Izmir", "SHIPPED"),
    ("ORD-004", "USR-001", "Ev Aletleri", 29999.0, 1, "Istanbul", "DELIVERED"),
    ("ORD-005", "USR-004", "Moda", 799.0, 3, "Bursa", "PROCESSING"),
    ("ORD-006", "USR-005", "Elektronik", 89999.0, 1, "Antalya", "DELIVERED"),
    ("ORD-007", "USR-006", "Moda", 4299.0, 1, "Istanbul", "DELIVERED"),
    ("ORD-008", "USR-007", "Ev Aletleri", 8999.0, 1, "Ankara", "SHIPPED"),
]


@pytest.fixture(scope="module")
def orders(spark):
    data = [(o, c, DAY, cat, None, amt, q, city, st) for o, c, cat, amt, q, city, st in ORDERS]
    return spark.createDataFrame(data, BATCH_ORDER)


def test_daily_revenue(orders, rows):
    out = daily.daily_revenue(orders)
    assert [tuple(r)[1:] for r in out.collect()] == [
        ("Elektronik", 154998.0, 2, 2, 77499.0, 2, 77499.0),
        ("Ev Aletleri", 29999.0, 1, 1, 29999.0, 1, 29999.0),
        ("Moda", 7798.0, 2, 3, 3899.0, 2, 3899.0),
    ]


def test_top_cities(orders, rows):
    out = daily.top_cities(orders)
    assert rows(out, "rank", "city", "gmv", "order_count") == [
        (1, "Istanbul", 99297.0, 3), (2, "Antalya", 89999.0, 1), (3, "Ankara", 3499.0, 1),
    ]
    assert rows(daily.top_cities(orders, 1), "city") == [("Istanbul",)]


def test_funnel(orders):
    out = daily.order_funnel(orders)
    assert [(r["status"], r["count"], r["gmv"], str(r["percentage"])) for r in out.collect()] == [
        ("DELIVERED", 5, 192795.0, "62.50"), ("SHIPPED", 2, 18998.0, "25.00"), ("PROCESSING", 1, 799.0, "12.50"),
    ]


def test_summary(orders):
    assert tuple(daily.daily_summary(orders).first()) == (192795.0, 8)


def test_ties_rank_by_name(spark, rows):
    data = [("o1", "u", DAY, "c", None, 10.0, 1, city, "DELIVERED") for city in ("B", "A")]
    out = daily.top_cities(spark.createDataFrame(data, BATCH_ORDER))
    assert rows(out, "rank", "city") == [(1, "A"), (2, "B")]


def test_no_customers_gives_null_not_an_error(spark):
    data = [("o1", None, DAY, "c", None, 10.0, 1, "x", "DELIVERED")]
    row = daily.daily_revenue(spark.createDataFrame(data, BATCH_ORDER)).first()
    assert row["unique_customers"] == 0 and row["revenue_per_customer"] is None


def test_cohorts(spark, rows):
    data = [("a", "2024-01-05"), ("a", "2024-01-20"), ("a", "2024-03-01"), ("b", "2024-01-31"), ("c", "2023-12-31"),
            ("c", "2024-01-01")]
    out = daily.customer_cohorts(spark.createDataFrame(data, "customer_id string, order_date string"))
    assert rows(out) == [
        ("2023-12", 0, 1), ("2023-12", 1, 1), ("2024-01", 0, 2), ("2024-01", 2, 1),
    ]


def test_checks_report_nulls_and_emptiness(orders, rows):
    report = daily.daily_revenue(orders, ordered=False)
    assert all(r["passed"] for r in quality.table_checks(report, "t").collect())
    empty = quality.table_checks(report.filter("false"), "t")
    assert rows(empty.filter("not passed"), "check_name") == [("row_count",)]
    holes = quality.table_checks(report.selectExpr("nullif(category, 'Moda') as category"), "t")
    assert rows(holes) == [("t", "nulls:category", 1, False), ("t", "row_count", 3, True)]


def test_plan_pushes_filters_to_the_scan(spark):
    from basketry.sources import feeds

    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    df = feeds.daily_orders(spark, "/root/testdata/sf0.001", day="1998-10-03", statuses=("DELIVERED",))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "In(o_orderstatus" in plan or "EqualTo(o_orderstatus,F)" in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_fractions_of_a_cent_add_up(spark):
    from datetime import timedelta

    from basketry.operators import revenue

    orders = spark.range(1000).selectExpr(
        "timestamp_seconds(60) as event_time", "'CREATED' as order_status", "cast(id as string) as user_id",
        "0.004D as total_amount", "false as is_first_order", "'r' as shipping_address_region",
        "array(named_struct('category', 'c', 'total_price', 0.004D)) as items")
    minute = timedelta(minutes=1)
    assert revenue.revenue_windows(orders, minute).first()["gmv"] == 4.0
    whole = revenue.revenue_metrics(orders, minute).first()
    assert (whole["gmv"], whole["revenue_by_category"]) == (4.0, {"c": 4.0})


def test_an_order_of_many_items_counts_once(spark):
    from datetime import timedelta

    from basketry.operators import revenue

    orders = spark.sql("""select timestamp_seconds(60) as event_time, 'CREATED' as order_status, 'u' as user_id,
        100.0D as total_amount, true as is_first_order, 'r' as shipping_address_region,
        transform(sequence(1, 25), x -> named_struct('category', 'c', 'total_price', 4.0D)) as items""")
    whole = revenue.revenue_metrics(orders, timedelta(minutes=1)).first()
    assert (whole["gmv"], whole["order_count"], whole["first_time_orders"]) == (100.0, 1, 1)
    assert whole["revenue_by_category"] == {"c": 100.0}


SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables")
@pytest.mark.parametrize("name", ["order_funnel", "daily_summary", "daily_revenue", "revenue_1day", "high_value_first_order",
                                  "top_products", "fraud_alerts", "risk_score"])
def test_reports_read_no_table_in_vain(spark, name):
    from basketry.plans.catalog import QUERIES

    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "c_custkey" not in plan and "n_nationkey" not in plan
    assert ("p_partkey" in plan) == (name == "daily_revenue")


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables")
def test_the_week_reaches_the_orders_scan(spark):
    from basketry.plans.catalog import QUERIES

    plan = QUERIES["revenue_summary"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
