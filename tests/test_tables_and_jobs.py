import json

import pytest

from basketry.operators import quality
from basketry.plans import jobs
from basketry.plans.jobs import Options, run_job
from basketry.schemas import BATCH_ORDER
from basketry.session import work_dir
from basketry.sources import tables
from basketry.sources.topics import read_topic, write_topic

T0 = 1705572000000


def days(spark, *rows):
    return spark.createDataFrame(rows, "order_date string, category string, gmv double")


def read(spark, path, df, rows):
    return rows(spark.read.schema(df.schema).parquet(path), *df.columns)


def test_overwrite_replaces_only_its_days(spark, rows):
    path = work_dir(spark, "t")
    first = days(spark, ("2024-01-01", "a", 1.0), ("2024-01-02", "a", 2.0))
    tables.write_daily(first, path)
    tables.write_daily(days(spark, ("2024-01-02", "b", 3.0)), path)
    assert read(spark, path, first, rows) == [("2024-01-01", "a", 1.0), ("2024-01-02", "b", 3.0)]
    tables.write_daily(days(spark, ("2024-01-02", "b", 3.0)), path, mode="append")
    assert len(read(spark, path, first, rows)) == 3


def test_merge_replaces_equal_keys(spark, rows):
    path = work_dir(spark, "t")
    keys = ["order_date", "category"]
    first = days(spark, ("2024-01-01", "a", 1.0), ("2024-01-02", "a", 2.0), ("2024-01-02", None, 2.5))
    tables.write_daily(first, path, mode="merge", keys=keys)
    second = days(spark, ("2024-01-02", "a", 9.0), ("2024-01-02", "c", 4.0), ("2024-01-02", None, 8.0))
    tables.write_daily(second, path, mode="merge", keys=keys)
    assert read(spark, path, first, rows) == sorted([
        ("2024-01-01", "a", 1.0), ("2024-01-02", "a", 9.0), ("2024-01-02", "c", 4.0), ("2024-01-02", None, 8.0)], key=repr)
    with pytest.raises(ValueError):
        tables.write_daily(second, path, mode="merge", keys=["category"])


def test_scan_reads_one_partition(spark):
    path = work_dir(spark, "t")
    tables.write_daily(days(spark, ("2024-01-01", "a", 1.0), ("2024-01-02", "a", 2.0)), path)
    df = tables.scan_day(spark, path, "2024-01-02")
    assert df.count() == 1 and len(df.inputFiles()) == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan


def test_topic_round_trip(spark):
    folder = work_dir(spark, "topic")
    spark.createDataFrame([("x",), ("y",)], "value string").coalesce(1).write.text(f"{folder}/in/t")
    topic = read_topic(spark, "t", path=f"{folder}/in")
    q = write_topic(topic, "copy", f"{folder}/ck", path=f"{folder}/out").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r[0] for r in spark.read.text(f"{folder}/out/copy").collect()) == ["x", "y"]
    with pytest.raises(ValueError):
        read_topic(spark, "t")


def put(spark, folder, topic, messages):
    spark.createDataFrame([(m if isinstance(m, str) else json.dumps(m),) for m in messages], "value string").coalesce(
        1).write.mode("append").text(f"{folder}/topics/{topic}")


def order(order_id, ms, user="u", amount=100.0, status="CREATED"):
    item = {"product_id": "p", "product_name": "n", "category": "c", "quantity": 1, "unit_price": 1.0, "total_price": 1.0}
    return {"order_id": order_id, "user_id": user, "session_id": "s", "order_status": status, "items": [item],
            "total_amount": amount, "timestamp": T0 + ms, "shipping_address_region": "r", "is_first_order": False}


def lines_of(spark, path):
    return [json.loads(r["value"]) for r in spark.read.text(path).collect()]


def test_fraud_job(spark):
    folder = work_dir(spark, "job")
    options = Options(output=f"{folder}/out", topics=f"{folder}/topics", drain=True)
    put(spark, folder, "transactions.orders", [order(f"o{i}", i * 1000) for i in range(3)] + ["not json"])
    put(spark, folder, "transactions.orders", [order("big", 600_000, user="v", amount=9000.0), {"order_id": "x"}])
    run_job(spark, options, "fraud")
    alerts = lines_of(spark, f"{folder}/out/topics/alerts.fraud")
    assert sorted(a["alert_type"] for a in alerts) == ["HIGH_VALUE_FIRST_ORDER", "RAPID_ORDERS"]
    assert spark.read.parquet(f"{folder}/out/tables/fraud_alerts").count() == 2
    assert len(lines_of(spark, f"{folder}/out/topics/dlq.fraud-detector")) == 2
    put(spark, folder, "transactions.orders", [order("o9", 601_000, user="w", amount=9000.0)])
    run_job(spark, options, "fraud")
    assert spark.read.parquet(f"{folder}/out/tables/fraud_alerts").count() == 3


def test_revenue_job(spark):
    folder = work_dir(spark, "job")
    options = Options(output=f"{folder}/out", topics=f"{folder}/topics", drain=True)
    put(spark, folder, "transactions.orders", [
        order("a", 0), order("b", 1000, user="v", amount=50.5), order("c", 2000, status="SHIPPED"),
        order("end", 600_000)])
    run_job(spark, options, "revenue")
    [m] = lines_of(spark, f"{folder}/out/topics/analytics.revenue")
    assert (m["gmv"], m["order_count"], m["unique_users"], m["average_order_value"]) == (150.5, 2, 2, 75.25)
    assert m["revenue_by_category"] == {"c": 2.0} and m["orders_by_region"] == {"r": 2}
    flat = spark.read.parquet(f"{folder}/out/tables/real_time_revenue")
    assert sorted((r["category"] or "", r["region"] or "") for r in flat.collect()) == [("", "r"), ("c", "")]


def test_sessions_job_is_the_default(spark):
    folder = work_dir(spark, "job")
    options = Options(output=f"{folder}/out", topics=f"{folder}/topics", drain=True)
    click = {"event_id": "e", "user_id": "u", "session_id": "s", "event_type": "PURCHASE", "price": 10.0, "quantity": 2,
             "timestamp": T0, "device_type": "mobile", "geo_region": "r"}
    put(spark, folder, "clickstream.events", [click, {**click, "user_id": "z", "timestamp": T0 + 7_200_000}])
    run_job(spark, options)
    [s] = lines_of(spark, f"{folder}/out/topics/analytics.sessions")
    assert (s["user_id"], s["total_revenue"], s["primary_category"]) == ("u", 20.0, None)
    assert spark.read.parquet(f"{folder}/out/tables/user_sessions").count() == 1


def test_cdc_job(spark):
    folder = work_dir(spark, "job")
    options = Options(output=f"{folder}/out", topics=f"{folder}/topics", drain=True)
    put(spark, folder, "cdc.public.products", ['{"product_id":1,"sku":"S","price":5,"__op":"u"}', "oops"])
    put(spark, folder, "cdc.public.orders", ['{"order_id":1,"order_number":"N","order_status":"X","__op":"c"}', "oops"])
    run_job(spark, options, "cdc")
    assert lines_of(spark, f"{folder}/out/topics/cdc.price-changes") == [
        {"type": "price_change", "sku": "S", "price": 5.0}]
    assert lines_of(spark, f"{folder}/out/topics/cdc.order-changes") == [
        {"type": "order_change", "order": "N", "status": "X"}]


def test_daily_job_can_run_twice(spark, rows):
    folder = work_dir(spark, "job")
    lines = spark.createDataFrame([
        ("o1", "u", "2024-01-17", "A", "s", 10.0, 1, "X", "DELIVERED"),
        ("o2", "u", "2024-01-17", "B", "s", 5.0, 1, "X", "SHIPPED"),
        ("o3", "u", "2024-01-18", "A", "s", 7.0, 1, "X", "DELIVERED")], BATCH_ORDER)
    tables.write_daily(lines, f"{folder}/in")
    options = Options(output=f"{folder}/out", input=f"{folder}/in", date="2024-01-17")
    for _ in range(2):
        assert run_job(spark, options, "daily").count() == 0
    got = {name: spark.read.parquet(f"{folder}/out/{name}").count() for name in quality.DAILY_TABLES}
    assert got == dict(zip(quality.DAILY_TABLES, (1, 1, 2)))


def test_unknown_job_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown job"):
        run_job(spark, Options(output="x"), "nope")
    assert set(jobs.JOBS) == {"sessions", "revenue", "fraud", "cdc", "daily"}


def test_default_date_is_yesterday():
    from datetime import date, timedelta

    assert Options(output="x").day == (date.today() - timedelta(days=1)).isoformat()


def test_merge_reads_the_touched_partitions(spark, rows):
    path = work_dir(spark, "t")
    keys = ["order_date", "category"]
    first = days(spark, *[(f"2024-01-0{d}", c, 1.0) for d in (1, 2, 3) for c in "ab"])
    tables.write_daily(first, path)
    tables.write_daily(days(spark, ("2024-01-01", "a", 5.0), ("2024-01-03", "c", 6.0)), path, mode="merge", keys=keys)
    assert read(spark, path, first, rows) == [
        ("2024-01-01", "a", 5.0), ("2024-01-01", "b", 1.0), ("2024-01-02", "a", 1.0), ("2024-01-02", "b", 1.0),
        ("2024-01-03", "a", 1.0), ("2024-01-03", "b", 1.0), ("2024-01-03", "c", 6.0)]
    tables.write_daily(first.limit(0), path, mode="merge", keys=keys)
    assert len(read(spark, path, first, rows)) == 7


def test_a_day_without_rows_is_cleared(spark, rows):
    path = work_dir(spark, "t")
    first = days(spark, ("2024-01-01", "a", 1.0), ("2024-01-02", "a", 2.0))
    tables.replace_day(first.limit(0), path, "2024-01-02")
    assert read(spark, path, first, rows) == []
    tables.write_daily(first, path)
    tables.replace_day(first.limit(0), path, "2024-01-02")
    assert read(spark, path, first, rows) == [("2024-01-01", "a", 1.0)]


def test_daily_job_again_without_delivered_orders(spark):
    folder = work_dir(spark, "job")
    row = ("o", "u", "2024-01-17", "c", "s", 10.0, 1, "x", "DELIVERED")
    options = Options(output=f"{folder}/out", input=f"{folder}/in", date="2024-01-17")
    for status, failed in (("DELIVERED", []), ("CANCELLED", ["row_count", "row_count"])):
        lines = spark.createDataFrame([(*row[:-1], status)], BATCH_ORDER)
        lines.write.mode("overwrite").partitionBy("order_date").parquet(f"{folder}/in")
        assert [r["check_name"] for r in run_job(spark, options, "daily").collect()] == failed
    [f] = [r for r in spark.read.parquet(f"{folder}/out/daily_order_funnel").collect()]
    assert f["status"] == "CANCELLED"
