import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from basketry import files
from basketry.operators import changes, quality, serving
from basketry.schemas import CONTRACTS
from basketry.session import work_dir
from basketry.sources import feeds, messages, tables

FLAT = "product_id int, sku string, price double, __op string, __table string, __source_ts_ms bigint, __deleted boolean"


def log(spark, *rows):
    data = [(k, f"s{k}", p, op, "products", ts, op == "d") for k, p, op, ts in rows]
    return spark.createDataFrame(data, FLAT)


def test_current_state(spark, rows):
    df = log(spark, (1, 10.0, "c", 1), (1, 12.0, "u", 5), (2, 3.0, "c", 2), (2, 3.0, "d", 9), (3, 4.0, "u", 4),
             (3, 4.5, "u", 3))
    snapshot = spark.createDataFrame([(3, "s3", 1.0), (4, "s4", 8.0)], "product_id int, sku string, price double")
    state = changes.current_state(changes.with_snapshot(snapshot, df), ["product_id"], ["__source_ts_ms"])
    assert rows(state, "product_id", "price") == [(1, 12.0), (3, 4.0), (4, 8.0)]


def test_row_comes_back_after_delete(spark, rows):
    df = log(spark, (1, 10.0, "c", 1), (1, 10.0, "d", 2), (1, 11.0, "c", 3))
    assert rows(changes.current_state(df, ["product_id"], ["__source_ts_ms"]), "price") == [(11.0,)]


def test_price_changes_skip_equal_prices(spark, rows):
    df = log(spark, (1, 10.0, "r", 0), (1, 10.0, "u", 1), (1, 15.0, "u", 2), (1, 15.0, "d", 3), (2, 5.0, "c", 0))
    assert rows(changes.price_changes(df)) == [(1, 2, 10.0, 15.0, 5.0, 50.0)]


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_price_changes_against_brute_force(spark, rows, width):
    rng = random.Random(width)
    data = [(rng.choice([1, 1, 1, 2]), float(rng.choice([10, 20, 30])), "u", ts) for ts in range(120)]
    want, last = [], {}
    for k, p, _, ts in data:
        if last.get(k, p) != p:
            want.append((k, ts, last[k], p))
        last[k] = p
    out = changes.price_changes(log(spark, *data), slice_width=timedelta(milliseconds=width))
    assert rows(out, "product_id", "changed_ms", "previous_price", "new_price") == sorted(want, key=repr)


@pytest.mark.parametrize("width", [1, 10, 10_000])
def test_running_stock_against_brute_force(spark, rows, width):
    rng = random.Random(width)
    moves = [(i, rng.choice([1, 1, 2, None]), rng.choice(["IN", "OUT", "ADJUSTMENT", "LOST"]),
              rng.choice([None, *range(-5, 50)]), rng.randrange(0, 300)) for i in range(200)]
    want, level = [], {}
    for i, k, kind, q, ts in sorted(moves, key=lambda m: (m[4], m[0])):
        level[k] = level.get(k, 0) + {"OUT": -1, "LOST": 0}.get(kind, 1) * (q or 0)
        want.append((i, level[k]))
    df = spark.createDataFrame(moves, "movement_id int, product_id int, movement_type string, quantity bigint, "
                                      "timestamp bigint")
    out = changes.running_stock(df, ["movement_id"], timedelta(milliseconds=width))
    assert rows(out, "movement_id", "stock") == sorted(want, key=repr)


def test_latest_inventory_keeps_known_values(spark, rows):
    events = [("e1", "P", 5, None, 1), ("e2", "P", None, 9.0, 2), ("e3", "P", 7, None, 3), ("e4", "P", None, None, 4)]
    df = spark.createDataFrame(events, "event_id string, product_id string, new_stock int, new_price double, "
                                       "timestamp bigint")
    assert rows(changes.latest_inventory(df)) == [("P", 7, 9.0, 4)]


def test_unwrap(spark, rows):
    from pyspark.sql import types as T

    lines = ['{"before":null,"after":{"product_id":1,"price":2.5},"op":"c","source":{"table":"products","ts_ms":7}}',
             '{"before":{"product_id":1,"price":2.5},"after":null,"op":"d","source":{"table":"products","ts_ms":8}}', None]
    row = T.StructType([T.StructField("product_id", T.IntegerType()), T.StructField("price", T.DoubleType())])
    out = messages.unwrap(spark.createDataFrame([(v,) for v in lines], "value string"), row)
    assert rows(out) == [(1, 2.5, "c", "products", 7, False), (1, 2.5, "d", "products", 8, True)]


def test_large_orders_keep_every_item_and_count_once(spark, rows):
    lines = spark.range(1000).selectExpr(
        "if(id < 700, 'big', concat('o', id)) as order_id", "cast(id as int) as line_number",
        "cast(id as string) as product_id", "'n' as product_name", "'c' as category", "1 as quantity",
        "cast(id as double) as total_price")
    orders = lines.select("order_id").distinct().union(spark.sql("select 'empty'"))
    out = feeds.order_events(orders, lines)
    assert out.filter("order_id = 'big'").select("item.line_number").distinct().count() == 700
    assert out.count() == 1001 and rows(out.filter("item is null"), "order_id") == [("empty",)]


def test_contract(spark, rows):
    df = spark.createDataFrame([("e1", "p", "STOCK_UPDATE", "w", 1), ("e2", None, "NOPE", "w", 2), ("e3", "p", None, "w", 3)],
                               "event_id string, product_id string, event_type string, warehouse_id string, "
                               "timestamp bigint")
    out = quality.contract_checks(df, "inventory", CONTRACTS["inventory"])
    assert rows(out.filter("not passed"), "check_name", "value") == [
        ("allowed:event_type", 1), ("required:event_type", 1), ("required:product_id", 1)]
    short = quality.contract_checks(df.drop("warehouse_id"), "inventory", CONTRACTS["inventory"])
    assert rows(short.filter("check_name = 'required:warehouse_id'"), "value") == [(3,)]


ALERTS = "alert_id string, user_id string, detected_at timestamp"


def test_serving_limits(spark):
    rows = spark.range(130).selectExpr(
        "concat('a', id) as alert_id", "if(id % 2 = 0, 'u', 'v') as user_id", "timestamp_seconds(id) as detected_at",
        "if(id < 60, '1', '2') as day")
    path = work_dir(spark, "alerts")
    rows.write.partitionBy("day").parquet(path)
    alerts = serving.Stored(spark, path, ALERTS, "day", "alert_id")
    top = serving.latest_alerts(alerts).collect()
    assert len(top) == 100 and top[0]["alert_id"] == "a129"
    mine = serving.alerts_by_user(alerts, "u").collect()
    assert len(mine) == 50 and mine[0]["alert_id"] == "a128" and {r["user_id"] for r in mine} == {"u"}
    assert serving.alerts_by_user(alerts, "nobody").count() == 0
    assert alerts.newest(70).count() == 70 and alerts.newest(71).count() == 130
    empty = serving.Stored(spark, work_dir(spark, "none"), ALERTS, "day", "alert_id")
    assert serving.latest_alerts(empty).count() == 0 and serving.alerts_by_user(empty, "u").count() == 0


def test_serving_reads_little(spark):
    path = work_dir(spark, "alerts")
    rows = spark.range(40).selectExpr("if(id = 7, null, concat('a', id)) as alert_id", "concat('u', id % 4) as user_id",
                                      "timestamp_seconds(id * 8000) as detected_at")
    tables.write_alerts(rows, path)
    stored = serving.Stored(spark, path, ALERTS, "day", "alert_id")
    assert stored.rows().count() == 39 and stored.nameless() == 1
    newest = serving.latest_alerts(stored, 5)
    assert {f.split("/")[-2] for f in newest.inputFiles()} == {f"day={stored.folders()[0].split('=')[1]}"}
    assert len(stored.folders()) == 4
    plan = serving.alerts_by_user(stored, "u1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,u1)" in plan


def test_a_damaged_file_is_noted_and_left_out(spark):
    path = work_dir(spark, "alerts")
    rows = spark.range(4000).selectExpr("concat('a', id) as alert_id", "concat('u', id % 50) as user_id",
                                        "timestamp_seconds(id * 50) as detected_at")
    tables.write_alerts(rows, path)
    stored = serving.Stored(spark, path, ALERTS, "day", "alert_id")
    whole = stored.rows().groupBy("day").count().collect()
    [file] = [f for f in files.files(spark, path) if stored.folders()[-1] in f]
    local = file.removeprefix("file:")
    damaged = bytearray(open(local, "rb").read())
    for i in range(50, 900):  # inside the data: the footer is sound
        damaged[i] ^= 0x5A
    os.remove(os.path.join(os.path.dirname(local), f".{os.path.basename(local)}.crc"))
    open(local, "wb").write(bytes(damaged))
    left = sum(r["count"] for r in whole if f"day={r['day']}" != stored.folders()[-1])
    for _ in range(2):
        assert stored.rows().count() == left
    [noted] = stored.unreadable().collect()
    assert noted["file"].endswith(os.path.basename(local)) and noted["reason"] and noted["found_at"]
    assert serving.latest_alerts(stored, 10).count() == 10


def test_reading_one_user_skips_other_rows(spark):
    path = work_dir(spark, "alerts")
    rows = spark.range(0, 300_000, 1, 1).selectExpr(
        "concat('a', id) as alert_id", "sha1(cast(id % 3000 as string)) as user_id", "timestamp_seconds(id) as detected_at")
    with_filter = [f"{path}/sorted", f"{path}/plain"]
    tables.write_alerts(rows, with_filter[0])
    rows.withColumn("day", F.lit("1")).write.partitionBy("day").parquet(with_filter[1])
    user = rows.first()["user_id"]
    scanned = []
    for place in with_filter:
        found = serving.Stored(spark, place, ALERTS, "day", "alert_id").rows(where=F.col("user_id") == user)
        assert found.count() == 100
        found.collect()
        plan = found._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves()
        scanned.append(leaves.apply(0).metrics().apply("numOutputRows").value())
    assert scanned[0] < scanned[1] / 3  # one page of each of four small files
