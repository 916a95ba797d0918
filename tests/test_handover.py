"""What streams hand on: once per batch, whole, late rows apart, also when a batch runs again."""

import json
import os
import random
import subprocess
import sys
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import files, schemas
from basketry.functions.times import event_time
from basketry.operators import changes, fraud
from basketry.plans.jobs import Options, product_table, run_job, snapshot_rows
from basketry.session import work_dir
from basketry.streaming import jobs
from basketry.streaming.handover import LATE, ON_TIME, REJECTS, EventClock, HandOver, late_schema, split_by_time
from basketry.streaming.runner import StreamRun, forget_last_batch, stream_settings
from basketry.streaming.seen import SeenUsers
from basketry.streaming.state import open_sessions, seen_users, state_operators
from basketry.streaming.stock import RunningStock

T0 = 1705572000000
ROW = T.StructType([T.StructField("id", T.StringType()), T.StructField("timestamp", T.LongType())])
ORDER = ("order_id string, user_id string, order_status string, total_amount double, timestamp bigint, "
         "shipping_address_region string")


def order(i, ms, user="u", amount=10.0, status="CREATED"):
    return (i, user, status, amount, T0 + ms, "r")


def wire(spark, folder, topic, rows):
    lines = [json.dumps(r) for r in rows]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(
        f"{folder}/topics/{topic}")


def message(i, ms, user="u", amount=10.0, first=False):
    return {"order_id": i, "user_id": user, "order_status": "CREATED", "total_amount": amount, "timestamp": T0 + ms,
            "is_first_order": first, "items": []}


# --- the hand-over itself


def test_a_batch_that_runs_again_writes_nothing_new(spark):
    over = HandOver(work_dir(spark, "over"))
    rows = spark.createDataFrame([("a", 1), ("b", 2)], ROW)
    over.write(rows, "valid", 0)
    before = files.files(spark, over.table("valid"))
    over.write(rows, "valid", 0)
    assert files.files(spark, over.table("valid")) == before
    over.write(rows.limit(0), "valid", 1)
    over.write(rows, "valid", 2)
    assert over.read(spark, "valid", ROW).count() == 4


def test_a_batch_cut_off_while_writing_is_not_seen(spark):
    over = HandOver(work_dir(spark, "over"))
    rows = spark.createDataFrame([("a", 1)], ROW)
    rows.write.parquet(f"{over.folder}/_aside/valid-0")  # stopped before the renaming
    assert over.read(spark, "valid", ROW).count() == 0
    over.write(rows, "valid", 0)
    assert over.read(spark, "valid", ROW).count() == 1


def test_followers_read_each_batch_once(spark):
    over = HandOver(work_dir(spark, "over"))
    run = StreamRun.new(spark, "follow")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], ROW)
    for batch_id in (0, 0, 1, 1):
        over.write(rows, "valid", batch_id)
        run.drain(over.follow(spark, "valid", ROW))
    assert spark.read.parquet(run.table).count() == 4


@pytest.mark.parametrize("times", [1, 2])
def test_no_false_alert_after_a_retry(spark, times):
    """Two orders of a user, in a batch that is written ``times`` times with the rules running after each."""
    run = StreamRun.new(spark, "retry")
    write = jobs.dead_letter_split(run.folder)
    lines = [json.dumps(message(f"o{i}", 1000 * i)) for i in (1, 2)]
    batch = spark.createDataFrame([(x,) for x in lines], "value string").withColumn(
        "received_at", F.current_timestamp())
    over = HandOver(run.folder)
    closing = spark.createDataFrame([(json.dumps(message("end", 10**7, user="z")),)], "value string").withColumn(
        "received_at", F.current_timestamp())
    for part, number in [(batch, 0)] * times + [(closing, 1)]:
        write(part, number)
        run.drain(jobs.rapid_order_stream(over.follow(spark, "valid", schemas.ORDER)))
    assert spark.read.parquet(run.table).count() == 0


def test_an_order_that_arrives_again_counts_once(spark):
    run = StreamRun.new(spark, "again")
    path = f"{run.folder}/in"
    for orders in ([order("o1", 0), order("o2", 1000)], [order("o2", 1000)], [order("end", 10**7, user="z")]):
        spark.createDataFrame(orders, ORDER).coalesce(1).write.mode("append").parquet(path)
        run.drain(jobs.rapid_order_stream(spark.readStream.schema(ORDER).parquet(path)))
    assert spark.read.parquet(run.table).count() == 0


def test_fraud_job_after_losing_its_last_commits(spark):
    folder = work_dir(spark, "job")
    options = Options(output=f"{folder}/out", topics=f"{folder}/topics", drain=True, threshold=5000.0)
    wire(spark, folder, "transactions.orders", [message("o1", 0), message("o2", 1000), message("big", 0, "v", 9000.0)])
    run_job(spark, options, "fraud")
    forget_last_batch(spark, f"{folder}/out/checkpoints")
    wire(spark, folder, "transactions.orders", [message("end", 10**7, "z"), {"order_id": "x"}])
    run_job(spark, options, "fraud")
    run_job(spark, options, "fraud")
    alerts = spark.read.parquet(f"{folder}/out/tables/fraud_alerts")
    assert [r["order_id"] for r in alerts.collect()] == ["big"]
    told = spark.read.text(f"{folder}/out/topics/alerts.fraud")
    assert told.count() == 1
    assert spark.read.parquet(f"{folder}/out/tables/dead_letters").count() == 1
    assert spark.read.parquet(f"{folder}/out/tables/valid").count() == 4


# --- late rows


def split(spark, batches, delay=timedelta(seconds=10), again=()):
    over = HandOver(work_dir(spark, "split"))
    write = split_by_time(over, lambda b: b, delay, F.col("id").isNotNull() & F.col("timestamp").isNotNull())
    for number, rows in enumerate(batches):
        for _ in range(2 if number in again else 1):
            write(spark.createDataFrame(rows, ROW), number)
    kept = {kind: over.read(spark, kind, late_schema(ROW) if kind == LATE else ROW) for kind in (ON_TIME, LATE, REJECTS)}
    return {kind: sorted((tuple(r)[:-1] for r in rows.collect()), key=repr) for kind, rows in kept.items()}


@pytest.mark.parametrize("again", [(), (0, 1, 2)])
def test_every_row_is_on_time_late_or_rejected(spark, again):
    batches = [[("a", 100_000), ("b", 0)], [("c", 89_999), ("d", 90_000), (None, 5), ("e", None)], [("f", 200_000)],
               [("g", 189_999), ("h", 190_000), ("i", 300_000)]]
    got = split(spark, batches, again=again)
    assert got[ON_TIME] == [("a", 100_000), ("b", 0), ("d", 90_000), ("f", 200_000), ("h", 190_000), ("i", 300_000)]
    assert got[LATE] == [("c", 89_999, 1), ("g", 189_999, 1)]
    assert got[REJECTS] == [("e", None), (None, 5)]


def test_a_late_row_does_not_move_the_clock(spark):
    clock = EventClock(work_dir(spark, "clock"))
    assert clock.before(spark, 0) is None
    for number, latest in enumerate([5, 9, 9]):
        clock.set(spark, number, latest)
    assert [clock.before(spark, n) for n in (2, 3, 9)] == [9, 9, 9]
    assert len(files.names(spark, clock.folder)) == 2


def test_what_is_on_time_is_never_dropped_behind(spark):
    rng = random.Random(4)
    orders = [order(f"o{i}", i * 700 - rng.randrange(0, 25_000), user=f"u{i % 9}") for i in range(400)]
    run = StreamRun.new(spark, "ahead")
    over = HandOver(run.folder)
    schema = spark.createDataFrame([], ORDER).schema
    write = split_by_time(over, lambda b: b, jobs.ORDER_DELAY, F.col("timestamp").isNotNull())
    dropped = 0
    for number in range(8):
        write(spark.createDataFrame(orders[50 * number:50 * number + 50], ORDER), number)
        counted = jobs.watermarked(over.follow(spark, ON_TIME, schema), jobs.ORDER_DELAY).groupBy(
            F.window("event_time", "1 second")).count()
        for p in run.drain(counted.select("window.start", "count")):
            dropped += sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"])
    late = over.read(spark, LATE, late_schema(schema)).count()
    assert dropped == 0 and late > 0
    assert over.read(spark, ON_TIME, schema).count() + late == len(orders)


# --- snapshot, seen users, stock, state

LOG = "product_id int, sku string, name string, price double, __op string, __table string, __source_ts_ms bigint, __deleted boolean"


def version(k, ts, price, op="u"):
    return (k, f"s{k}", f"n{k}", price, op, "products", ts, op == "d")


def test_changes_behind_the_snapshot_do_not_count(spark, rows):
    synced = product_table(work_dir(spark, "snap"), compact_every=2)
    snapshot = spark.createDataFrame([(1, "s1", "n1", 10.0), (2, "s2", "n2", 20.0)],
                                     "product_id int, sku string, name string, price double")
    synced.load_snapshot(snapshot_rows(snapshot), 100)
    assert rows(synced.read(spark), "product_id", "price") == [(1, 10.0), (2, 20.0)]
    old = [version(1, 99, 1.0), version(3, 50, 3.0, "c"), version(2, 100, 2.0, "d")]
    new = [version(2, 101, 21.0), version(4, 130, 4.0, "c"), version(1, 140, 0.0, "d")]
    for number, part in enumerate([old, new, old, [version(4, 120, 9.0)]]):
        synced.write_batch(spark.createDataFrame(part, LOG), number)
        synced.load_snapshot(snapshot_rows(snapshot), 100)  # a job that starts again
    assert rows(synced.read(spark), "product_id", "price") == [(2, 21.0), (4, 4.0)]


def test_change_job_from_a_snapshot_on(spark, rows):
    folder = work_dir(spark, "job")
    spark.createDataFrame([(1, "s1", "n1", 10.0), (2, "s2", "n2", 20.0)],
                          "product_id int, sku string, name string, price double").write.parquet(f"{folder}/snapshot")
    options = Options(output=f"{folder}/out", topics=f"{folder}/topics", drain=True, snapshot=f"{folder}/snapshot", fence=100)
    wire(spark, folder, "cdc.public.orders", [{"order_id": 1, "__op": "c"}])
    fields = ("product_id", "sku", "name", "price", "__op", "__table", "__source_ts_ms", "__deleted")
    for part in ([version(3, 50, 3.0, "c"), version(1, 99, 1.0)], [version(2, 150, 25.0), version(1, 160, 0.0, "d")]):
        wire(spark, folder, "cdc.public.products", [dict(zip(fields, v)) for v in part])
        run_job(spark, options, "cdc")
    assert rows(product_table(f"{folder}/out/tables").read(spark), "product_id", "price") == [(2, 25.0)]


def test_session_job_keeps_late_and_unusable_clicks(spark):
    folder = work_dir(spark, "job")
    options = Options(output=f"{folder}/out", topics=f"{folder}/topics", drain=True)

    def click(i, user, ms):
        return {"event_id": i, "user_id": user, "session_id": "s", "event_type": "PAGE_VIEW", "timestamp": ms,
                "device_type": "d", "geo_region": "r"}

    for part in ([click("a", "u", T0), click("b", "v", T0 + 7_200_000)],
                 [click("late", "u", T0 + 5), click("none", None, T0), click("c", "v", T0 + 20_000_000)]):
        wire(spark, folder, "clickstream.events", part)
        run_job(spark, options, "sessions")
    over = HandOver(f"{folder}/out/tables/clicks")
    late = over.read(spark, LATE, late_schema(schemas.CLICKSTREAM)).collect()
    assert [(r["event_id"], r["lateness_ms"]) for r in late] == [("late", 7_200_000 - 30_000 - 5)]
    assert [r["event_id"] for r in over.read(spark, REJECTS, schemas.CLICKSTREAM).collect()] == ["none"]
    sessions = spark.read.parquet(f"{folder}/out/tables/user_sessions").collect()
    assert sorted((r["user_id"], r["page_views"]) for r in sessions) == [("u", 1), ("v", 1)]


def test_first_orders_with_users_in_a_table(spark):
    rng = random.Random(8)
    orders = [order(f"o{i:03d}", i, user=rng.choice(["a", "b", "c", None, *map(str, range(40))]),
                    amount=rng.choice([1.0, 6000.0, None])) for i in range(200)]
    seen = SeenUsers(work_dir(spark, "seen"), 5000.0, compact_every=2)
    for number in range(4):
        part = spark.createDataFrame(orders[number * 50:number * 50 + 50], ORDER)
        for _ in range(1 + number % 2):  # some batches run again
            seen.write_batch(part, number)
    want = fraud.high_value_first_order(event_time(spark.createDataFrame(orders, ORDER)), 5000.0)
    ids = lambda df: sorted(r["alert_id"] for r in df.collect())
    assert ids(seen.alerts(spark)) == ids(want) and len(ids(want)) > 3
    users = {o[1] for o in orders if o[1]}
    assert {r["user_id"] for r in seen.users.read(spark).collect()} == users


MOVES = "product_id bigint, movement_type string, quantity bigint, timestamp bigint, n int"


def test_running_stock_of_a_stream_equals_the_batch_form(spark, rows):
    rng = random.Random(6)
    moves = [(rng.choice([1, 1, 1, 2, None]), rng.choice(["IN", "OUT", "ADJUSTMENT"]), rng.randrange(50),
              T0 + 1000 * i + rng.randrange(0, 5000), i) for i in range(120)]
    schema = spark.createDataFrame([], MOVES).schema
    stock = RunningStock(work_dir(spark, "stock"), schema, ("n",), timedelta(seconds=10))
    for number in range(4):
        part = spark.createDataFrame(moves[number * 30:number * 30 + 30], MOVES)
        for _ in range(1 + number % 2):
            stock.write_batch(part, number)
    late = (1, "IN", 5, T0, 999)
    stock.write_batch(spark.createDataFrame([late], MOVES), 4)
    stock.close(spark, 5)
    want = changes.running_stock(spark.createDataFrame(moves, MOVES), ["n"])
    assert rows(stock.read(spark), "n", "product_id", "delta", "stock") == rows(want, "n", "product_id", "delta", "stock")
    assert [r["n"] for r in stock.out.read(spark, LATE, schema).collect()] == [999]


@pytest.mark.parametrize("whole,most", [(0, 9), (15, 9), (15, 0), (1000, 9)])
def test_busy_products_spread_over_slices_and_others_stay_whole(spark, rows, monkeypatch, whole, most):
    rng = random.Random(7)
    moves = [(rng.choice([1, 1, 1, 2, 3, None, None]), rng.choice(["IN", "OUT", "ADJUSTMENT"]), rng.randrange(50),
              T0 + 40_000_000 * i, i) for i in range(60)]
    schema = spark.createDataFrame([], MOVES).schema
    monkeypatch.setattr("basketry.streaming.stock.WHOLE_ROWS", whole)
    monkeypatch.setattr("basketry.streaming.stock.MOST_BUSY", most)
    stock = RunningStock(work_dir(spark, "stock"), schema, ("n",), timedelta(seconds=10))
    for number in range(2):
        stock.write_batch(spark.createDataFrame(moves[number * 30:number * 30 + 30], MOVES), number)
    stock.close(spark, 2)
    want = changes.running_stock(spark.createDataFrame(moves, MOVES), ["n"])
    assert rows(stock.read(spark), "n", "product_id", "delta", "stock") == rows(want, "n", "product_id", "delta", "stock")


def test_movements_of_other_products_are_shuffled_once(spark):
    moves = spark.createDataFrame([(1, "IN", 5, T0, 1), (None, "OUT", 2, T0, 2), (1, "IN", 1, None, 3)], MOVES)
    levels = spark.createDataFrame([(1, 10)], "product_id bigint, stock bigint")
    out = changes.running_stock_from(levels, moves, ["n"], busy=[])
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and plan.count("Window") == 1
    assert sorted((r["n"], r["stock"]) for r in out.collect()) == [(1, 15), (2, -2)]


def test_state_can_be_read(spark):
    clicks = [(f"e{i}", user, f"s{i}", "PAGE_VIEW", T0 + ms, "d", "r")
              for i, (user, ms) in enumerate([("a", 0), ("a", 60_000), ("b", 9_000_000), ("b", 9_050_000)])]
    ddl = "event_id string, user_id string, session_id string, event_type string, timestamp bigint, device_type string, geo_region string"
    frame = spark.createDataFrame(clicks, ddl).withColumns(
        {"category": F.lit(None).cast("string"), "price": F.lit(None).cast("double"), "quantity": F.lit(None).cast("int")})
    run = StreamRun.new(spark, "state")
    frame.coalesce(1).write.parquet(f"{run.folder}/in")
    run.drain(jobs.session_stream(spark.readStream.schema(frame.schema).parquet(f"{run.folder}/in")))
    [row] = open_sessions(spark, run.checkpoint, timedelta(minutes=30)).collect()
    assert (row["user_id"], row["session_start"].timestamp() * 1000 - T0) == ("b", 9_000_000)
    assert row["session_end"].timestamp() * 1000 - T0 == 9_050_000
    assert state_operators(spark, run.checkpoint).count() >= 1
    run = StreamRun.new(spark, "state")
    spark.createDataFrame([order("o1", 0, "a"), order("o2", 1, "b"), order("o3", 2, None)], ORDER).write.parquet(
        f"{run.folder}/in")
    run.drain(jobs.first_order_stream(spark.readStream.schema(ORDER).parquet(f"{run.folder}/in")))
    assert sorted(r["user_id"] for r in seen_users(spark, run.checkpoint).collect()) == ["a", "b"]


# --- the package in workers


def test_workers_find_the_package_from_any_folder(tmp_path):
    """A script elsewhere that only puts the package on its own path."""
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "elsewhere.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {top!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from basketry.session import ship

def inner(batches):
    import basketry.functions.times
    yield from batches

ship(spark)
print("rows", ship(spark).range(3).mapInArrow(inner, "id bigint").count(), len(spark.sparkContext._python_includes))
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 3 1" in done.stdout, done.stderr[-2000:]
