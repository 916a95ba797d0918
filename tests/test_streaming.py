import random

import pytest
from pyspark.sql import functions as F

from basketry.functions.times import event_time
from basketry.operators import changes, revenue
from basketry.session import work_dir
from basketry.streaming import jobs
from basketry.streaming.runner import Counters, StreamRun, stream_settings
from basketry.streaming.sync import SyncedTable

T0 = 1705572000000
ORDER = ("order_id string, user_id string, order_status string, total_amount double, timestamp bigint, "
         "shipping_address_region string, is_first_order boolean, "
         "items array<struct<category:string,total_price:double>>")


def order(i, ms, user="u", status="CREATED", amount=10.0, region="r", first=False, items=()):
    return (f"o{i}", user, status, amount, T0 + ms, region, first, list(items))


ORDERS = [
    order(1, 0, user="a", amount=10.25, first=True, items=[("x", 4.0), ("y", 6.25)]),
    order(2, 5_000, user="a", amount=None, region=None, first=None, items=[("x", 1.0), (None, 2.0), ("z", None)]),
    order(3, 59_999, user=None, status="PAYMENT_COMPLETED", amount=0.1, region="q"),
    order(4, 30_000, user="b", status="SHIPPED", amount=1000.0),
    order(5, 60_000, user="b", amount=-1.005),
]


def metrics(df):
    return {int(r["window_start"].timestamp() * 1000) - T0: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("form", ["batch", "stream"])
def test_revenue_metrics(spark, form):
    static = spark.createDataFrame(ORDERS + [order(9, 900_000, user="end")], ORDER)
    if form == "batch":
        got = metrics(revenue.revenue_metrics(event_time(static)))
    else:
        run = StreamRun.new(spark, "revenue-test")
        static.coalesce(1).write.parquet(f"{run.folder}/in")
        stream = jobs.revenue_stream(spark.readStream.schema(ORDER).parquet(f"{run.folder}/in"))
        run.drain(stream)
        got = metrics(run.read(stream))
    m = got[0]
    assert (m["gmv"], m["order_count"], m["average_order_value"]) == (10.35, 3, 3.45)
    assert (m["unique_users"], m["first_time_orders"]) == (2, 1)  # the missing user counts as one
    assert m["revenue_by_category"] == {"x": 5.0, "y": 6.25} and m["orders_by_region"] == {"r": 1, "q": 1}
    assert (m["first_event_ts"].timestamp() * 1000, m["last_event_ts"].timestamp() * 1000) == (T0, T0 + 59_999)
    assert got[60_000]["average_order_value"] == -1.0  # halves go up
    assert set(got) == ({0, 60_000, 900_000} if form == "batch" else {0, 60_000})


def test_scalars_agree_with_the_full_row(spark, rows):
    static = event_time(spark.createDataFrame(ORDERS, ORDER))
    full = revenue.revenue_metrics(static).drop("revenue_by_category", "orders_by_region")
    assert rows(revenue.revenue_windows(static), *full.columns) == rows(full)


def test_late_rows_are_counted_and_dropped(spark):
    run = StreamRun.new(spark, "late-rows-test")
    path = f"{run.folder}/in"
    stream = None
    progress = []
    for batch in ([order(1, 0), order(2, 600_000)], [order(3, 1_000)], [order(4, 3_600_000)]):
        spark.createDataFrame(batch, ORDER).coalesce(1).write.mode("append").parquet(path)
        stream = jobs.revenue_stream(spark.readStream.schema(ORDER).parquet(path))
        progress.append(run.drain(stream))
    dropped = [sum(op["numRowsDroppedByWatermark"] for p in ps for op in p["stateOperators"]) for ps in progress]
    assert dropped[1] > 0 and dropped[0] == dropped[2] == 0
    assert sorted(r["order_count"] for r in run.read(stream).collect()) == [1, 1]


def test_counters_listen(spark):
    counters = Counters()
    spark.streams.addListener(counters)
    try:
        run = StreamRun.new(spark, "listen-test")
        spark.createDataFrame(ORDERS, ORDER).coalesce(1).write.parquet(f"{run.folder}/in")
        stream = jobs.revenue_stream(spark.readStream.schema(ORDER).parquet(f"{run.folder}/in"))
        with stream_settings(spark):
            q = (stream.writeStream.queryName("counted").format("parquet").option("path", run.table)
                 .option("checkpointLocation", run.checkpoint).trigger(availableNow=True).start())
            q.awaitTermination()
        for _ in range(50):
            if counters.totals["counted", "input_rows"]:
                break
            __import__("time").sleep(0.1)
        assert counters.totals["counted", "input_rows"] == len(ORDERS) and not counters.failed
    finally:
        spark.streams.removeListener(counters)


def test_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    with stream_settings(spark):
        assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


LOG = "k int, v string, ts bigint, __deleted boolean"


def test_synced_table_equals_replay_of_the_log(spark, rows):
    rng = random.Random(3)
    log = [(rng.randrange(12), f"v{ts}", ts, rng.random() < 0.25) for ts in range(120)]
    arrival = sorted(log, key=lambda r: r[2] + rng.randrange(0, 30))  # versions out of order
    table = SyncedTable(work_dir(spark, "sync"), LOG, ("k",), ("ts",), compact_every=3)
    assert table.read(spark).count() == 0
    for batch_id in range(4):
        part = spark.createDataFrame(arrival[batch_id * 30:(batch_id + 1) * 30], LOG)
        table.write_batch(part, batch_id)
        if batch_id == 2:
            table.write_batch(part, batch_id)  # the batch runs again after a failure
    want = changes.current_state(spark.createDataFrame(log, LOG), ["k"], ["ts"])
    assert rows(table.read(spark), "k", "v") == rows(want, "k", "v")


def test_synced_table_does_not_grow_with_batches(spark):
    table = SyncedTable(work_dir(spark, "sync"), LOG, ("k",), ("ts",), compact_every=3)
    for batch_id in range(13):
        table.write_batch(spark.createDataFrame([(batch_id % 2, str(batch_id), batch_id, False)], LOG), batch_id)
        kinds = [f.split("/")[-2:] for f in table.live(spark)]
        assert len(kinds) <= 3 and sum(k == "bases" for k, _ in kinds) <= 1
        scanned = {f.rsplit("/", 1)[0].split("://")[-1] for f in table.read(spark).inputFiles()}
        assert {"/".join(f.split("/")[-2:]) for f in scanned} == {"/".join(k) for k in kinds}
    assert len(table._finished(spark, "bases")) <= 2 and len(table._finished(spark, "deltas")) <= 6
    assert sorted(r["v"] for r in table.read(spark).collect()) == ["11", "12"]


def test_work_dir_is_shared():
    settings = {"spark.checkpoint.dir": "hdfs://a/ck/", "spark.sql.warehouse.dir": "hdfs://a/wh"}

    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return settings.get(key, default)

    assert work_dir(Session(), "x").startswith("hdfs://a/ck/x-")
    del settings["spark.checkpoint.dir"]
    assert work_dir(Session(), "x").startswith("hdfs://a/wh/x-")
