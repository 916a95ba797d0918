import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from basketry.functions import alerts as scoring
from basketry.functions.times import event_time
from basketry.operators import fraud
from basketry.streaming import jobs
from basketry.streaming.fraud import USER_GROUPS
from basketry.streaming.runner import StreamRun
from basketry.streaming.state import seen_users, stored_state

T0 = 1705572000000
SCHEMA = ("order_id string, user_id string, order_status string, total_amount double, timestamp bigint, "
          "shipping_address_region string")


def order(order_id, ms, user="USR-FRAUD", status="CREATED", amount=100.0, region="istanbul"):
    return (order_id, user, status, amount, T0 + ms, region)


def frame(spark, orders):
    return event_time(spark.createDataFrame(orders, SCHEMA))


def rapid(spark, orders, **kw):
    out = fraud.rapid_orders(frame(spark, orders), detected_at=F.col("event_time"), **kw)
    return sorted((r["order_id"], tuple(r["related_events"])) for r in out.collect())


def seconds(*offsets):
    return [order(f"ORD-R{i + 1}", int(s * 1000)) for i, s in enumerate(offsets)]


def test_three_quick_orders(spark):
    [row] = fraud.rapid_orders(frame(spark, seconds(0, 60, 120))).collect()
    assert (row["user_id"], row["order_id"], row["alert_type"], row["risk_score"]) == (
        "USR-FRAUD", "ORD-R3", "RAPID_ORDERS", 0.85)
    assert row["description"] == "User placed 3 orders within 5 minutes. First: ORD-R1, Last: ORD-R3"
    assert abs(row["detected_at"].timestamp() - datetime.now(timezone.utc).timestamp()) < 120


def test_four_quick_orders_give_two_alerts(spark):
    assert rapid(spark, seconds(0, 60, 120, 180)) == [
        ("ORD-R3", ("ORD-R1", "ORD-R2", "ORD-R3")), ("ORD-R4", ("ORD-R2", "ORD-R3", "ORD-R4")),
    ]


@pytest.mark.parametrize("third,hits", [(299.999, 1), (300, 0)])
def test_limit_is_strict(spark, third, hits):
    assert len(rapid(spark, seconds(0, 60, third))) == hits


def test_other_statuses_do_not_break_the_sequence(spark):
    orders = seconds(0, 60, 120) + [order("X", 30_000, status="SHIPPED")]
    assert [o for o, _ in rapid(spark, orders)] == ["ORD-R3"]


def test_minimum_amount_is_an_option(spark):
    orders = [order(f"o{i}", i * 1000, amount=a) for i, a in enumerate([6000.0, 10.0, 6000.0, 6000.0])]
    assert len(rapid(spark, orders)) == 2
    assert [o for o, _ in rapid(spark, orders, min_amount=5000.0)] == ["o3"]


def test_users_do_not_mix(spark):
    assert rapid(spark, [order(f"o{i}", i, user=f"u{i}") for i in range(3)]) == []


def brute_rapid(orders, within):
    hits = []
    for user in {o[1] for o in orders if o[1]}:
        mine = sorted((o[4], o[0]) for o in orders if o[1] == user and o[2] == "CREATED")
        hits += [(c[1], (a[1], b[1], c[1])) for a, b, c in zip(mine, mine[1:], mine[2:]) if c[0] - a[0] < within]
    return sorted(hits)


def random_orders(seed, n=300):
    rng = random.Random(seed)
    return [
        order(f"o{i:04d}", rng.randrange(0, 3600) * 500, user=rng.choice(["hot"] * 4 + ["a", "b", None]),
              status=rng.choice(["CREATED", "CREATED", "SHIPPED"]), amount=rng.choice([None, 10.0, 6000.0]),
              region=rng.choice([None, "x", "y", "z"]))
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_rapid_against_brute_force(spark, seed):
    orders = random_orders(seed)
    assert rapid(spark, orders) == brute_rapid(orders, 300_000)
    assert rapid(spark, orders, within=timedelta(seconds=7)) == brute_rapid(orders, 7_000)


def first(spark, orders, **kw):
    return fraud.high_value_first_order(frame(spark, orders), **kw).collect()


def test_high_first_order(spark):
    [row] = first(spark, [order("o1", 0, user="USR-NEW", amount=75000.0)])
    assert (row["alert_type"], row["risk_score"], row["order_id"]) == ("HIGH_VALUE_FIRST_ORDER", 0.75, "o1")
    assert row["description"] == "First order from user is high value: 75000.00 TRY (threshold: 5000.00)"


@pytest.mark.parametrize("amounts", [(500.0, 75000.0), (500.0,), (5000.0,), (None, 75000.0), (0.0,), (-5000.0,)])
def test_no_alert(spark, amounts):
    assert first(spark, [order(f"o{i}", i, amount=a) for i, a in enumerate(amounts)]) == []


def test_any_status_counts_as_first(spark):
    assert first(spark, [order("o0", 0, status="CANCELLED", amount=1.0), order("o1", 1, amount=9000.0)]) == []


def test_alert_ids_differ_and_repeat(spark):
    orders = seconds(0, 1, 2, 3)
    ids = [{r["alert_id"] for r in fraud.rapid_orders(frame(spark, orders)).collect()} for _ in range(2)]
    assert len(ids[0]) == 2 and ids[0] == ids[1]


@pytest.mark.parametrize("amount,is_first,score", [
    (0.0, True, 0.0), (-5000.0, False, 0.95), (10000.0, True, 0.15), (50000.0, True, 0.35), (60000.0, True, 0.4),
    (60000.0, False, 0.3), (100000.0, True, 0.6), (200000.0, True, 1.0), (1e9, False, 0.9),
])
def test_risk_score(spark, amount, is_first, score):
    row = spark.range(1).select(scoring.risk_score(F.lit(amount), F.lit(is_first)).alias("s")).first()
    assert row["s"] == pytest.approx(score)


def test_location_anomaly(spark, rows):
    orders = [order("o1", 0, region="a"), order("o2", 1, region="b"), order("o3", 2, region="b"),
              order("o4", 3, region="a"), order("o5", 4, region=None), order("o6", 5, region="c")]
    out = fraud.location_anomaly(frame(spark, orders))
    assert rows(out, "order_id", "risk_score") == [("o2", 0.65), ("o6", 0.65)]


def feed(spark, run, batches, make):
    """Deliver batches one after the other, each by its own run that continues from the checkpoint."""
    path = f"{run.folder}/orders"
    for orders in batches:
        spark.createDataFrame(orders, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        run.drain(make(spark.readStream.schema(SCHEMA).parquet(path)))
    return sorted((r["order_id"], tuple(r["related_events"])) for r in spark.read.parquet(run.table).collect())


def test_rapid_stream_equals_batch_with_disorder_and_restarts(spark):
    orders = random_orders(7)
    rng = random.Random(7)
    arrival = sorted(orders, key=lambda o: o[4] + rng.randrange(0, 9_000))  # less than the allowed 10 s
    third = len(arrival) // 3
    closing = [order("end", 4_000_000, user="closer")]
    batches = [arrival[:third], arrival[third:2 * third], arrival[2 * third:], closing]
    got = feed(spark, StreamRun.new(spark, "rapid-test"), batches, jobs.rapid_order_stream)
    assert got == brute_rapid(orders, 300_000)


def test_orders_of_any_status_move_the_watermark(spark):
    batches = [seconds(0, 60, 120), [order("x", 900_000, user="z", status="SHIPPED")]]
    got = feed(spark, StreamRun.new(spark, "status-test"), batches, jobs.rapid_order_stream)
    assert got == [("ORD-R3", ("ORD-R1", "ORD-R2", "ORD-R3"))]


def test_rapid_stream_drops_late_orders(spark):
    batches = [[order("a", 0), order("b", 1000)], [order("far", 3_600_000, user="other")], [order("late", 2000)],
               [order("end", 9_000_000, user="other")]]
    run = StreamRun.new(spark, "late-test")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{run.folder}/orders")
    path = f"{run.folder}/orders"
    for orders in batches:
        spark.createDataFrame(orders, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        run.drain(jobs.rapid_order_stream(spark.readStream.schema(SCHEMA).parquet(path)))
    assert run.read(fraud.rapid_orders(frame(spark, batches[0]))).count() == 0


def test_first_order_stream_goes_by_arrival(spark):
    batches = [
        [order("o1", 5000, user="u", amount=9000.0), order("o2", 6000, user="u", amount=1.0),
         order("p1", 10, user="v", amount=1.0)],
        [order("o0", 0, user="u", amount=1.0), order("p2", 20, user="v", amount=9000.0),
         order("w1", 0, user="w", amount=5000.01)],
    ]
    got = feed(spark, StreamRun.new(spark, "first-test"), batches, jobs.first_order_stream)
    assert got == [("o1", ("o1",)), ("w1", ("w1",))]


def test_alert_stream_is_the_union(spark):
    batches = [seconds(0, 60, 120) + [order("big", 0, user="new", amount=6000.0)], [order("end", 900_000, user="z")]]
    run = StreamRun.new(spark, "union-test")
    feed(spark, run, batches, jobs.alert_stream)
    types = sorted(r["alert_type"] for r in spark.read.parquet(run.table).collect())
    assert types == ["HIGH_VALUE_FIRST_ORDER", "RAPID_ORDERS"]


@pytest.mark.parametrize("make,name", [(jobs.rapid_order_stream, "orders"), (jobs.first_order_stream, "seen")])
def test_keys_of_the_state_do_not_grow_with_the_users(spark, make, name):
    orders = [order(f"o{i}", i * 100, user=f"u{i % 2000}", amount=9000.0) for i in range(6000)]
    run = StreamRun.new(spark, "keys-test")
    got = feed(spark, run, [orders], make)
    state = stored_state(spark, run.checkpoint, stateVarName=name)
    assert state.select("key").distinct().count() <= USER_GROUPS
    if name == "seen":
        assert len(got) == 2000 and seen_users(spark, run.checkpoint).distinct().count() == 2000


def test_users_of_a_group_do_not_mix(spark, monkeypatch):
    monkeypatch.setattr("basketry.streaming.fraud.USER_GROUPS", 1)
    orders = random_orders(11)
    got = feed(spark, StreamRun.new(spark, "group-test"), [orders, [order("end", 4_000_000, user="z")]], jobs.rapid_order_stream)
    assert got == brute_rapid(orders, 300_000)


def test_users_can_be_forgotten(spark):
    """With a time to live the query never runs out of batches, so it is stopped by hand."""
    from basketry.streaming.fraud import first_order_hits
    from basketry.streaming.runner import stream_settings

    run = StreamRun.new(spark, "ttl-test")
    path = f"{run.folder}/orders"
    spark.createDataFrame([order("o1", 0, amount=9000.0)], SCHEMA).write.parquet(path)
    hits = first_order_hits(spark.readStream.schema(SCHEMA).parquet(path), 5000.0, ttl=timedelta(days=365))
    with stream_settings(spark):
        query = (hits.writeStream.format("memory").queryName("ttl_hits").option("checkpointLocation", run.checkpoint)
                 .trigger(processingTime="1 second").start())
        try:
            deadline = time.time() + 60
            while not spark.table("ttl_hits").count() and time.time() < deadline:
                time.sleep(0.5)
        finally:
            query.stop()
    assert [r["order_id"] for r in spark.table("ttl_hits").collect()] == ["o1"]
