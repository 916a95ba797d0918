import random
from datetime import timedelta

import pytest

from basketry.operators import sessions
from basketry.schemas import CLICKSTREAM
from basketry.session import work_dir
from basketry.sources.topics import read_topic, to_wire
from basketry.sources import messages
from basketry.streaming import jobs
from basketry.streaming.runner import StreamRun

T0 = 1705572000000
MIN = 60_000


def click(event_type, ms, price=None, quantity=None, category=None, user="USR-001", event_id=None, device="mobile",
          session="SESS-001"):
    event_id = event_id or f"e{ms}-{event_type}"
    return (event_id, user, session, event_type, None, category, price, quantity, ms, device, "istanbul", None, None)


LOOSE = CLICKSTREAM.__class__.fromJson(CLICKSTREAM.jsonValue())
for f in LOOSE.fields:
    f.nullable = True


def run(spark, clicks, **kw):
    return [r.asDict() for r in sessions.session_metrics(spark.createDataFrame(clicks, LOOSE), **kw).collect()]


JOURNEY = [
    click("PAGE_VIEW", T0),
    click("PRODUCT_VIEW", T0 + 10_000, category="Elektronik", event_id="v1"),
    click("PRODUCT_VIEW", T0 + 10_000, category="Elektronik", event_id="v2"),
    click("ADD_TO_CART", T0 + 20_000),
    click("PURCHASE", T0 + 30_000, price=2499.0),
]


def test_journey(spark):
    [s] = run(spark, JOURNEY)
    counts = [s[c] for c in ("page_views", "product_views", "add_to_cart_count", "purchase_count")]
    assert counts == [1, 2, 1, 1]
    assert (s["total_revenue"], s["duration_seconds"]) == (2499.0, 30)
    assert (s["primary_category"], s["conversion_rate"]) == ("Elektronik", 0.5)


@pytest.mark.parametrize("event_type,counts", [
    ("PAGE_VIEW", (2, 0, 0, 0)), ("PRODUCT_VIEW", (0, 2, 0, 0)), ("ADD_TO_CART", (0, 0, 2, 0)),
    ("PURCHASE", (0, 0, 0, 2)), ("unknown_type", (0, 0, 0, 0)), ("page_view", (0, 0, 0, 0)),
    ("REMOVE_FROM_CART", (0, 0, 0, 0)),
])
def test_counters(spark, event_type, counts):
    [s] = run(spark, [click(event_type, T0), click(event_type, T0 + 1000)])
    assert (s["page_views"], s["product_views"], s["add_to_cart_count"], s["purchase_count"]) == counts
    assert s["duration_seconds"] == 1


def test_gap_of_exactly_thirty_minutes_joins(spark):
    [s] = run(spark, [click("PAGE_VIEW", T0), click("PAGE_VIEW", T0 + 30 * MIN)])
    assert s["duration_seconds"] == 1800


def test_one_millisecond_more_splits(spark):
    assert len(run(spark, [click("PAGE_VIEW", T0), click("PAGE_VIEW", T0 + 30 * MIN + 1)])) == 2


def test_bridging_event_merges(spark):
    halves = [click("PAGE_VIEW", T0), click("PAGE_VIEW", T0 + 50 * MIN)]
    assert len(run(spark, halves)) == 2
    assert len(run(spark, halves + [click("CHECKOUT_START", T0 + 25 * MIN)])) == 1


def test_null_price_counts_but_adds_nothing(spark):
    [s] = run(spark, [click("PURCHASE", T0, price=None, quantity=2)])
    assert (s["purchase_count"], s["total_revenue"]) == (1, 0.0)


def test_quantity_multiplies_and_defaults_to_one(spark):
    [s] = run(spark, [click("PURCHASE", T0, price=10.1, quantity=3), click("PURCHASE", T0 + 1, price=0.2)])
    assert s["total_revenue"] == 30.5


def test_category_tie_takes_lowest_name(spark):
    [s] = run(spark, [click("PRODUCT_VIEW", T0, category="b"), click("PRODUCT_VIEW", T0 + 1, category="a")])
    assert s["primary_category"] == "a"


def test_opening_event_gives_device(spark):
    [s] = run(spark, [click("PAGE_VIEW", T0 + 5, device="desktop"), click("PAGE_VIEW", T0, device="tablet")])
    assert s["device_type"] == "tablet"


def test_incomplete_events_are_set_aside(spark):
    df = spark.createDataFrame([click("PAGE_VIEW", T0), click("PAGE_VIEW", T0, user=None), click(None, T0, event_id="x")],
                               LOOSE)
    assert (sessions.usable(df).count(), sessions.unusable(df).count()) == (1, 2)


def brute_force(clicks, gap):
    out = {}
    for user in {c[1] for c in clicks}:
        mine = sorted((c for c in clicks if c[1] == user), key=lambda c: (c[8], c[0]))
        group, groups = [mine[0]], []
        for c in mine[1:]:
            if c[8] - group[-1][8] > gap:
                groups.append(group)
                group = []
            group.append(c)
        for g in groups + [group]:
            views = [c[5] for c in g if c[3] == "PRODUCT_VIEW" and c[5] is not None]
            best = min(set(views), key=lambda v: (-views.count(v), v)) if views else None
            out[user, g[0][8]] = (g[-1][8], len([c for c in g if c[3] == "PAGE_VIEW"]), best, g[0][2])
    return out


@pytest.mark.parametrize("seed", range(4))
def test_random_clicks_against_brute_force(spark, seed):
    rng = random.Random(seed)
    gap = timedelta(minutes=5)
    clicks = [
        click(rng.choice(["PAGE_VIEW", "PRODUCT_VIEW"]), T0 + rng.randrange(0, 8 * 60) * 15_000, user=rng.choice("abbbbb"),
              category=rng.choice([None, "x", "y", "z"]), event_id=f"e{i:04d}", session=f"s{i}")
        for i in range(250)
    ]
    got = {
        (r["user_id"], int(r["session_start"].timestamp() * 1000)):
            (int(r["session_end"].timestamp() * 1000), r["page_views"], r["primary_category"], r["session_id"])
        for r in run(spark, clicks, gap=gap)
    }
    assert got == brute_force(clicks, 300_000)


def stream_of(spark, run_, clicks, step):
    """Append clicks to a topic of files and process what is there."""
    df = to_wire(spark.createDataFrame(clicks, LOOSE))
    df.coalesce(1).write.mode("append").text(f"{run_.folder}/topics/clicks")
    topic = read_topic(spark, "clicks", path=f"{run_.folder}/topics")
    return run_.drain(jobs.session_stream(messages.parse_strict(topic, CLICKSTREAM)))


def test_stream_equals_batch_in_any_order_and_across_restarts(spark, rows):
    closing = [click("PAGE_VIEW", T0 + 300 * MIN, user="closer")]
    rng = random.Random(1)
    clicks = JOURNEY + [
        click(rng.choice(["PAGE_VIEW", "PURCHASE", "PRODUCT_VIEW"]), T0 + i * 7 * MIN, user=f"u{i % 3}", price=5.0,
              category=rng.choice("ab"), event_id=f"r{i}") for i in range(30)
    ]
    rng.shuffle(clicks)
    clicks.sort(key=lambda c: c[8] // (60 * MIN))  # out of order inside each hour's delivery
    run_ = StreamRun.new(spark, "sessions-test")
    cut = [c for c in clicks if c[8] < T0 + 120 * MIN]
    stream_of(spark, run_, cut, 0)
    stream_of(spark, run_, [c for c in clicks if c not in cut], 1)
    stream_of(spark, run_, closing, 2)
    batch = sessions.session_metrics(spark.createDataFrame(clicks, LOOSE))
    assert rows(run_.spark.read.parquet(run_.table)) == rows(batch)


def test_work_dir_uses_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert work_dir(spark, "x").startswith(base.rstrip("/"))
