import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.schemas import ORDER
from basketry.operators import changes
from basketry.sources import messages
from basketry.sources.topics import to_wire
from basketry.streaming import jobs
from basketry.streaming.runner import StreamRun

LINES = {
    "text": "not json",
    "empty": "",
    "no_user": '{"order_id":"o1"}',
    "extra": '{"order_id":"o1","user_id":"u1","extra":1}',
    "number_as_text": '{"order_id":"o2","user_id":"u1","total_amount":"5.5"}',
    "text_as_number": '{"order_id":"o3","user_id":"u1","total_amount":"abc"}',
    "array": "[]",
    "null": None,
    "bad_item": '{"order_id":"o4","user_id":"u1","items":[{"quantity":"many"}]}',
    "good_item": '{"order_id":"o5","user_id":"u1","items":[{"category":"c","quantity":"2","total_price":3}]}',
    "quotes": '{"order_id":"o\\"6","user_id":"u1","is_first_order":"true"}',
}


def frame(spark, *names):
    return spark.createDataFrame([(LINES[n],) for n in names or LINES], "value string")


def safe(spark, *names):
    return messages.parse_safe(frame(spark, *names), schemas.ORDER, ["order_id", "user_id"])


def test_split(spark, rows):
    parsed = safe(spark)
    assert rows(messages.accepted(parsed), "order_id", "total_amount", "is_first_order") == [
        ("o\"6", None, True), ("o1", None, None), ("o2", 5.5, None), ("o5", None, None),
    ]
    dead = {r["original"]: r["error"] for r in messages.rejected(parsed).collect()}
    assert dead == {
        LINES["text"]: messages.ERROR_MALFORMED, "": messages.ERROR_MALFORMED, None: messages.ERROR_MALFORMED,
        LINES["array"]: messages.ERROR_MALFORMED, LINES["text_as_number"]: messages.ERROR_MALFORMED,
        LINES["bad_item"]: messages.ERROR_MALFORMED, LINES["no_user"]: messages.ERROR_MISSING,
    }


def test_items_are_typed(spark):
    [row] = messages.accepted(safe(spark, "good_item")).collect()
    assert [(i["category"], i["quantity"], i["total_price"]) for i in row["items"]] == [("c", 2, 3.0)]


def test_envelope_always_parses(spark):
    for row in messages.envelope(messages.rejected(safe(spark))).collect():
        letter = json.loads(row["value"])
        assert set(letter) == {"timestamp", "error", "original"} and '"' not in letter["error"]


def test_strict_fails_on_a_bad_message(spark):
    assert messages.parse_strict(frame(spark, "extra"), schemas.ORDER).count() == 1
    with pytest.raises(PySparkException, match="Malformed record"):
        messages.parse_strict(frame(spark, "extra", "text"), schemas.ORDER).collect()
    with pytest.raises(PySparkException, match="Malformed record"):
        messages.parse_strict(frame(spark, "extra", "text"), schemas.ORDER).count()


def test_wire_keeps_nulls(spark):
    [row] = to_wire(spark.sql("select 1 as a, cast(null as string) as b")).collect()
    assert row["value"] == '{"a":1,"b":null}'


def test_product_changes(spark):
    lines = ['{"product_id":1,"sku":"S","price":65999,"__op":"u"}', '{"product_id":"2","sku":"S","price":"1.5","__op":"c"}',
             "not json", "", '{"order_id":"o1"}', '{"product_id":"x","price":null,"__op":"u"}']
    df = messages.parse_product_changes(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert [tuple(r) for r in df.collect()] == [
        (1, "S", "", 65999.0, "u"), (2, "S", "", 1.5, "c"), (0, "", "", 0.0, "error"), (0, "", "", 0.0, "error"),
        (0, "", "", 0.0, "r"), (0, "", "", 0.0, "u"),
    ]
    feed = [json.loads(r["value"]) for r in changes.price_feed(df).collect()]
    assert feed[0] == {"type": "price_change", "sku": "S", "price": 65999.0} and len(feed) == 2


def test_order_changes(spark):
    lines = ['{"order_id":7,"order_number":"N","order_status":"S","total_amount":1,"__op":"d"}',
             '{"order_id":0,"__op":"c"}', "oops", '{"order_id":8}']
    df = messages.parse_order_changes(spark.createDataFrame([(v,) for v in lines], "value string"))
    got = [(r["change"], json.loads(r["value"])) for r in changes.order_feed(df).collect()]
    assert got == [("delete", {"type": "order_change", "order": "N", "status": "S"}),
                   ("other", {"type": "order_change", "order": "", "status": ""})]


def test_dead_letter_stream_reads_once_and_loses_nothing(spark):
    run = StreamRun.new(spark, "dlq-test")
    lines = [v for v in LINES.values() if v is not None]
    for part in (lines[:5], lines[5:]):
        spark.createDataFrame([(v,) for v in part], "value string").coalesce(1).write.mode("append").parquet(
            f"{run.folder}/in")
        progress = jobs.split_dead_letters(spark.readStream.schema("value string").parquet(f"{run.folder}/in"), run)
        assert sum(p["numInputRows"] for p in progress) == len(part)
    valid = spark.read.parquet(f"{run.folder}/valid")
    dead = spark.read.parquet(f"{run.folder}/dead_letters")
    assert (valid.count(), dead.count()) == (4, 6)
    assert dead.select("batch_id").distinct().count() == 2 and dead.filter(F.col("dt").isNull()).count() == 0


def test_schema_lookup():
    assert schemas.get_schema("order") is schemas.ORDER and len(schemas.ORDER) == 14
    assert len(schemas.CLICKSTREAM) == 13 and len(schemas.INVENTORY) == 9 and len(schemas.FRAUD_ALERT) == 8
    assert schemas.get_schema("payments") is None


def test_events_by_schema_name(spark, rows):
    good = '{"event_id":"e","product_id":"p","event_type":"STOCK_UPDATE","new_stock":"4","warehouse_id":"w","timestamp":1}'
    lines = [good, '{"event_id":"e"}', good.replace('"4"', '"x"')]
    parsed = messages.parse_events(spark.createDataFrame([(v,) for v in lines], "value string"), "inventory")
    assert rows(messages.accepted(parsed), "product_id", "new_stock", "new_price") == [("p", 4, None)]
    assert rows(messages.rejected(parsed), "error") == [(messages.ERROR_MALFORMED,), (messages.ERROR_MISSING,)]
    with pytest.raises(ValueError):
        messages.parse_events(spark.createDataFrame([("x",)], "value string"), "payments")


@pytest.mark.parametrize("field, text, value", [
    ("timestamp", "1.7E12", 1_700_000_000_000), ("is_first_order", '"True"', True), ("is_first_order", "0", False),
    ("is_first_order", '"yes"', None), ("order_id", '{"x":1}', None), ("order_id", "[1]", None), ("order_id", '"{x"', "{x"),
    ("total_amount", '"n/a"', None), ("timestamp", "99999999999999999999", None),
])
def test_values_of_messages(spark, field, text, value):
    fields = {"order_id": '"o"', "user_id": '"u"', "timestamp": "5", field: text}
    line = "{" + ",".join(f'"{k}":{v}' for k, v in fields.items()) + "}"
    row = messages.parse_safe(spark.createDataFrame([(line,)], "value string"), ORDER, ["order_id"]).first()
    assert (row["error"] is None) == (value is not None)
    if value is not None:
        assert row["row"][field] == value


def test_fractions_of_whole_numbers_are_cut(spark):
    line = '{"order_id":"o","items":[{"quantity":5.7},{"quantity":-2.9}]}'
    row = messages.parse_safe(spark.createDataFrame([(line,)], "value string"), ORDER, ["order_id"]).first()
    assert [i["quantity"] for i in row["row"]["items"]] == [5, -2]


def test_unreadable_envelopes_are_rejected(spark):
    lines = spark.createDataFrame([("not json",), ('{"op":"c","after":{"product_id":1}}',), (None,), ('{"after":{}}',)],
                                  "value string")
    row = T.StructType([T.StructField("product_id", T.IntegerType())])
    assert messages.unwrap(lines, row).count() == 1
    bad = messages.rejected(messages.read_envelopes(lines, row)).collect()
    assert sorted(r["original"] for r in bad) == ["not json", '{"after":{}}']


def test_table_rows_by_schema_name(spark):
    from decimal import Decimal

    line = '{"item_id":1,"order_id":2,"product_id":3,"quantity":2,"unit_price":"9.99","total_price":19.98}'
    row = messages.parse_events(spark.createDataFrame([(line,)], "value string"), "order_items").first()
    assert row["error"] is None and (row["row"]["quantity"], row["row"]["unit_price"]) == (2, Decimal("9.99"))
    line = '{"movement_id":1,"product_id":3,"movement_type":"OUT"}'
    row = messages.parse_events(spark.createDataFrame([(line,)], "value string"), "inventory_movements").first()
    assert row["error"] is not None  # no quantity


def test_cut_off_messages_do_not_reach_the_parser(spark):
    whole = '{"order_id":"1","user_id":"u","items":[{"quantity":2}]}'
    texts = [whole[:n] for n in range(len(whole) + 1)] + [
        " " + whole[:20], whole + " x", "[" + whole + "]", '{"order_id":"}', '{"order_id":"1","user_id":"}"', "}", "{}", None]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    wire = T.StructType([T.StructField(n, T.StringType()) for n in ("order_id", "user_id", "_corrupt")])
    read = F.from_json("value", wire, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    broken = {r.value for r in lines.select("value", read.alias("raw")).filter("raw is null or raw._corrupt is not null").collect()}
    parsed = messages.parse_safe(lines, ORDER, ["order_id", "user_id"]).collect()
    assert {r["value"] for r in parsed if r["error"] == messages.ERROR_MALFORMED} == broken
    cut_off = [r for r in parsed if r["value"] and r["value"].startswith("{") and "}" not in r["value"]]
    assert len(cut_off) > 50 and all(r["row"] is None and r["error"] == messages.ERROR_MALFORMED for r in cut_off)
