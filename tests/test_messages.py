"""Classification of single messages."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelflow.functions import field, typed_field
from parcelflow.operators.ingest import bad_messages, classify
from parcelflow.plans.staging import stg_orders
from parcelflow.schemas import Field
from tests.helpers import frame, message, values

BAD = ['{"a":1} x', "1] [2", '1,"end":1} {', "1,2", "", "{bad", "null", None, b"\xffA", '{"a":1}]', '[1]]', '{"a":1}],{}',
       "{'a':1}", "INF", "tru", '"x', "[1,]", "01", "﻿{}"]
GOOD = ["5", "[1]", '"x"', "true", '{"a":1,"a":2}', ' {"a": [1, {"b": "]"}]} ', '"]"', "[]", "{}", "-1.5e3", "[null]",
        '"\\\\ud800"', '"\\ud83d\\ude00"', '"\\uD83D\\uDE00 \\\\\\ud83d\\ude00"', '"\\\\u0000"']
ERROR = ['{"a":NaN}', "NaN", "[-Infinity]", '{"a":"\\u0000"}', '{"a":"\\\\\\u0000"}', '"\\ud800"', '"\\uDC00"', '"\\ude00\\ud83d"',
         '"\\\\\\ud83d"']


def outcomes(spark, texts):
    rows = classify(values(spark, *texts)).select("kafka_offset", "outcome").collect()
    return [r["outcome"] for r in sorted(rows)]


@pytest.mark.parametrize("texts,outcome", [(BAD, "bad"), (GOOD, "written"), (ERROR, "error")])
def test_each_text_has_its_outcome(spark, texts, outcome):
    assert dict(zip(texts, outcomes(spark, texts), strict=True)) == dict.fromkeys(texts, outcome)


def test_an_escaped_backslash_is_no_nul(spark):
    assert outcomes(spark, ['{"a":"\\\\u0000"}']) == ["written"]


def expected(text: str) -> str:
    try:
        value = json.loads(text)
    except ValueError:
        return "bad"
    if value is None:
        return "bad"
    try:
        json.dumps(value, allow_nan=False)
    except ValueError:
        return "error"
    return "error" if "\0" in json.dumps(value, ensure_ascii=False).replace("\\u0000", "\0") else "written"


_json = st.recursive(
    st.none() | st.booleans() | st.integers(-(10**12), 10**12) | st.floats(width=32)
    | st.text("ab]}{[\",:\\ \té", max_size=5),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text("ab]", max_size=2), inner, max_size=3),
    max_leaves=6,
)
_texts = _json.map(json.dumps) | st.text('[]{},:" 10aN\\', max_size=12) | st.tuples(
    _json.map(json.dumps), st.text('[]{},:" 1x', max_size=4)
).map("".join)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_texts, min_size=20, max_size=60))
def test_agrees_with_a_strict_parser(spark, texts):
    assert outcomes(spark, texts) == [expected(t) for t in texts]


def test_bad_wins_over_error(spark):
    rows = classify(frame(spark, message("{bad", key=b"\xff"), message("{}", key=b"\xff", offset=1)))
    assert [r["outcome"] for r in rows.orderBy("kafka_offset").collect()] == ["bad", "error"]


def test_bad_messages_name_their_reason(spark):
    rows = bad_messages(values(spark, None, b"\xff", "{", "null", "1")).orderBy("kafka_offset")
    assert [r["reason"] for r in rows.collect()] == [
        "no value", "value is not utf-8", "value is not json", "value is json null",
    ]


def test_keys(spark):
    rows = classify(frame(spark, *[message("1", key=k, offset=i) for i, k in enumerate([None, b"", b"12", "é"])]))
    assert [r["kafka_key"] for r in rows.orderBy("kafka_offset").collect()] == [None, None, "12", "é"]


def payload(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", F.parse_json("t").alias("payload")
    )


def read(spark, spec, *texts, strict=True):
    rows = payload(spark, *texts).select("i", typed_field(F.col("payload"), spec, strict)).orderBy("i").collect()
    return [r[1] for r in rows]


def test_field_as_text(spark):
    texts = ['{"a":"x"}', '{"a":null}', '{"b":1}', "5", "[1]", '{"a":true}', '{"a":{"b":1}}', '{"a":1,"a":2}']
    rows = payload(spark, *texts).select("i", field(F.col("payload"), "a")).orderBy("i").collect()
    assert [r[1] for r in rows] == ["x", None, None, None, None, "true", '{"b":1}', "2"]


def test_bigint(spark):
    assert read(spark, Field("a", "a", "bigint"), '{"a":"7"}', '{"a":7}', "{}") == [7, 7, None]


@pytest.mark.parametrize(
    "spec,text",
    [
        (Field("a", "a", "bigint"), '{"a":"abc"}'),
        (Field("a", "a", "int"), '{"a":2.5}'),
        (Field("a", "a", "decimal(10,2)"), '{"a":123456789012}'),
        (Field("a", "a", "timestamp"), '{"a":"soon"}'),
    ],
)
def test_malformed_fields_raise_or_become_null(spark, spec, text):
    with pytest.raises(Exception, match="CAST|NUMERIC|cast|out of range"):
        read(spark, spec, text)
    assert read(spark, spec, text, strict=False) == [None]


def test_default(spark):
    assert read(spark, Field("a", "a", "int", 1), "{}", '{"a":null}', '{"a":3}') == [1, 1, 3]


def test_decimal_rounds_half_away_from_zero(spark):
    found = read(spark, Field("a", "a", "decimal(12,2)"), '{"a":2.345}', '{"a":-2.345}', '{"a":99.30000000000001}')
    assert [str(x) for x in found] == ["2.35", "-2.35", "99.30"]


def test_timestamps(spark):
    texts = ["2024-01-02T03:04:05.123456", "2024-01-02T03:04:05", "2024-01-02T03:04:05+02:00", "2024-01-02"]
    column = typed_field(F.col("payload"), Field("a", "a", "timestamp"))
    rows = payload(spark, *[json.dumps({"a": t}) for t in texts]).select("i", column.cast("string")).orderBy("i")
    assert [r[1] for r in rows.collect()] == [
        "2024-01-02 03:04:05.123456", "2024-01-02 03:04:05", "2024-01-02 01:04:05", "2024-01-02 00:00:00",
    ]


def test_quarantine_lists_failed_fields(spark):
    texts = ['{"order_id":"x","quantity":2.5,"unit_price":3}', '{"order_id":4,"quantity":null}']
    raw = payload(spark, *texts).selectExpr(
        "'orders' kafka_topic", "0 kafka_partition", "cast(i as bigint) kafka_offset", "'' kafka_key", "payload",
        "current_timestamp() ingested_at",
    )
    rows = stg_orders(raw, on_error="quarantine").orderBy("kafka_offset").collect()
    assert [r["failed_fields"] for r in rows] == [["order_id", "quantity"], []]
    assert [(r["order_id"], r["quantity"]) for r in rows] == [(None, 1), (4, 1)]
    with pytest.raises(Exception):
        stg_orders(raw).collect()


def test_numbers_are_normalised_by_the_parser(spark):
    """A payload alone does not tell ``7.0`` from ``7``, nor print ``1e3`` as a whole number; the kept spellings do."""
    from parcelflow.functions import spelled_numbers, typed_field, with_strict_json
    from parcelflow.schemas import Field

    texts = ['{"q":7.0}', '{"q":"7"}', '{"q":7.5}', '{"q":1e3}', '{"q":9007199254740993e0}', '{"q": -2E1}', '{"q":"1e3"}']
    texts += ['{"q":[1.0]}', '{"a":{"q":1.5}}', "[1.5]", "7.0", '{"q":null,"a":1.5}', '{"\\u0071":3.0}', '{"q":1e400}']
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    parsed = with_strict_json(rows, "text", "payload")
    spec = Field("q", "q", "int")
    lenient = parsed.select("i", typed_field(F.col("payload"), spec, strict=False)).orderBy("i").collect()
    assert [r["q"] for r in lenient][:4] == [7, 7, None, None]
    kept = parsed.withColumn("spelled", spelled_numbers(F.col("text"), F.col("payload"), ["q"]))
    found = kept.select("i", "spelled", typed_field(F.col("payload"), spec, False, F.col("spelled"))).orderBy("i").collect()
    assert [r["q"] for r in found] == [None, 7, None, 1000, None, -20, None, None, None, None, None, None, None, None]
    assert [r["spelled"] for r in found][:4] == [{"q": "7.0"}, None, {"q": "7.5"}, {"q": "1000"}]
    assert found[12]["spelled"] == {"q": "3.0"} and found[10]["spelled"] is None
    with pytest.raises(Exception, match="7.0"):
        kept.filter("i = 0").select(typed_field(F.col("payload"), spec, True, F.col("spelled"))).collect()


def test_spellings_outlive_storage_next_to_each_other(spark, folder):
    """One ``1.0`` in a file makes all its integers decimals there; the casts must not notice."""
    from parcelflow.operators.event_log import EventLog
    from parcelflow.plans.staging import stg_orders

    forms = ["%d", "%d.0", "%de1", '"%d"', "%d.00e0", "%d"]
    texts = ['{"order_id":%s}' % (forms[i % 6] % i) for i in range(600)]
    log = EventLog(spark, folder)
    log.append(frame(spark, *[message(t, offset=i) for i, t in enumerate(texts)]).coalesce(1))
    rows = stg_orders(log.raw_events(), on_error="quarantine").collect()
    got = {r["kafka_offset"]: (r["order_id"], r["failed_fields"]) for r in rows}
    for i in range(600):
        wanted = (None, ["order_id"]) if i % 6 == 1 else (i * 10 if i % 6 == 2 else i, [])
        assert got[i] == wanted
    assert log.raw_events().filter("spelled is not null").count() == 300


def test_partitions_are_those_of_a_broker(spark, folder):
    """Published results of the default partitioner's hash, and files in the order of the messages."""
    from parcelflow.functions import key_hash, partition_of_key
    from parcelflow.sources.events import write_events

    known = {
        b"21": -973932308, b"foobar": -790332482, b"a-little-bit-long-string": -985981536, b"a-little-bit-longer-string": -1486304829,
        b"lkjh234lh9fiuh90y23oiuhsafujhadof229phr9h19h89h8": -58897971, b"abc": 479470107,
    }
    rows = spark.createDataFrame([(bytearray(k), v) for k, v in known.items()] + [(None, 0)], "key binary, wanted long")
    found = rows.select("key", "wanted", key_hash(F.col("key")).alias("h"), partition_of_key(F.col("key"), 7).alias("p")).collect()
    for r in found:
        if r["key"] is None:
            assert r["h"] is None and r["p"] is None
        else:
            assert r["h"] == r["wanted"] % 2**32 and r["p"] == (r["wanted"] & 0x7FFFFFFF) % 7
    sent = [message("1", key=b"21" if i % 3 else b"abc", offset=i) for i in range(300)] + [message("1", key=None, offset=999)]
    write_events(frame(spark, *sent), path=folder, partitions=5)
    stored = spark.read.parquet(folder).select("key", "offset", "broker_partition", F.input_file_name().alias("file")).collect()
    assert len(stored) == 301
    for key, value in ((b"21", -973932308), (b"abc", 479470107)):
        assert {r["broker_partition"] for r in stored if r["key"] == key} == {(value & 0x7FFFFFFF) % 5}
    for file in {r["file"] for r in stored}:
        offsets = [r["offset"] for r in stored if r["file"] == file]
        assert offsets == sorted(offsets)
