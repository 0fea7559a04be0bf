import json

import pytest
from pyspark.sql import functions as F

from tapewright.operators import envelope

GOOD = {"E": 1700000000000, "e": "trade", "s": "BTCUSDT", "t": 12345, "p": "50000.00",
        "q": "0.001", "m": False}


def without(*keys, **changes):
    return {**{k: v for k, v in GOOD.items() if k not in keys}, **changes}


def parse(spark, *texts):
    rows = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)],
                                 "i int, message string, received_time bigint")
    found = envelope.normalize(rows, keep=("i",)).orderBy("i").collect()
    assert len(found) == len(texts)
    return found


SCORES = [
    (GOOD, 1.0), (without("t"), 0.85), (without("t", "E"), 0.55), (without("t", "s"), 0.65),
    (without("t", "p"), 0.5), (without("t", p="0.00"), 0.65), (without(q="0"), 0.9),
    (without("q"), 0.75), (without("p", "q", "t", "E", "s"), 0.0),
    ({"e": "24hrTicker", "E": 1, "s": "A", "c": "1", "v": "2"}, 1.0),
    ({"e": "24hrTicker", "E": 1, "s": "A", "c": "1"}, 0.8),
    ({"e": "24hrTicker", "E": 1, "s": "A"}, 0.6),
    ({"e": "kline", "E": 1, "s": "A"}, 0.5),
    ({"e": "kline", "E": 1, "s": "A", "k": {"o": "1", "h": "1", "l": "1"}}, 0.8),
    ({"e": "kline", "E": 1, "s": "A", "k": {}}, 0.5),
    ({"s": "A", "E": 5}, 1.0), ({"p": "invalid_price", "E": 1, "s": "A"}, 1.0),
    ({"data": {"E": 1, "s": "A"}}, 0.5), ({"stream": "a@trade"}, 0.5),
    ({"stream": "a@trade", "data": {}}, 0.5), ({}, 0.5),
]

REJECTED = [
    ("", "invalid_json"), ("invalid json string {{{", "invalid_json"), ("x" * 1000, "invalid_json"),
    ('{"E":1} junk', "invalid_json"), ('{"E":1} {"s":"A"}', "invalid_json"),
    ('{"E":1},{"s":"A"}', "invalid_json"), ('{"E":1},"~end~"', "invalid_json"),
    ('{"E":1}] }', "invalid_json"), ("{'E':1}", "invalid_json"), ('{"E":1,}', "invalid_json"),
    ("[1]", "not_an_object"), ("5", "not_an_object"), ('"{x"', "not_an_object"),
    ("null", "not_an_object"), ('["stream","data"]', "not_an_object"),
    ('{"stream":"a","data":null}', "not_an_object"), ('{"stream":"a","data":"{x"}', "not_an_object"),
    ('{"stream":"a","data":[1]}', "not_an_object"),
    (json.dumps(without(p=None)), "invalid_number"), (json.dumps(without(p="abc")), "invalid_number"),
    (json.dumps(without(q="")), "invalid_number"), (json.dumps(without(p="1.5d")), "invalid_number"),
    (json.dumps(without(p={"x": 1})), "invalid_number"), (json.dumps(without(p="true")), "invalid_number"),
    ('{"e":"24hrTicker","E":1,"s":"A","P":"x"}', "invalid_number"),
    ('{"e":"kline","E":1,"s":"A","k":null}', "invalid_kline"),
    ('{"e":"kline","E":1,"s":"A","k":"o"}', "invalid_kline"),
    ('{"e":"kline","E":1,"s":"A","k":{"o":null}}', "invalid_kline"),
    ('{"s":null,"E":1}', "null_symbol"), ('{"s":5,"E":1}', "invalid_symbol"),
    ('{"s":true,"E":1}', "invalid_symbol"),
    ('{"s":"A","E":null}', "null_event_time"), ('{"s":"A","E":"x"}', "invalid_event_time"),
]


def test_scores(spark):
    rows = parse(spark, *[json.dumps(message) for message, _ in SCORES])
    for row, (message, expected) in zip(rows, SCORES):
        assert row.reject_reason is None, message
        assert row.data_quality_score == pytest.approx(expected, abs=1e-9), message


def test_rejections(spark):
    rows = parse(spark, *[text for text, _ in REJECTED])
    assert [(r.raw_text, r.reject_reason) for r in rows] == REJECTED
    assert {r.data_quality_score for r in rows} == {0.0}


def test_trade_fields_and_defaults(spark):
    wrapped = json.dumps({"stream": "btcusdt@trade", "data": GOOD})
    full, bare, empty = parse(spark, wrapped, json.dumps(without("p", "m", "E")), "{}")
    assert (full.price, full.quantity, full.trade_id, full.is_buyer_maker) == (50000.0, 0.001,
                                                                              12345, False)
    assert (full.symbol, full.stream_name, full.event_time) == ("BTCUSDT", "btcusdt@trade",
                                                                1700000000000)
    assert json.loads(full.raw_data) == GOOD
    assert (bare.price, bare.is_buyer_maker, bare.event_time, bare.stream_name) == (0.0, False, 7,
                                                                                    None)
    assert (empty.symbol, empty.stream_type, empty.is_unexpected_type) == ("UNKNOWN", "unknown",
                                                                           True)


def test_numbers_as_python_reads_them(spark):
    texts = ['"1_000"', '" 2 "', "3", "true", "1e3", '".5"', '"-4."', '"+6"']
    rows = parse(spark, *['{"e":"trade","E":1,"s":"A","p":%s,"q":"1"}' % t for t in texts])
    assert [r.price for r in rows] == [1000.0, 2.0, 3.0, 1.0, 1000.0, 0.5, -4.0, 6.0]


def test_repeated_key_keeps_the_last(spark):
    row, = parse(spark, '{"e":"trade","E":1,"s":"A","p":"1","p":"2","q":"1"}')
    assert row.price == 2.0


def test_kline_and_ticker_fields(spark):
    kline, ticker = parse(
        spark, '{"e":"kline","E":1,"s":"A","k":{"t":60000,"T":119999,"i":"1m","o":"1","c":"2",'
               '"h":"3","l":"0.5","v":"9","x":true}}',
        '{"e":"24hrTicker","E":1,"s":"A","p":"1","P":"2","c":"3","v":"4","q":"5"}')
    assert (kline.interval, kline.open, kline.high, kline.low, kline.close, kline.volume,
            kline.is_closed, kline.bar_open_time, kline.bar_close_time) == (
        "1m", 1.0, 3.0, 0.5, 2.0, 9.0, True, 60000, 119999)
    assert (ticker.price_change, ticker.price_change_percent, ticker.last_price, ticker.volume,
            ticker.quote_volume) == (1.0, 2.0, 3.0, 4.0, 5.0)


def test_dead_letter_keeps_the_whole_text(spark):
    rows = spark.createDataFrame([("x" * 1000, 7)], "message string, received_time bigint")
    row, = envelope.dead_letters(envelope.normalize(rows)).collect()
    assert (len(row.raw_message), len(row.raw_text)) == (500, 1000)
    assert row.topic == "crypto_raw_unknown_unknown"


def test_record_id_is_stable_and_uuid_is_not(spark):
    rows = spark.createDataFrame([(json.dumps(GOOD), 7)] * 2, "message string, received_time bigint")
    stable = envelope.normalize(rows).select("record_id").distinct().count()
    fresh = envelope.normalize(rows, record_id="uuid").select("record_id").distinct().count()
    assert (stable, fresh) == (1, 2)


def test_parse_appears_once_in_a_filtered_plan(spark):
    rows = spark.createDataFrame([("{}", 7)], "message string, received_time bigint")
    plan = envelope.accepted(envelope.normalize(rows))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("parseJson") == 1


def test_clock_is_used_without_a_received_column(spark):
    rows = spark.createDataFrame([("{}",)], "message string")
    row = envelope.normalize(rows, received=None).select(
        (F.unix_millis(F.current_timestamp()) - F.col("received_time")).alias("age")).first()
    assert 0 <= row.age < 60_000
