"""Feed-shaped views over the given tables.

``events`` supplies trades and raw messages, ``lineitem`` and ``part`` a larger volume of fills.
Every column is computed from the row itself, so the views stream and scale like their source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright import feed_values as fv
from tapewright.functions.barrier import barrier
from tapewright.functions.routing import bar_of, topic_name
from tapewright.operators import envelope

SYMBOLS = tuple(fv.SYMBOL_TABLE)
HOUR_MS = 3_600_000


def _symbol() -> Column:
    names = F.array(*[F.lit(s) for s in SYMBOLS])
    return F.element_at(names, (F.pmod(F.col("user_id"), F.lit(len(SYMBOLS))) + 1).cast("int"))


def base_events(events: DataFrame) -> DataFrame:
    event_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        "event_id", "user_id", "event_type", "value",
        _symbol().alias("symbol"), event_ms.alias("event_time"),
        (event_ms + F.pmod(F.col("event_id"), F.lit(500))).alias("received_time"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def trades(events: DataFrame) -> DataFrame:
    return base_events(events).select(
        "symbol", "event_time", F.col("event_id").alias("trade_id"), F.col("value").alias("price"),
        (F.col("k") + 1).cast("double").alias("quantity"),
        (F.pmod(F.col("event_id"), F.lit(2)) == 0).alias("is_buyer_maker"), "received_time")


def redelivered(trade_rows: DataFrame) -> DataFrame:
    """Every tenth trade sent again one millisecond later."""
    copies = F.when(F.pmod("trade_id", F.lit(10)) == 0, F.array(F.lit(0), F.lit(1))) \
        .otherwise(F.array(F.lit(0)))
    return (trade_rows.select("*", F.explode(copies).alias("_again"))
            .withColumn("event_time", F.col("event_time") + F.col("_again")).drop("_again"))


def _pairs(*parts: str) -> str:
    return "concat('{', concat_ws(',', " + ", ".join(parts) + "), '}')"


def _text(name: str, value: str) -> str:
    return f"""concat('"{name}":"', {value}, '"')"""


def _bare(name: str, value: str) -> str:
    return f"""concat('"{name}":', {value})"""


def _side(name: str, sign: int) -> str:
    """Five levels a side, one cent apart, with growing size."""
    rows = ", ".join(
        f"""'["', cast(price + {sign * (i + 1) / 100:.2f}BD as decimal(18,2)), '","',
            cast(size + {i} * (event_id % 3 + {sign + 1}) as decimal(18,2)), '"]'"""
        + (", ','" if i < 4 else "") for i in range(5))
    return f"""concat('"{name}":[', {rows}, ']')"""


def raw_messages(events: DataFrame) -> DataFrame:
    """Feed text with planted defects; keys are written in sorted order.

    click -> trade, view -> ticker, purchase -> kline, signup -> depth, error -> malformed.
    """
    shared = {
        "e_key": f"CASE WHEN event_id % 11 <> 0 THEN {_bare('E', 'event_time')} END",
        "s_key": f"CASE WHEN event_id % 13 <> 0 THEN {_text('s', 'symbol')} END",
        "p_key": f"""CASE WHEN event_id % 23 = 0 THEN '"p":null'
                          WHEN event_id % 19 = 0 THEN '"p":"abc"'
                          WHEN event_id % 17 = 0 THEN '"p":"0.00"'
                          ELSE {_text('p', 'price')} END""",
        "opened": f"event_time - event_time % {HOUR_MS}",
        "close": "cast(price + (k % 7 - 3) * 0.1BD as decimal(18,2))",
    }
    trade = _pairs(
        "e_key", """'"M":true'""", _bare("T", "event_time"), """'"e":"trade"'""",
        _bare("m", "event_id % 2 = 0"), "p_key", _text("q", "size"), "s_key",
        f"CASE WHEN event_id % 29 <> 0 THEN {_bare('t', 'event_id')} END")
    ticker = _pairs(
        "e_key", _text("P", "cast(k as decimal(18,2))"), _text("c", "price"),
        """'"e":"24hrTicker"'""", "p_key",
        _text("q", "cast(price * size as decimal(18,2))"), "s_key", _text("v", "size"))
    top = "cast(greatest(price, close) + 0.5BD as decimal(18,2))"
    bottom = "cast(least(price, close) - 0.5BD as decimal(18,2))"
    bar = _pairs(
        _bare("T", f"opened + {HOUR_MS - 1}"), _text("c", "close"),
        _text("h", f"CASE WHEN event_id % 31 = 0 THEN {bottom} ELSE {top} END"),
        """'"i":"1h"'""",
        _text("l", f"CASE WHEN event_id % 31 = 0 THEN {top} ELSE {bottom} END"),
        _text("o", "CASE WHEN event_id % 17 = 0 THEN 'abc' ELSE cast(price as string) END"),
        _bare("t", "opened"), _text("v", "size"), _bare("x", "event_id % 3 <> 0"))
    kline = _pairs(
        "e_key", """'"e":"kline"'""",
        f"""CASE WHEN event_id % 23 = 0 THEN '"k":null'
                 WHEN event_id % 19 <> 0 THEN concat('"k":', {bar}) END""", "s_key")
    depth = _pairs("e_key", _side("asks", 1), _side("bids", -1), "s_key")
    stamp, name = _bare("E", "event_time"), _text("s", "symbol")
    invalid_price = _pairs(stamp, """'"p":"invalid_price"'""", """'"q":"0.001"'""", name)
    body = f"""CASE event_type WHEN 'click' THEN {trade} WHEN 'view' THEN {ticker}
        WHEN 'purchase' THEN {kline} WHEN 'signup' THEN _depth
        ELSE CASE event_id % 6
          WHEN 0 THEN 'invalid json string {{{{{{'
          WHEN 1 THEN concat('{{"data":', {_pairs(stamp, name)}, '}}')
          WHEN 2 THEN concat('{{"stream":"', lower(symbol), '@trade"}}')
          WHEN 3 THEN '{{}}'
          WHEN 4 THEN '{{"E":null,"p":null,"q":null,"s":null}}'
          ELSE {invalid_price} END END"""
    suffix = """CASE event_type WHEN 'click' THEN '@trade' WHEN 'view' THEN '@ticker'
        WHEN 'purchase' THEN '@kline_1m' WHEN 'signup' THEN '@depth5@100ms' ELSE '@trade' END"""
    wrapped = "(event_type = 'error' AND event_id % 6 >= 3) OR (event_type <> 'error' " \
              "AND event_id % 2 = 0)"
    rows = (barrier(base_events(events))
            .withColumns({"price": F.expr("cast(value as decimal(18,2))"),
                          "size": F.expr("cast(k + 1 as decimal(18,2))")})
            .withColumns({key: F.expr(value) for key, value in shared.items()})
            .withColumn("_depth", F.expr(f"CASE WHEN event_type = 'signup' THEN {depth} END")))
    rows = (barrier(rows)
            .select("event_id", "user_id", "event_type", "received_time", "symbol",
                    F.expr(body).alias("_body"))
            .select("event_id", "user_id", "received_time", F.expr(
                f"""CASE WHEN {wrapped} THEN concat('{{"stream":"', lower(symbol), {suffix},
                    '","data":', _body, '}}') ELSE _body END""").alias("message")))
    return barrier(rows)


def message_log(messages: DataFrame) -> DataFrame:
    """Processed messages as rows of a message log, rejected ones on the catch-all topic.

    Offsets are the event ids: unique and rising per topic and partition, not dense.
    """
    keep = ("event_id",)
    rows = envelope.normalize(messages, keep=keep)
    good = F.to_json(F.struct(*envelope.HEADER, *envelope.TRADE_COLUMNS),
                     {"ignoreNullFields": "false"})
    bad = F.to_json(F.struct("record_id", F.col("reject_reason").alias("error"),
                             F.substring("raw_text", 1, fv.RAW_PREVIEW_CHARS).alias("raw_message"),
                             "received_time", "data_quality_score"))
    ok = F.col("reject_reason").isNull()
    return rows.select(
        F.when(ok, F.col("symbol")).cast("binary").alias("key"),
        F.when(ok, good).otherwise(bad).cast("binary").alias("value"),
        F.when(ok, topic_name(F.col("symbol"), F.col("stream_type")))
        .otherwise(topic_name(F.lit(None), F.lit(None))).alias("topic"),
        # A key has one partition, so its messages keep their order; those without a key go round.
        F.pmod(F.when(ok, F.conv(F.substring(F.md5(F.col("symbol").cast("binary")), 1, 15), 16, 10).cast("bigint"))
               .otherwise(F.col("event_id")), F.lit(3)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_millis("received_time").alias("timestamp"),
        F.lit(0).alias("timestampType"))


def fills(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Order lines as fills, traded symbol = brand of the part."""
    joined = lineitem.join(part.select("p_partkey", "p_brand"),
                           lineitem.l_partkey == part.p_partkey)
    return joined.select(
        F.col("p_brand").alias("symbol"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("event_time"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"))
