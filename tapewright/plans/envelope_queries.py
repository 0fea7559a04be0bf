"""Parsing, typing, scoring and rejecting feed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright import feed_values as fv
from tapewright.functions.routing import fixed6, timestamp_of
from tapewright.operators import bars, book, envelope
from tapewright.plans.check_views import fixed6 as sql6
from tapewright.plans.check_views import over
from tapewright.plans.registry import query
from tapewright.sources import feed
from tapewright.sources.tables import table

KEEP = ("event_id",)


def messages(spark, folder) -> DataFrame:
    return feed.raw_messages(table(spark, folder, "events"))


def normalized(spark, folder, keep=KEEP) -> DataFrame:
    return envelope.normalize(messages(spark, folder), keep=keep)


@query("envelope_normalize", over("ids", """
SELECT event_id, symbol, stream_type, stream_name, event_time, received_time, date, received_date,
       raw_data, data_quality_score, reject_reason FROM ids"""))
def envelope_normalize(spark, folder):
    return normalized(spark, folder).select(
        "event_id", "symbol", "stream_type", "stream_name", "event_time", "received_time", "date",
        "received_date", "raw_data", "data_quality_score", "reject_reason")


@query("record_id_stable", over("ids", """
SELECT event_id, record_id FROM ids WHERE reject_reason IS NULL"""))
def record_id_stable(spark, folder):
    return envelope.accepted(normalized(spark, folder)).select("event_id", "record_id")


@query("event_type_dispatch", over("ids", """
SELECT stream_type, event_kind,
       stream_type NOT IN ('trade', '24hrTicker', 'kline', 'depthUpdate') AS is_unexpected_type,
       count(*) AS n
FROM ids WHERE reject_reason IS NULL GROUP BY ALL"""))
def event_type_dispatch(spark, folder):
    return (envelope.accepted(normalized(spark, folder))
            .groupBy("stream_type", "event_kind", "is_unexpected_type")
            .agg(F.count("*").alias("n")))


@query("trade_typed", over("ids", """
SELECT record_id, symbol, event_time, date, p_value AS price, size_in::DOUBLE AS quantity, trade_id,
       event_id % 2 = 0 AS is_buyer_maker, data_quality_score
FROM ids WHERE reject_reason IS NULL AND stream_type = 'trade'"""))
def trade_typed(spark, folder):
    return envelope.typed_rows(normalized(spark, folder), fv.TRADE).select(
        "record_id", "symbol", "event_time", "date", *envelope.TRADE_COLUMNS,
        "data_quality_score")


@query("ticker_typed", over("ids", """
SELECT record_id, symbol, event_time, p_value AS price_change, k::DOUBLE AS price_change_percent,
       price_in::DOUBLE AS last_price, size_in::DOUBLE AS volume,
       CAST(price_in * (k + 1) AS DECIMAL(18,2))::DOUBLE AS quote_volume
FROM ids WHERE reject_reason IS NULL AND stream_type = '24hrTicker'"""))
def ticker_typed(spark, folder):
    return envelope.typed_rows(normalized(spark, folder), fv.TICKER).select(
        "record_id", "symbol", "event_time", *envelope.TICKER_COLUMNS)


_KLINE_CHECK = """
SELECT record_id, symbol, event_time, CASE WHEN p_state <> 'text' THEN '1h' END AS "interval",
       CASE WHEN p_state = 'text' THEN 0.0 ELSE price_in::DOUBLE END AS open,
       CASE WHEN p_state = 'text' THEN 0.0 ELSE high_in::DOUBLE END AS high,
       CASE WHEN p_state = 'text' THEN 0.0 ELSE low_in::DOUBLE END AS low,
       CASE WHEN p_state = 'text' THEN 0.0 ELSE close_in::DOUBLE END AS close,
       CASE WHEN p_state = 'text' THEN 0.0 ELSE size_in::DOUBLE END AS volume,
       CASE WHEN p_state = 'text' THEN FALSE ELSE event_id % 3 <> 0 END AS is_closed,
       CASE WHEN p_state <> 'text' THEN opened END AS bar_open_time,
       CASE WHEN p_state <> 'text' THEN opened + 3599999 END AS bar_close_time
FROM ids WHERE reject_reason IS NULL AND stream_type = 'kline'"""
KLINES = f"klines AS ({_KLINE_CHECK})"


def klines(spark, folder) -> DataFrame:
    return envelope.typed_rows(normalized(spark, folder), fv.KLINE)


@query("kline_typed", over("ids", _KLINE_CHECK))
def kline_typed(spark, folder):
    return klines(spark, folder).select("record_id", "symbol", "event_time",
                                        *envelope.KLINE_COLUMNS)


@query("kline_closed", over("ids", "SELECT * FROM klines WHERE is_closed", KLINES))
def kline_closed(spark, folder):
    return bars.closed_only(klines(spark, folder)).select(
        "record_id", "symbol", "event_time", *envelope.KLINE_COLUMNS)


def depth(spark, folder) -> DataFrame:
    return envelope.typed_rows(normalized(spark, folder), fv.DEPTH, keep=KEEP)


# The ladder as the feed states it: five levels a side, one cent apart.
BOOK = """snaps AS (
  SELECT *, price_in AS px, size_in AS sz FROM ids
  WHERE reject_reason IS NULL AND event_kind = 'depthUpdate'),
lv AS (
  SELECT event_id, record_id, symbol, event_time, 'ask' AS side, i AS level,
         (px + (i + 1) * 0.01)::DOUBLE AS price, (sz + i * (event_id % 3 + 2))::DOUBLE AS qty
  FROM snaps, (SELECT unnest(range(5)) AS i)
  UNION ALL
  SELECT event_id, record_id, symbol, event_time, 'bid' AS side, i AS level,
         (px - (i + 1) * 0.01)::DOUBLE AS price, (sz + i * (event_id % 3))::DOUBLE AS qty
  FROM snaps, (SELECT unnest(range(5)) AS i))"""


@query("depth_levels", over("ids", """
SELECT event_id, symbol, event_time, side, CAST(level AS INTEGER) AS level, price, qty FROM lv""",
                            BOOK))
def depth_levels(spark, folder):
    return book.levels(depth(spark, folder)).select(
        "event_id", "symbol", "event_time", "side", "level", "price", "qty")


@query("book_top", over("ids", f"""
SELECT event_id, symbol, event_time,
       max(price) FILTER (WHERE side = 'bid') AS bid, min(price) FILTER (WHERE side = 'ask') AS ask,
       {sql6("(max(price) FILTER (WHERE side = 'bid') + min(price) FILTER (WHERE side = 'ask')) / 2")}
         AS mid,
       {sql6("min(price) FILTER (WHERE side = 'ask') - max(price) FILTER (WHERE side = 'bid')")}
         AS spread
FROM lv GROUP BY event_id, symbol, event_time""", BOOK))
def book_top(spark, folder):
    top = book.top_of_book(depth(spark, folder))
    return top.select("event_id", "symbol", "event_time", "bid", "ask",
                      fixed6(F.col("mid")).alias("mid"), fixed6(F.col("spread")).alias("spread"))


@query("book_imbalance", over("ids", f"""
SELECT event_id, symbol, event_time,
       {sql6('''(max_by(price, price) FILTER (WHERE side = 'bid')
                 * min_by(qty, price) FILTER (WHERE side = 'ask')
                 + min_by(price, price) FILTER (WHERE side = 'ask')
                 * max_by(qty, price) FILTER (WHERE side = 'bid'))
                / (max_by(qty, price) FILTER (WHERE side = 'bid')
                   + min_by(qty, price) FILTER (WHERE side = 'ask'))''')} AS microprice,
       {sql6('''(sum(qty) FILTER (WHERE side = 'bid') - sum(qty) FILTER (WHERE side = 'ask'))
                / sum(qty)''')} AS imbalance
FROM lv GROUP BY event_id, symbol, event_time""", BOOK))
def book_imbalance(spark, folder):
    rows = book.imbalance(depth(spark, folder))
    return rows.select("event_id", "symbol", "event_time",
                       fixed6(F.col("microprice")).alias("microprice"),
                       fixed6(F.col("imbalance")).alias("imbalance"))


@query("dead_letter", over("ids", """
SELECT event_id, reject_reason AS error, CASE WHEN reject_reason = 'invalid_json'
         THEN 'invalid json string {{{' END AS unparsed_text,
       received_time, data_quality_score, 'crypto_raw_unknown_unknown' AS topic
FROM ids WHERE reject_reason IS NOT NULL"""))
def dead_letter(spark, folder):
    rows = envelope.dead_letters(normalized(spark, folder), keep=KEEP)
    return rows.select("event_id", "error",
                       F.when(F.col("error") == "invalid_json", F.col("raw_message"))
                       .alias("unparsed_text"),
                       "received_time", "data_quality_score", "topic")


@query("quality_score", over("ids", """
SELECT stream_type, data_quality_score, count(*) AS n FROM ids GROUP BY ALL"""))
def quality_score(spark, folder):
    return (normalized(spark, folder).groupBy("stream_type", "data_quality_score")
            .agg(F.count("*").alias("n")))


@query("quality_filter", over("ids", """
SELECT event_id, symbol, stream_type, data_quality_score, data_quality_score >= 0.8 AS passed
FROM ids WHERE reject_reason IS NULL"""))
def quality_filter(spark, folder):
    rows = envelope.accepted(normalized(spark, folder))
    return rows.select("event_id", "symbol", "stream_type", "data_quality_score",
                       (F.col("data_quality_score") >= fv.QUALITY_THRESHOLD).alias("passed"))


@query("ohlcv_from_klines", over("ids", """
SELECT symbol, "interval", make_timestamp(bar_open_time * 1000) AS bar_start, open, high, low, close, volume
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, "interval", bar_open_time
                                   ORDER BY is_closed DESC NULLS LAST, event_time DESC, record_id DESC) AS rn
      FROM klines WHERE bar_open_time IS NOT NULL)
WHERE rn = 1 AND is_closed AND low <= least(open, close) AND high >= greatest(open, close)
  AND volume >= 0""", KLINES))
def ohlcv_from_klines(spark, folder):
    return bars.bars_from_klines(klines(spark, folder)).select(
        "symbol", "interval", timestamp_of(F.col("bar_ms")).alias("bar_start"), "open", "high", "low", "close",
        "volume")


@query("ohlcv_validate", over("ids", """
SELECT record_id, coalesce(low <= least(open, close) AND high >= greatest(open, close)
       AND volume >= 0, FALSE) AS is_valid FROM klines""", KLINES))
def ohlcv_validate(spark, folder):
    return bars.with_validity(klines(spark, folder)).select("record_id", "is_valid")
