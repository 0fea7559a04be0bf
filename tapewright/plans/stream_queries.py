"""Streams over the event table, run until the input is used up and read back as tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright import feed_values as fv
from tapewright.functions.routing import fixed6, timestamp_of
from tapewright.operators import envelope
from tapewright.plans.bronze_queries import LOG, log, trades
from tapewright.plans.check_views import fixed6 as sql6
from tapewright.plans.check_views import over
from tapewright.plans.market_queries import (
    _D,
    HOURLY,
    SQL_START,
    _recursion,
    _recursive,
    hourly,
    start,
)
from tapewright.plans.registry import CHECKS, query
from tapewright.session import fresh_path
from tapewright.sources import feed, lake, message_log
from tapewright.sources.tables import events_stream
from tapewright.sources.tables import table
from tapewright.streaming import alerts, indicator_state, ingest, sinks, window_table

# Batches in which the tables below arrive, each with rows of all times.
BATCHES = 3


def stream_messages(spark, folder):
    return feed.raw_messages(events_stream(spark, folder))


@query("stream_bronze_ingest", over("ids", """
SELECT record_id, symbol, event_time, date, p_value AS price, size_in::DOUBLE AS quantity, trade_id
FROM ids WHERE reject_reason IS NULL AND stream_type = 'trade'"""))
def stream_bronze_ingest(spark, folder):
    root = fresh_path(spark, "stream_bronze")
    ingest.ingest(stream_messages(spark, folder), root, f"{root}/checkpoint", (fv.TRADE,))
    return lake.read(spark, f"{root}/{fv.TRADE}").select(
        "record_id", "symbol", "event_time", "date", "price", "quantity", "trade_id")


@query("stream_ingest_places", over("ids", f"""
SELECT CASE WHEN reject_reason IS NOT NULL THEN 'dead_letters'
            WHEN event_kind IN {tuple(fv.EXPECTED_TYPES)} THEN event_kind
            ELSE 'other' END AS place,
       CASE WHEN any_value(reject_reason) IS NOT NULL THEN count(*)
            ELSE count(DISTINCT (symbol, record_id)) END AS n
FROM ids GROUP BY 1"""))
def stream_ingest_places(spark, folder):
    """Where every message of the feed ended."""
    root = fresh_path(spark, "stream_places")
    ingest.ingest(stream_messages(spark, folder), root, f"{root}/checkpoint")
    places = [lake.read(spark, f"{root}/{place}").groupBy().count().select(
        F.lit(place).alias("place"), F.col("count").alias("n"))
        for place in (*fv.EXPECTED_TYPES, "other", "dead_letters") if lake.exists(spark, f"{root}/{place}")]
    return functools.reduce(DataFrame.union, places)


@query("stream_minute_counts", over("ids", """
SELECT make_timestamp((received_time - received_time % 60000) * 1000) AS minute, stream_type,
       count(*) AS n
FROM ids GROUP BY ALL"""))
def stream_minute_counts(spark, folder):
    root = fresh_path(spark, "stream_minutes")
    events = window_table.arrivals(table(spark, folder, "events"), "event_id", BATCHES)
    window_table.keep_minute_counts(envelope.normalize(feed.raw_messages(events)), root, f"{root}/checkpoint")
    return window_table.read_minute_counts(spark, root).select(
        timestamp_of(F.col("minute_ms")).alias("minute"), "stream_type", "n")


@query("stream_live_topics", over("ids", """
SELECT topic, count(*) AS n, count(DISTINCT "offset") AS offsets FROM log WHERE topic LIKE '%\\_trade' ESCAPE '\\' GROUP BY topic
""", LOG))
def stream_live_topics(spark, folder):
    """The stream over all trade topics runs twice: the second run takes up where the first ended."""
    root, messages = fresh_path(spark, "stream_live"), log(spark, folder)
    early = F.pmod("offset", F.lit(3)) == 0
    for part in (messages.filter(early), messages.filter(~early)):
        message_log.publish(part, path=f"{root}/log")
        live = message_log.live_source(spark, pattern=f"_{fv.TRADE}$", path=f"{root}/log").select("topic", "offset")
        sinks.drain_to_table(live, f"{root}/table", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/table").groupBy("topic").agg(
        F.count("*").alias("n"), F.count_distinct("offset").alias("offsets"))


@query("stream_dedupe", over("redelivered", """
SELECT symbol, trade_id, min(price) AS price FROM redelivered GROUP BY symbol, trade_id"""))
def stream_dedupe(spark, folder):
    """Trades and their copies arrive in batches of all times, copies often in another batch."""
    root = fresh_path(spark, "stream_dedupe")
    sent = window_table.arrivals(feed.redelivered(trades(spark, folder)), "event_time", BATCHES)
    window_table.keep_first(sent, root, f"{root}/checkpoint")
    return window_table.read_first(spark, root).select("symbol", "trade_id", "price")


@query("stream_late_rows", over("trades", """
SELECT symbol, trade_id, event_time FROM trades
WHERE trade_id % 10 = 0
  AND event_time < (SELECT max(event_time) FROM trades WHERE trade_id % 10 <> 0) - 600000"""))
def stream_late_rows(spark, folder):
    """Two arrivals of the whole table: a tenth of the trades comes after all the others."""
    root = fresh_path(spark, "stream_late")
    arrivals = trades(spark, folder)
    held_back = F.pmod("trade_id", F.lit(10)) == 0
    for part in (arrivals.filter(~held_back), arrivals.filter(held_back)):
        part.write.mode("append").parquet(f"{root}/arrivals")
        stream = spark.readStream.schema(arrivals.schema).parquet(f"{root}/arrivals")
        ingest.split_late(stream, root, f"{root}/checkpoint")
    return sinks.read_batches(spark, f"{root}/late").select("symbol", "trade_id", "event_time")


@query("stream_ohlcv", over("trades", f"""
SELECT symbol, {SQL_START}, open, high, low, close, volume, trades FROM bars""", HOURLY))
def stream_ohlcv(spark, folder):
    root = fresh_path(spark, "stream_ohlcv")
    ticks = window_table.arrivals(trades(spark, folder), "trade_id", BATCHES)
    window_table.keep_bars(ticks, root, f"{root}/checkpoint")
    return window_table.read_bars(spark, root).select(
        "symbol", start(), "open", "high", "low", "close", "volume", "trades")


@query("stream_alerts", over("ids", f"""
SELECT event_id, 'rejected' AS rule, 0.0::DOUBLE AS measure FROM ids
WHERE reject_reason IS NOT NULL
UNION ALL
SELECT event_id, 'low_quality', {sql6("data_quality_score")} FROM ids
WHERE reject_reason IS NULL AND data_quality_score < 0.8::DOUBLE
UNION ALL
SELECT event_id, 'large_trade', {sql6("p_value * size_in::DOUBLE")} FROM ids
WHERE reject_reason IS NULL AND stream_type = 'trade' AND p_value * size_in::DOUBLE >= 10000"""))
def stream_alerts(spark, folder):
    root = fresh_path(spark, "stream_alerts")
    keep = ("event_id",)
    rows = envelope.normalize(stream_messages(spark, folder), keep=keep)
    alerts.watch(rows, f"{root}/alerts", f"{root}/checkpoint", keep)
    return sinks.read_batches(spark, f"{root}/alerts").select(
        "event_id", "rule", fixed6(F.col("measure")).alias("measure"))


def _followed(spark, folder, label):
    """Hourly bars arrive out of order; their indicators are kept in a table."""
    root = fresh_path(spark, label)
    bars = window_table.arrivals(hourly(spark, folder).select("symbol", "bar_ms", "close"), "bar_ms", BATCHES)
    kept = indicator_state.Indicators(spark, root)
    kept.follow(bars, f"{root}/checkpoint")
    return kept.values()


@query("stream_ema", _recursive(f"""
SELECT symbol, {SQL_START}, {sql6("y")} AS ema FROM e12 JOIN pos USING (symbol, pos)""",
                                _recursion("close", "e12", _D[12], "pos")))
def stream_ema(spark, folder):
    return _followed(spark, folder, "stream_ema").select("symbol", start(), fixed6(F.col("ema")).alias("ema"))


@query("stream_rsi", CHECKS["rsi"])
def stream_rsi(spark, folder):
    return _followed(spark, folder, "stream_rsi").select("symbol", start(), fixed6(F.col("rsi")).alias("rsi"))


@query("stream_anomaly_alerts", f"""
SELECT symbol, bar_start AS at, 'price_anomaly' AS rule, zscore AS measure
FROM ({CHECKS["anomaly_zscore"]}) WHERE is_anomaly""")
def stream_anomaly_alerts(spark, folder):
    """An alert stands while its bar is an anomaly: a late bar before it may raise or withdraw it."""
    raised = alerts.from_anomalies(_followed(spark, folder, "stream_anomaly"))
    return raised.select("symbol", timestamp_of(F.col("received_time")).alias("at"), "rule",
                         fixed6(F.col("measure")).alias("measure"))
