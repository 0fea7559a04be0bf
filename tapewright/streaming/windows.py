"""Windowed aggregates and duplicate suppression over streams, bounded by watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.functions.routing import tick_order

DELAY = "10 minutes"


def with_clock(rows: DataFrame, epoch_ms: str, delay: str = DELAY) -> DataFrame:
    return (rows.withColumn("clock", F.timestamp_millis(F.col(epoch_ms)))
            .withWatermark("clock", delay))


def minute_counts(rows: DataFrame, delay: str = DELAY) -> DataFrame:
    """Messages per type and minute of received time."""
    return (with_clock(rows, "received_time", delay)
            .groupBy(F.window("clock", "1 minute").alias("w"), "stream_type")
            .agg(F.count("*").alias("n"))
            .select(F.col("w.start").alias("minute"), "stream_type", "n"))


def ohlcv(trades: DataFrame, width: str = "1 hour", delay: str = DELAY) -> DataFrame:
    """Bars of closed windows; the same aggregate as the batch bars."""
    rows = with_clock(trades, "event_time", delay).withColumn(
        "_order", tick_order(F.col("event_time"), F.col("trade_id")))
    return (rows.groupBy("symbol", F.window("clock", width).alias("w")).agg(
        F.min_by("price", "_order").alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", "_order").alias("close"),
        F.sum("quantity").alias("volume"), F.count("*").alias("trades"))
        .select("symbol", F.col("w.start").alias("bar_start"), "open", "high", "low", "close",
                "volume", "trades"))


def deduplicate(trades: DataFrame, delay: str = DELAY) -> DataFrame:
    """One row per (symbol, trade id) among copies closer together than the delay.

    Trades without an id are told apart by their record id, or by all they hold where there is none.
    """
    own = [F.col("record_id")] if "record_id" in trades.columns else []
    record = F.coalesce(*own, F.to_json(F.struct(*trades.columns)))
    return (with_clock(trades, "event_time", delay)
            .withColumn("_record", F.when(F.col("trade_id").isNull(), record))
            .dropDuplicatesWithinWatermark(["symbol", "trade_id", "_record"]).drop("clock", "_record"))
