"""Trade metrics, order flow, gaps between trades and as-of prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapewright.functions.routing import bar_of, tick_order
from tapewright.operators.bars import WIDTHS_MS
from tapewright.operators.series import before_bucket, bucket_states, time_parts


def _windowed(trades: DataFrame, width: str):
    return (trades.withColumn("bar_ms", bar_of(F.col("event_time"), WIDTHS_MS[width]))
            .groupBy("symbol", "bar_ms"))


def vwap(trades: DataFrame, width: str) -> DataFrame:
    return _windowed(trades, width).agg(
        F.try_divide(F.sum(F.col("price") * F.col("quantity")), F.sum("quantity")).alias("vwap"),
        F.sum("quantity").alias("volume"))


def metrics(trades: DataFrame, width: str) -> DataFrame:
    """Counts, sizes and volume; a buyer who is the maker means the seller initiated."""
    sold = F.col("is_buyer_maker")
    return _windowed(trades, width).agg(
        F.count("*").alias("trades"), F.sum("quantity").alias("volume"),
        F.sum(F.col("price") * F.col("quantity")).alias("notional"),
        F.avg("quantity").alias("mean_size"), F.max("quantity").alias("max_size"),
        F.min("quantity").alias("min_size"),
        F.sum(F.when(sold, 0.0).otherwise(F.col("quantity"))).alias("buy_volume"),
        F.sum(F.when(sold, F.col("quantity")).otherwise(0.0)).alias("sell_volume"))


def order_flow(trades: DataFrame, width: str) -> DataFrame:
    """Signed volume share and trade rate per bar."""
    m = metrics(trades, width)
    return m.withColumns({
        "imbalance": F.try_divide(F.col("buy_volume") - F.col("sell_volume"),
                                  F.col("buy_volume") + F.col("sell_volume")),
        "trades_per_second": F.col("trades") / (WIDTHS_MS[width] / 1000.0)})


def illiquidity(bar_returns: DataFrame) -> DataFrame:
    """Mean absolute return per unit of notional (Amihud), per symbol."""
    return bar_returns.groupBy("symbol").agg(F.avg(F.try_divide(
        F.abs("simple_return"), F.col("notional"))).alias("amihud"))


def intertrade_time(trades: DataFrame) -> DataFrame:
    """Milliseconds since the symbol's previous trade.

    Trades are cut by symbol and time into parts of equal size; the lag runs inside a part, and a
    part's first trade of a symbol takes the last time of the nearest earlier part that has one.
    """
    rows = time_parts(trades, ["symbol", "event_time", "trade_id"], "intertrade")
    ends = bucket_states(rows, "symbol", "_part", _end=F.max("event_time")).select(
        "symbol", "_part", F.last("_end", ignorenulls=True).over(before_bucket("symbol", "_part")).alias("_carried"))
    inside = W.partitionBy("symbol", "_part").orderBy("event_time", "trade_id")
    return (rows.withColumn("_prior", F.lag("event_time").over(inside))
            .join(ends, ["symbol", "_part"], "left")
            .withColumn("gap_ms", F.col("event_time") - F.coalesce("_prior", "_carried"))
            .drop("_part", "_prior", "_carried"))


def asof_price(probes: DataFrame, trades: DataFrame, at: str = "probe_time") -> DataFrame:
    """Each probe with its symbol's last trade price at or before ``at``; NULL if there is none.

    Probes and trades are cut together into parts of equal size; a probe with no earlier trade in its
    part takes the closing price carried from before. No range join, and each side is read once.
    A probe without a symbol or a time has no price; trades without one are not used.
    """
    order = tick_order(F.col("event_time"), F.col("trade_id"))
    quotes = (trades.select("symbol", "event_time", "trade_id", "price", order.alias("_order"))
              .filter("symbol is not null and event_time is not null"))
    extra = [c for c in probes.columns if c != "symbol"]
    both = (probes.select("symbol", F.col(at).alias("event_time"), F.struct(*extra).alias("_probe"))
            .unionByName(quotes, allowMissingColumns=True)
            .withColumn("_asks", F.col("_probe").isNotNull()))
    # At equal time trades come first, so a probe sees them.
    both = time_parts(both, ["symbol", "event_time", "_asks", "_order"], "asof")
    closing = bucket_states(both, "symbol", "_part", _close=F.max_by("price", "_order")).select(
        "symbol", "_part",
        F.last("_close", ignorenulls=True).over(before_bucket("symbol", "_part")).alias("_carried"))
    inside = (W.partitionBy("symbol", "_part").orderBy("event_time", "_asks", "_order")
              .rowsBetween(W.unboundedPreceding, 0))
    return (both.withColumn("_seen", F.last("price", ignorenulls=True).over(inside))
            .filter("_asks")
            .join(closing, ["symbol", "_part"], "left")
            .select("symbol", "_probe.*", F.coalesce("_seen", "_carried").alias("asof_price")))
