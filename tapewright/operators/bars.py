"""OHLCV bars from ticks, from klines and from finer bars; validation and gap filling.

Bars carry ``bar_ms`` (UTC-aligned start, epoch ms). Ticks are reduced by one hash aggregate on
(symbol, bar_ms) with partial aggregation before the shuffle, so a busy symbol costs each map task
one buffer per bar and never gathers in one place. Coarser bars read the finer bars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapewright.functions.routing import bar_of, tick_order
from tapewright.operators.series import BUCKET_BARS, bucket_states

WIDTHS_MS = {"1m": 60_000, "5m": 300_000, "15m": 900_000, "1h": 3_600_000, "4h": 14_400_000,
             "1d": 86_400_000}
VALUES = ["open", "high", "low", "close", "volume", "notional", "trades"]


def from_ticks(ticks: DataFrame, width: str = "1m", order: Column | None = None) -> DataFrame:
    """Bars of (symbol, event_time, price, quantity) rows.

    ``order`` is a total order of the ticks of a bar; by default event time, then trade id.
    """
    width_ms = WIDTHS_MS[width]
    rows = ticks.select(
        "symbol", bar_of(F.col("event_time"), width_ms).alias("bar_ms"), "price", "quantity",
        (tick_order(F.col("event_time"), F.col("trade_id")) if order is None else order)
        .alias("_order"))
    return rows.groupBy("symbol", "bar_ms").agg(
        F.min_by("price", "_order").alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", "_order").alias("close"),
        F.sum("quantity").alias("volume"),
        F.sum(F.col("price") * F.col("quantity")).alias("notional"),
        F.count("*").alias("trades"))


def roll_up(bars: DataFrame, width: str) -> DataFrame:
    """Coarser bars from finer ones; the finer width must divide the coarser."""
    coarse = bar_of(F.col("bar_ms"), WIDTHS_MS[width])
    return (bars.withColumn("_coarse", coarse).groupBy("symbol", "_coarse").agg(
        F.min_by("open", "bar_ms").alias("open"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.max_by("close", "bar_ms").alias("close"),
        F.sum("volume").alias("volume"), F.sum("notional").alias("notional"),
        F.sum("trades").alias("trades"))
        .withColumnRenamed("_coarse", "bar_ms"))


def is_valid() -> Column:
    """Low and high enclose open and close, volume is not negative, nothing missing or NaN."""
    present = F.lit(True)
    for name in ("open", "high", "low", "close", "volume"):
        present = present & F.col(name).isNotNull() & ~F.isnan(name)
    return F.coalesce(
        present & (F.col("low") <= F.least("open", "close"))
        & (F.col("high") >= F.greatest("open", "close")) & (F.col("volume") >= 0), F.lit(False))


def with_validity(rows: DataFrame) -> DataFrame:
    return rows.withColumn("is_valid", is_valid())


def closed_only(klines: DataFrame) -> DataFrame:
    return klines.filter("is_closed")


def latest_per_bar(klines: DataFrame) -> DataFrame:
    """The feed repeats a bar until it closes; keep its last version, a closed one before any open one.

    Bars of different ``interval`` are different bars, also where they open together; a missing
    interval is one of its own. A rank filter, so Spark drops superseded versions before the shuffle.
    """
    newest = W.partitionBy("symbol", "interval", "bar_open_time").orderBy(
        F.desc_nulls_last("is_closed"), F.desc("event_time"), F.desc("record_id"))
    return (klines.filter(F.col("bar_open_time").isNotNull())
            .withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank"))


def bars_from_klines(klines: DataFrame) -> DataFrame:
    """Closed, valid bars, one per symbol, ``interval`` and ``bar_ms``."""
    return (closed_only(latest_per_bar(klines)).filter(is_valid())
            .withColumn("bar_ms", F.col("bar_open_time")))


def fill_gaps(bars: DataFrame, width: str) -> DataFrame:
    """Every bar between a symbol's first and last; a missing one repeats the previous close.

    Each bar itself emits the empty bars up to its successor, so no calendar is joined. Successors
    are found within buckets of ``BUCKET_BARS`` slots; a bucket's last bar takes the first one of
    the next bucket that has any. What it emits beyond its own bucket is dealt out by bucket before
    it is emitted, so neither a long series nor a long gap is one task's work. Bars
    start at multiples of the width, one a symbol and slot; bars without a symbol are a series of
    their own, bars without a start are left out.
    """
    width_ms = WIDTHS_MS[width]
    bucket_ms = width_ms * BUCKET_BARS
    rows = bars.withColumn("_bucket", bar_of(F.col("bar_ms"), bucket_ms))
    firsts = bucket_states(rows, "symbol", "_bucket", _first=F.min("bar_ms"))
    after = firsts.select(F.col("symbol").alias("_symbol"), F.col("_bucket").alias("_at"), F.lead("_first").over(
        W.partitionBy("symbol").orderBy("_bucket")).alias("_after"))
    inside = W.partitionBy("symbol", "_bucket").orderBy("bar_ms")
    ends = (rows.withColumn("_next", F.lead("bar_ms").over(inside))
            .join(after, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("_bucket") == F.col("_at")))
            .withColumn("_next", F.coalesce("_next", "_after", F.col("bar_ms") + width_ms))
            .drop("_symbol", "_at", "_after"))
    stop = F.col("_bucket") + bucket_ms
    here = ends.withColumn("_from", F.col("bar_ms"))
    # One row a bucket that a gap reaches into; the slots are made after the rows are dealt out. With
    # a stated number of parts, which adaptive execution does not merge: few bytes become many rows.
    parts = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    beyond = (ends.filter(F.col("_next") > stop)
              .withColumn("_bucket", F.explode(F.sequence(stop, F.col("_next") - width_ms, F.lit(bucket_ms))))
              .withColumn("_from", F.col("_bucket")).repartition(parts, "symbol", "_bucket"))
    slots = F.sequence(F.col("_from"), F.least("_next", stop) - width_ms, F.lit(width_ms))
    filled = (here.unionByName(beyond).select("*", F.explode(slots).alias("_slot"))
              .withColumn("is_filled", F.col("_slot") > F.col("bar_ms")))
    blank = {name: F.when(F.col("is_filled"), F.lit(0).cast(dtype)).otherwise(F.col(name))
             for name, dtype in bars.dtypes if name in ("volume", "notional", "trades")}
    flat = {name: F.when(F.col("is_filled"), F.col("close")).otherwise(F.col(name))
            for name in ("open", "high", "low")}
    return (filled.withColumns({**flat, **blank}).withColumn("bar_ms", F.col("_slot"))
            .drop("_bucket", "_next", "_from", "_slot"))
