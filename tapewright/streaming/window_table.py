"""Windows of a stream as a keyed table: every window is there at once, open ones too, and late rows count.

Each micro-batch is reduced to mergeable rows, one a window, and merged with the stored rows of the
partitions it touches. No watermark is needed, so nothing is dropped and nothing waits to be closed;
the table holds after each batch what a batch job over all rows so far would give.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapewright.functions.routing import bar_of, day_of, tick_order
from tapewright.operators.bars import WIDTHS_MS
from tapewright.session import fresh_path
from tapewright.sources import lake
from tapewright.streaming.sinks import drain_batches

MINUTE_MS = 60_000
# Partitions of the kept tables, and the slots a partition has room for: a day of minutes, sixty days of hours.
KEPT_BY = ("symbol", "period")
PERIOD_SLOTS = 1440
# Row groups of the files that arrive.
ROW_GROUP_BYTES = 16 * 1024 * 1024


def period_of(epoch_ms: Column, width_ms: int) -> Column:
    """First day of the stretch of PERIOD_SLOTS windows that a window belongs to."""
    return day_of(bar_of(epoch_ms, width_ms * PERIOD_SLOTS))


def merge_batch(spark: SparkSession, root: str, fresh: DataFrame, merge: Callable[[DataFrame], DataFrame],
                batch_id: int, partition: tuple[str, ...] = KEPT_BY) -> DataFrame:
    """Merge a batch's rows into the table ``root``/table exactly once; returns the batch as a staged table.

    ``merge`` reduces stored and fresh rows to one a key; its columns are the table's. The merged
    partitions are written aside, then put in place. A batch that is handed in again, after a crash
    at any point, finds them complete and only puts them in place again, or not and starts over from a
    table it has not touched. What was set aside goes when a later batch begins.
    """
    aside = f"{root}/aside/batch={batch_id}"
    staged = f"{root}/fresh/batch={batch_id}"
    done = lake.exists(spark, f"{aside}/_SUCCESS")
    if not done:
        lake.drop(spark, f"{root}/aside")
        lake.drop(spark, f"{root}/fresh")
        fresh.write.mode("overwrite").parquet(staged)
    batch = spark.read.schema(fresh.schema).parquet(staged)
    if batch.isEmpty():
        return batch
    if not done:
        rows = batch
        if lake.exists(spark, f"{root}/table"):
            period = partition[-1]
            touched = batch.select(*partition).distinct()
            first, last = touched.agg(F.min(period), F.max(period)).first()
            stored = (lake.read(spark, f"{root}/table").filter(F.col(period).between(first, last))
                      .join(touched, list(partition), "left_semi"))
            rows = stored.unionByName(batch)
        merge(rows).write.mode("overwrite").parquet(aside)
    lake.replace_partitions(spark.read.parquet(aside), f"{root}/table", partition)
    return batch


def _merged_bars(rows: DataFrame) -> DataFrame:
    return rows.groupBy("symbol", "period", "bar_ms").agg(
        F.min_by("open", "_first").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "_last").alias("close"), F.sum("volume").alias("volume"),
        F.sum("notional").alias("notional"), F.sum("trades").alias("trades"),
        F.min("_first").alias("_first"), F.max("_last").alias("_last"))


def _tick_bars(ticks: DataFrame, width_ms: int) -> DataFrame:
    """Each tick as a bar of its own, with the places of its first and last tick."""
    order = tick_order(F.col("event_time"), F.col("trade_id"))
    return (ticks.select("symbol", bar_of(F.col("event_time"), width_ms).alias("bar_ms"), *[
        F.col("price").alias(c) for c in ("open", "high", "low", "close")], F.col("quantity").alias("volume"),
        (F.col("price") * F.col("quantity")).alias("notional"), F.lit(1).cast("bigint").alias("trades"),
        order.alias("_first"), order.alias("_last")).withColumn("period", period_of(F.col("bar_ms"), width_ms)))


def keep_bars(ticks: DataFrame, root: str, checkpoint: str, width: str = "1h") -> None:
    """Bars of a tick stream, kept up to date below ``root``. Ticks are taken as they come: deduplicate before."""
    spark, width_ms = ticks.sparkSession, WIDTHS_MS[width]

    def handle(batch: DataFrame, batch_id: int) -> None:
        merge_batch(spark, root, _merged_bars(_tick_bars(batch, width_ms)), _merged_bars, batch_id)
    drain_batches(ticks, handle, checkpoint)


def read_bars(spark: SparkSession, root: str) -> DataFrame:
    return lake.read(spark, f"{root}/table").drop("_first", "_last", "period")


def _merged_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("period", "minute_ms", "stream_type").agg(F.sum("n").alias("n"))


def keep_minute_counts(rows: DataFrame, root: str, checkpoint: str) -> None:
    """Messages per type and minute of received time, kept up to date below ``root``.

    Only the two columns go into the stream: a batch's plan is fixed there, so columns nobody counts would be computed.
    """
    spark = rows.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        minute = bar_of(F.col("received_time"), MINUTE_MS).alias("minute_ms")
        ones = batch.select("stream_type", minute, F.lit(1).cast("bigint").alias("n")).withColumn("period", period_of(F.col("minute_ms"), MINUTE_MS))
        merge_batch(spark, root, _merged_counts(ones), _merged_counts, batch_id, ("period",))
    drain_batches(rows.select("stream_type", "received_time"), handle, checkpoint)


def read_minute_counts(spark: SparkSession, root: str) -> DataFrame:
    return lake.read(spark, f"{root}/table").drop("period")


def _apart(rows: DataFrame, delay_ms: int) -> DataFrame:
    """Of copies of a key, those at least the delay after the copy before them, and the first."""
    before = F.lag("event_time").over(W.partitionBy("symbol", "_key").orderBy("event_time"))
    return (rows.dropDuplicates(["symbol", "_key", "event_time"]).withColumn("_gap", F.col("event_time") - before)
            .filter(F.col("_gap").isNull() | (F.col("_gap") >= delay_ms)).drop("_gap"))


def keep_first(trades: DataFrame, root: str, checkpoint: str, delay_ms: int = 600_000) -> None:
    """One row per (symbol, trade id) among copies closer together than the delay, kept below ``root``.

    Trades without an id are told apart by their record id, or by all they hold where there is none. There
    is no watermark: a row of any age is compared with the stored days its delay reaches, so late trades
    are kept and their copies are not. A batch writes a folder of its own and reads those of earlier
    batches only, so a repeated batch gives the same rows.
    """
    spark = trades.sparkSession
    own = [F.col("record_id")] if "record_id" in trades.columns else []
    record = F.coalesce(*own, F.to_json(F.struct(*trades.columns)))
    key = F.when(F.col("trade_id").isNull(), F.concat(F.lit("record "), record)).otherwise(
        F.col("trade_id").cast("string"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        fresh = _apart(batch.withColumn("_key", key), delay_ms).withColumn("period", day_of(F.col("event_time")))
        if batch_id and lake.exists(spark, f"{root}/kept"):
            reach = F.array_distinct(F.array(*[day_of(F.col("event_time") + d) for d in (-delay_ms, 0, delay_ms)]))
            days = batch.select(F.explode(reach).alias("period")).distinct()
            stored = lake.read(spark, f"{root}/kept").filter(F.col("batch").cast("bigint") < batch_id).join(
                days, "period", "left_semi").select(F.col("symbol").alias("_symbol"), F.col("_key").alias("_known"), F.col("event_time").alias("_at"))
            fresh = fresh.join(stored, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("_key") == F.col("_known"))
                               & (F.abs(F.col("event_time") - F.col("_at")) < delay_ms), "left_anti")
        fresh.write.mode("overwrite").partitionBy("period").parquet(f"{root}/kept/batch={batch_id}")
    drain_batches(trades, handle, checkpoint)


def read_first(spark: SparkSession, root: str) -> DataFrame:
    return lake.read(spark, f"{root}/kept").drop("batch", "period", "_key")


def arrivals(rows: DataFrame, key: str, batches: int, label: str = "arrivals") -> DataFrame:
    """``rows`` as a stream of that many files, dealt by a hash of ``key``, one a batch: no batch is in time order.

    A file of dense rows is a single split, so a batch is dealt out to all cores as it is read; small
    row groups let several tasks read a large file.
    """
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, label)
    part = F.pmod(F.xxhash64(key), F.lit(batches))
    (rows.withColumn("_part", part).repartition(batches, "_part").sortWithinPartitions("_part").write
     .option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("_part").parquet(path))
    return (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(path).repartition(spark.sparkContext.defaultParallelism))
