"""EMA, RSI and the anomaly score of streamed bars, exact for bars that come late, twice or out of order.

Bars land in a keyed table. Beside it stands one checkpoint a symbol and period: position, close, averages and
the last closes as of the period's last bar. A batch makes a symbol dirty from its earliest new bar on; from
the checkpoint of the period before, that symbol's periods are replayed with the same windows the batch
indicators use. Values and checkpoints depend on the bars alone, so a repeated batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.operators.bars import WIDTHS_MS
from tapewright.operators.series import Chunks, ema_decay, one_run, with_position
from tapewright.sources import lake
from tapewright.streaming.sinks import drain_batches
from tapewright.streaming.window_table import KEPT_BY, merge_batch, period_of

CHECKPOINT = ("symbol string, period string, bar_ms bigint, pos bigint, close double, ema double, up double, "
              "down double, tail array<struct<bar_ms: bigint, close: double>>")


def _latest(rows: DataFrame) -> DataFrame:
    """A bar that comes again replaces the one before it."""
    return rows.groupBy("symbol", "period", "bar_ms").agg(
        F.max_by("close", "_batch").alias("close"), F.max("_batch").alias("_batch"))


class Indicators:
    """What is kept of a stream of (symbol, bar_ms, close) below ``root``."""

    def __init__(self, spark: SparkSession, root: str, width: str = "1h", span: int = 12, n: int = 14,
                 window: int = 20, limit: float = 3.0):
        self.spark, self.root, self.width_ms = spark, root, WIDTHS_MS[width]
        self.span, self.n, self.window, self.limit = span, n, window, limit
        self._size = one_run(ema_decay(span), 1.0 - 1.0 / n)
        if self._size is None:
            raise ValueError("the two averages forget at too unlike a pace to be kept together")

    def follow(self, bars: DataFrame, checkpoint: str) -> None:
        drain_batches(bars, self.take, checkpoint)

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: store its bars, then replay what they change."""
        rows = batch.select("symbol", period_of(F.col("bar_ms"), self.width_ms).alias("period"), "bar_ms", F.col("close").cast("double").alias("close"),
                            F.lit(batch_id).cast("bigint").alias("_batch"))
        # Of two closes for one bar in a batch the greater stays, so a repeated batch decides alike.
        once = rows.groupBy("symbol", "period", "bar_ms", "_batch").agg(F.max("close").alias("close"))
        taken = merge_batch(self.spark, f"{self.root}/bars", once, _latest, batch_id)
        dirty = taken.groupBy("symbol").agg(F.min("period").alias("dirty_from"))
        if not taken.isEmpty():
            self._replay(dirty)

    def values(self) -> DataFrame:
        """symbol, bar_ms, close, ema, rsi, zscore, is_anomaly of all bars so far."""
        return lake.read(self.spark, f"{self.root}/values").drop("period")

    def _checkpoints(self) -> DataFrame:
        path = f"{self.root}/checkpoints"
        return lake.read(self.spark, path) if lake.exists(self.spark, path) else self.spark.createDataFrame([], CHECKPOINT)

    def _replay(self, dirty: DataFrame) -> None:
        first = dirty.agg(F.min("dirty_from")).first()[0]
        # A checkpoint from before both averages have started is of no use: its symbol is young and starts over.
        seeds = (self._checkpoints().join(dirty, "symbol")
                 .filter((F.col("period") < F.col("dirty_from")) & (F.col("pos") >= self.n))
                 .groupBy("symbol").agg(F.max_by(F.struct("pos", "ema", "up", "down", "tail"), "bar_ms").alias("seed")))
        known = dirty.join(seeds, "symbol", "left")
        bars = lake.read(self.spark, f"{self.root}/bars/table").drop("_batch")
        old = bars.filter(F.col("period") >= first).join(known.filter("seed is not null"), "symbol").filter("period >= dirty_from")
        young = bars.join(known.filter("seed is null"), "symbol")
        counted = with_position(old.unionByName(young), self.width_ms).select(
            "symbol", "period", "bar_ms", "close", "dirty_from",
            (F.col("pos") + F.coalesce(F.col("seed.pos") + 1, F.lit(0))).alias("pos"),
            F.lit(False).alias("before"), *[F.lit(None).cast("double").alias(c) for c in ("ema_seed", "up_seed", "down_seed")])
        last = F.col("i") == F.size("seed.tail") - 1
        tails = (known.filter("seed is not null").select("symbol", "dirty_from", "seed", F.posexplode("seed.tail").alias("i", "bar"))
                 .select("symbol", F.lit(None).cast("string").alias("period"), "bar.bar_ms", "bar.close", "dirty_from",
                         (F.col("seed.pos") - F.size("seed.tail") + 1 + F.col("i")).alias("pos"), F.lit(True).alias("before"),
                         *[F.when(last, F.col(f"seed.{c}")).alias(f"{c}_seed") for c in ("ema", "up", "down")]))
        to_score = counted.unionByName(tails)
        to_score.write.mode("overwrite").parquet(f"{self.root}/to_score")
        rows = self._scored(self.spark.read.schema(to_score.schema).parquet(f"{self.root}/to_score")).filter(~F.col("before") & (F.col("period") >= F.col("dirty_from")))
        aside = f"{self.root}/replayed"
        rows.drop("before", "dirty_from").write.mode("overwrite").parquet(aside)
        replayed = self.spark.read.parquet(aside)
        lake.replace_partitions(replayed.groupBy("symbol", "period").agg(
            F.max_by(F.struct("bar_ms", "pos", "close", "ema", "up", "down", "tail"), "bar_ms").alias("end"))
            .select("symbol", "period", "end.*"), f"{self.root}/checkpoints", KEPT_BY)
        lake.replace_partitions(replayed.select("symbol", "period", "bar_ms", "close", "ema", "rsi", "zscore", "is_anomaly"),
                                f"{self.root}/values", KEPT_BY)

    def _scored(self, rows: DataFrame) -> DataFrame:
        """Adds ema, up, down, rsi, zscore, is_anomaly and tail; rows ``before`` carry what a checkpoint left."""
        n, ema, wilder = self.n, ema_decay(self.span), 1.0 - 1.0 / self.n
        chunks = Chunks(rows, max(n, self.window), self._size)
        move = F.col("close") - F.lag("close").over(chunks.ordered)
        frame = chunks.previous(self.window)
        rows = (chunks.rows.withColumn("_move", move)
                .withColumns({"_gain": F.greatest(F.col("_move"), F.lit(0.0)), "_loss": F.greatest(-F.col("_move"), F.lit(0.0))})
                .withColumns({"_mean": F.avg("close").over(frame), "_sd": F.stddev_samp("close").over(frame),
                              "tail": F.collect_list(F.struct("bar_ms", "close")).over(chunks.last(self.window))}))

        def fed(name: str, start: Column, later: Column) -> Column:
            left = F.coalesce(F.col(f"{name}_seed"), F.lit(0.0))
            return F.when(F.col("before"), left).otherwise(F.coalesce(start, later))

        def wild(name: str, column: str) -> Column:
            seed = F.avg(column).over(chunks.last(n))
            start = F.when(F.col("pos") < n, 0.0).when(F.col("pos") == n, seed)
            return fed(name, start, F.coalesce(F.col(column), F.lit(0.0)) / n)
        rows = rows.withColumns({"_up": wild("up", "_gain"), "_down": wild("down", "_loss"),
                                 "_ema": fed("ema", F.when(F.col("pos") == 0, F.col("close")), F.lit(1.0 - ema) * F.col("close"))})
        z = F.when((F.col("pos") >= self.window) & (F.col("_sd") > 0), (F.col("close") - F.col("_mean")) / F.col("_sd"))
        rows = rows.withColumn("zscore", z).withColumn("is_anomaly", F.coalesce(F.abs("zscore") > self.limit, F.lit(False)))
        rows = chunks.recurrence(rows, {"ema": ("_ema", ema), "up": ("_up", wilder), "down": ("_down", wilder)})
        value = (F.when((F.col("up") == 0) & (F.col("down") == 0), 50.0).when(F.col("down") == 0, 100.0)
                 .otherwise(100.0 - 100.0 / (1.0 + F.col("up") / F.col("down"))))
        return rows.withColumn("rsi", F.when(F.col("pos") >= n, value)).select(
            "symbol", "period", "bar_ms", "close", "pos", "ema", "up", "down", "rsi", "zscore", "is_anomaly", "tail",
            "before", "dirty_from")
