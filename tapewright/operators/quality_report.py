"""Quality, latency and throughput reports over normalised rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapewright.functions.routing import bar_of

MINUTE_MS = 60_000


def report(rows: DataFrame) -> DataFrame:
    """Per (symbol, stream type), per symbol and overall.

    Copies of a record are first merged into one row with a count, by partial aggregation, so the
    duplicate rate needs no distinct aggregate. Scores add up as decimals, so a mean does not depend
    on the order of the rows.
    """
    score = F.col("data_quality_score").cast("decimal(12,6)")
    per_record = rows.groupBy("symbol", "stream_type", "record_id").agg(
        F.count("*").alias("copies"), F.sum(score).alias("score"),
        F.sum(F.when(F.col("data_quality_score") >= 0.8, 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("stream_name").isNull(), 1).otherwise(0)).alias("unnamed"))
    return per_record.rollup("symbol", "stream_type").agg(
        F.sum("copies").alias("n"), (F.sum("score").cast("double") / F.sum("copies")).alias("avg_score"),
        (F.sum("good") / F.sum("copies")).alias("good_share"),
        (F.sum("unnamed") / F.sum("copies")).alias("unnamed_rate"),
        (1 - F.count("*") / F.sum("copies")).alias("duplicate_rate"))


def profile(rows: DataFrame, nullable: tuple[str, ...] = ("trade_id", "stream_name"), edges: tuple[float, float] = (0.5, 0.8)) -> DataFrame:
    """Null rates, score buckets and score quantiles per (symbol, stream type), per symbol and overall.

    ``grouping_id`` (0, 1, 3) tells a subtotal from a missing type or symbol. Rows are first counted by score
    value, so what a group's quantiles are read from is one row a distinct score.
    """
    counts = [F.count("*").alias("c"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in nullable]]
    valued = rows.groupBy("symbol", "stream_type", F.col("data_quality_score").alias("score")).agg(*counts)
    nothing = F.lit(None).cast("string")
    levels = F.array(*[F.struct(symbol.alias("symbol"), kind.alias("stream_type"), F.lit(g).cast("bigint").alias("grouping_id"))
                       for symbol, kind, g in ((F.col("symbol"), F.col("stream_type"), 0), (F.col("symbol"), nothing, 1),
                                               (nothing, nothing, 3))])
    keys = ["grouping_id", "symbol", "stream_type"]
    sums = ["c", *[f"_{c}" for c in nullable]]
    grouped = (valued.withColumn("level", F.explode(levels)).select("level.*", "score", *sums)
               .groupBy(*keys, "score").agg(*[F.sum(c).alias(c) for c in sums]))
    known = F.when(F.col("score").isNotNull(), F.col("c")).otherwise(0)
    placed = (grouped.withColumn("upto", F.sum(known).over(W.partitionBy(*keys).orderBy("score")))
              .withColumn("known", F.sum(known).over(W.partitionBy(*keys))))

    def quantile(p: float):
        return F.min(F.when((F.col("upto") >= F.greatest(F.ceil(F.col("known") * p), F.lit(1))), F.col("score")))

    def within(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("c"))), F.lit(0))
    low, high = edges
    return placed.groupBy(*keys).agg(
        F.sum("c").alias("n"), *[(F.sum(f"_{c}") / F.sum("c")).alias(f"{c}_null_rate") for c in nullable],
        within(F.col("score") < low).alias("n_poor"), within((F.col("score") >= low) & (F.col("score") < high)).alias("n_fair"),
        within(F.col("score") >= high).alias("n_good"), quantile(0.5).alias("p50"), quantile(0.95).alias("p95"))


def latency(rows: DataFrame) -> DataFrame:
    """Received minus event time per symbol, with exact quantiles.

    Equal delays are counted first, so what meets in a symbol's task is one row a distinct delay.
    """
    delay = (F.col("received_time") - F.col("event_time")).alias("delay")
    counted = rows.select("symbol", delay).groupBy("symbol", "delay").agg(F.count("*").alias("c"))
    ordered = W.partitionBy("symbol").orderBy("delay")
    known = F.when(F.col("delay").isNotNull(), F.col("c")).otherwise(0)
    placed = (counted.withColumn("upto", F.sum(known).over(ordered))
              .withColumn("known", F.sum(known).over(W.partitionBy("symbol"))))

    def quantile(p: float):
        return F.min(F.when(F.col("upto") >= F.greatest(F.ceil(F.col("known") * p), F.lit(1)), F.col("delay")))
    return placed.groupBy("symbol").agg(
        F.sum("c").alias("n"), quantile(0.5).alias("p50_ms"), quantile(0.95).alias("p95_ms"),
        F.max("delay").alias("max_ms"))


def minute_counts(rows: DataFrame) -> DataFrame:
    return (rows.withColumn("minute_ms", bar_of(F.col("received_time"), MINUTE_MS))
            .groupBy("minute_ms", "stream_type").agg(F.count("*").alias("n")))


def throughput(rows: DataFrame, width_ms: int = 3_600_000) -> DataFrame:
    """Messages per second and window of received time, per symbol."""
    return (rows.withColumn("window_ms", bar_of(F.col("received_time"), width_ms))
            .groupBy("symbol", "window_ms").agg(F.count("*").alias("n"))
            .withColumn("per_second", F.col("n") / F.lit(width_ms / 1000.0)))
