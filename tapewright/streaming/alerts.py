"""Alert rules: stateless ones over normalised rows, and one over scored bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright import feed_values as fv
from tapewright.streaming.sinks import drain_batches, replace_batch


def rules(rows: DataFrame, keep: tuple[str, ...] = (), min_score: float = fv.QUALITY_THRESHOLD,
          large_notional: float = 10_000.0) -> DataFrame:
    """One row per message and rule it breaks."""
    rejected = F.col("reject_reason").isNotNull()
    notional = F.col("price") * F.col("quantity")
    raised = F.array_compact(F.array(
        F.when(rejected, F.struct(F.lit("rejected").alias("rule"), F.lit(0.0).alias("measure"))),
        F.when(~rejected & (F.col("data_quality_score") < min_score),
               F.struct(F.lit("low_quality").alias("rule"),
                        F.col("data_quality_score").alias("measure"))),
        F.when(notional >= large_notional,
               F.struct(F.lit("large_trade").alias("rule"), notional.alias("measure")))))
    return rows.select(*keep, "symbol", "received_time", F.inline(raised))


def from_anomalies(scored: DataFrame) -> DataFrame:
    return scored.filter("is_anomaly").select(
        "symbol", F.col("bar_ms").alias("received_time"), F.lit("price_anomaly").alias("rule"),
        F.col("zscore").alias("measure"))


def watch(rows: DataFrame, path: str, checkpoint: str, keep: tuple[str, ...] = ()) -> None:
    drain_batches(rows, lambda batch, batch_id: replace_batch(rules(batch, keep), path, batch_id),
                  checkpoint)
