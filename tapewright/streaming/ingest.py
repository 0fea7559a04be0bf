"""Continuous bronze ingest and late-row detection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright import feed_values as fv
from tapewright.operators import envelope
from tapewright.session import fresh_path
from tapewright.sources import lake
from tapewright.streaming.sinks import drain_batches, replace_batch


def bronze_writer(spark: SparkSession, root: str,
                  kinds: tuple[str, ...] = fv.EXPECTED_TYPES) -> Callable[[DataFrame, int], None]:
    """A batch handler: parse once, upsert each event type, set rejected messages aside.

    Accepted messages of any other type go to ``other``, so every message has one place.

    The parsed batch is staged as a table because several writes read it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        stage = fresh_path(spark, "parsed")
        envelope.normalize(batch).write.parquet(stage)
        parsed = spark.read.parquet(stage)
        for kind in kinds:
            lake.upsert(spark, envelope.typed_rows(parsed, kind), f"{root}/{kind}", batch_id)
        other = envelope.accepted(parsed).filter(
            ~F.coalesce(F.col("event_kind").isin(*kinds), F.lit(False))).select(*envelope.HEADER)
        lake.upsert(spark, other, f"{root}/other", batch_id)
        replace_batch(envelope.dead_letters(parsed), f"{root}/dead_letters", batch_id)
        lake.drop(spark, stage)
    return write


def ingest(messages: DataFrame, root: str, checkpoint: str,
           kinds: tuple[str, ...] = fv.EXPECTED_TYPES) -> None:
    drain_batches(messages, bronze_writer(messages.sparkSession, root, kinds), checkpoint)


def split_late(rows: DataFrame, root: str, checkpoint: str, delay_ms: int = 600_000) -> None:
    """Rows older than the newest event of earlier batches minus the delay go to ``late``.

    The newest event time is one number per batch, kept next to the output.
    """
    spark = rows.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        marks = f"{root}/newest"
        newest = None
        if lake.exists(spark, marks):
            newest = (spark.read.parquet(marks).filter(F.col("batch") < batch_id)
                      .agg(F.max("newest")).first()[0])
        is_late = F.lit(False) if newest is None else F.col("event_time") < newest - delay_ms
        stage = fresh_path(spark, "arrivals")
        batch.withColumn("is_late", is_late).write.parquet(stage)
        arrived = spark.read.parquet(stage)
        replace_batch(arrived.filter("is_late").drop("is_late"), f"{root}/late", batch_id)
        replace_batch(arrived.filter("NOT is_late").drop("is_late"), f"{root}/on_time", batch_id)
        replace_batch(arrived.agg(F.max("event_time").alias("newest")), marks, batch_id)
        lake.drop(spark, stage)

    drain_batches(rows, write, checkpoint)
