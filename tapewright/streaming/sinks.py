"""Running a stream until its input is used up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def drain_to_table(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Append to a Parquet table until the source has nothing new; a restart continues."""
    query = (rows.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def drain_batches(rows: DataFrame, handle: Callable[[DataFrame, int], None],
                  checkpoint: str) -> None:
    """Hand every micro-batch to ``handle(batch, batch_id)``, which must bear repetition."""
    query = (rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def replace_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch into its own folder; a repeated batch overwrites itself."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")
