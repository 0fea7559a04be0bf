"""Reports over the message log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapewright import feed_values as fv


def inventory(log: DataFrame, family: str = fv.TOPIC_FAMILY) -> DataFrame:
    return (log.filter(F.startswith("topic", F.lit(family))).select("topic").distinct()
            .orderBy("topic"))


def counts(log: DataFrame) -> DataFrame:
    """Messages per topic as the sum of end offsets over its partitions, and as rows."""
    per_partition = log.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("end_offset"), F.count("*").alias("n"))
    return per_partition.groupBy("topic").agg(
        F.sum("end_offset").alias("end_offsets"), F.sum("n").alias("messages"))


def first_message(log: DataFrame) -> DataFrame:
    """The first message per topic; the rank filter is applied before the shuffle."""
    order = W.partitionBy("topic").orderBy("partition", "offset")
    text = F.col("value").cast("string")
    return (log.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1")
            .select("topic", "partition", "offset",
                    F.get_json_object(text, "$.symbol").alias("symbol"),
                    F.get_json_object(text, "$.stream_type").alias("stream_type")))


def first_with_key(log: DataFrame, key: str) -> DataFrame:
    """Stop at the first message with ``key``: a top-1 per task, then one row."""
    return (log.filter(F.col("key").cast("string") == key)
            .orderBy("timestamp", "topic", "partition", "offset").limit(1))
