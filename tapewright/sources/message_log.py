"""Kafka (when its connector is installed) or Parquet message logs with the same row shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright import schemas
from tapewright.functions.routing import topic_name


def bounded_scan(spark: SparkSession, topic: str, servers: str | None = None,
                 path: str | None = None, starting: str = "earliest",
                 ending: str = "latest") -> DataFrame:
    """Everything in one topic. Parquet logs are partitioned by topic, so one topic is pruned."""
    if servers:
        return (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("subscribe", topic).option("startingOffsets", starting)
                .option("endingOffsets", ending).load())
    return spark.read.parquet(path).filter(F.col("topic") == topic)


def live_source(spark: SparkSession, pattern: str | None = None, servers: str | None = None,
                path: str | None = None) -> DataFrame:
    if servers:
        return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("subscribePattern", pattern).option("startingOffsets", "earliest").load())
    stream = spark.readStream.schema(schemas.MESSAGE_LOG).parquet(path)
    return stream.filter(F.col("topic").rlike(pattern)) if pattern else stream


def routed(rows: DataFrame) -> DataFrame:
    """key, value, topic of normalised rows. The key keeps one symbol's messages in order."""
    return rows.select(
        F.col("symbol").cast("binary").alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        topic_name(F.col("symbol"), F.col("stream_type")).alias("topic"))


def publish(messages: DataFrame, servers: str | None = None, path: str | None = None) -> None:
    if servers:
        (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("kafka.acks", "all").option("kafka.retries", "3")
         .option("kafka.compression.type", "gzip").save())
        return
    (messages.hint("rebalance", "topic").write.mode("append").partitionBy("topic")
     .option("compression", "gzip").parquet(path))
