"""Table schemas of the bronze layer and of the message log."""

from pyspark.sql import types as T

BRONZE = T.StructType([
    T.StructField("record_id", T.StringType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("stream_type", T.StringType(), False),
    T.StructField("event_time", T.LongType(), False),
    T.StructField("received_time", T.LongType(), False),
    T.StructField("date", T.StringType(), False),
    T.StructField("raw_data", T.StringType(), True),
    T.StructField("data_quality_score", T.DoubleType(), True),
])

# What Spark's Kafka source yields; offline message logs use the same shape.
MESSAGE_LOG = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

SYMBOLS = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("priority", T.IntegerType(), False),
    T.StructField("enabled", T.BooleanType(), False),
    T.StructField("streams", T.ArrayType(T.StringType()), False),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
