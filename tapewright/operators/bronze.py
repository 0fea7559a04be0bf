"""Bronze ingest: message log -> fixed-schema rows -> partitioned table, with a run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tapewright import schemas
from tapewright.functions.routing import with_event_date_parts
from tapewright.session import fresh_path
from tapewright.sources import lake

# Columns without which a row cannot be filed.
REQUIRED = ("record_id", "symbol", "event_time")
SUMMARY = ("status string, table_name string, symbols bigint, record_count bigint, "
           "rejected_count bigint")


def parse_fixed(log: DataFrame, schema=schemas.BRONZE) -> DataFrame:
    """Every log row: bronze columns, log time, the whole text, and why it cannot be filed.

    Text that does not parse gives NULL columns; ``reject_reason`` names the first missing column.
    """
    text = F.col("value").cast("string")
    rows = log.select(text.alias("raw_text"), F.col("timestamp").alias("kafka_timestamp"),
                      F.from_json(text, schema).alias("event"))
    reason = F.coalesce(*[F.when(F.col(f"event.{c}").isNull(), F.lit(f"no_{c}")) for c in REQUIRED])
    return rows.select("event.*", "kafka_timestamp", "raw_text", reason.alias("reject_reason"))


def ingest(spark: SparkSession, log: DataFrame, path: str, table_name: str, batch_id: int = 0,
           mode: str = "upsert") -> DataFrame:
    """Parse, date-stamp and write one batch; returns a one-row summary.

    Every row ends in the table or, with its whole text and a reason, in the folder
    ``<path>_dead_letters``. The log is parsed once into a staged table; the counts are observed
    while that is written.
    """
    if log.isEmpty():
        return spark.createDataFrame([("no_data", table_name, 0, 0, 0)], SUMMARY)
    seen, staged = Observation("ingest"), fresh_path(spark, "bronze_batch")
    parse_fixed(log).observe(
        seen, F.count_if(F.col("reject_reason").isNull()).alias("accepted"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected")).write.parquet(staged)
    parsed, counts = spark.read.parquet(staged), seen.get
    rows = with_event_date_parts(parsed.filter("reject_reason IS NULL")
                                 .drop("reject_reason", "raw_text"))
    if mode == "upsert":
        lake.upsert(spark, rows, path, batch_id)
    else:
        lake.insert(rows, path, batch_id)
    (parsed.filter("reject_reason IS NOT NULL").select("raw_text", "reject_reason", "kafka_timestamp")
     .write.mode("overwrite").parquet(f"{path}_dead_letters/batch={batch_id}"))
    symbols = parsed.filter("reject_reason IS NULL").select("symbol").distinct().count()
    lake.drop(spark, staged)
    return spark.createDataFrame([("success", table_name, symbols, counts["accepted"],
                                   counts["rejected"])], SUMMARY)
