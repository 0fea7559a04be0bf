"""Silver bars maintained from the bronze partitions that changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.functions.routing import day_of
from tapewright.operators import bars
from tapewright.session import fresh_path
from tapewright.sources import lake


def refresh(spark: SparkSession, bronze: str, silver: str, after_batch: int, width: str = "1h") -> DataFrame:
    """Rebuild the bars of the (symbol, date) partitions that bronze batches after ``after_batch`` changed.

    A bar lies within one day, so a silver partition depends on the bronze partition of its name alone:
    rows that came, were replaced or moved to another day are all covered, and other files
    are neither read nor written. Partitions that bronze no longer has go. Repeating a call
    is harmless. Returns the changed partitions.
    """
    if bars.WIDTHS_MS["1d"] % bars.WIDTHS_MS[width]:
        raise ValueError("a bar must lie within one day")
    aside, keys = fresh_path(spark, "silver"), list(lake.PARTITION)
    lake.changed_since(spark, bronze, after_batch).write.parquet(f"{aside}/changed")
    changed = spark.read.schema("symbol string, date string").parquet(f"{aside}/changed")
    first, last = changed.agg(F.min("date"), F.max("date")).first()
    if first is None:
        return changed
    ticks = lake.read(spark, bronze).filter(F.col("date").between(first, last)).join(changed, keys, "left_semi")
    built = bars.from_ticks(ticks, width).withColumn("date", day_of(F.col("bar_ms")))
    built.write.parquet(f"{aside}/bars")
    staged = spark.read.schema(built.schema).parquet(f"{aside}/bars")
    lake.replace_partitions(staged, silver)
    lake.drop_partitions(spark, silver, changed.join(staged, keys, "left_anti"))
    return changed
