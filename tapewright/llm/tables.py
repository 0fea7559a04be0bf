"""Helpers the operators share: staged tables, content keys, running totals without hot tasks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.session import fresh_path

# A word is a run of characters that are neither a blank nor one of the five control characters.
WORD = "[^\\x20\\x09-\\x0D]+"
# Rows that one ordered slice should hold; it sizes slices and decides no result.
SLICE_ROWS = 4096


def stage(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` below the shared folder and read it back: short lineage, computed once."""
    path = fresh_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def stable_hash(column: Column) -> Column:
    """A 60-bit number from the MD5 of a value's text; the same in any SQL engine, null gives 0."""
    digits = F.substring(F.md5(column.cast("string")), 1, 15)
    return F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(0).cast("long"))


def slice_bits(rows: int) -> int:
    """Bits of a 60-bit hash that cut ``rows`` rows into slices of about SLICE_ROWS."""
    return max(0, math.ceil(math.log2(max(1, rows) / SLICE_ROWS)))


def running_total(frame: DataFrame, group: list[str], key: str, order: list[Column], value: str,
                  rows: int) -> DataFrame:
    """Adds ``slice``, ``spot`` (place in its slice) and ``total`` (of ``value`` up to the row).

    The order inside a group is (``key``, then ``order``); ``key`` is a 60-bit hash. Slices of the
    hash are summed first, so a group of any size is ordered in many small tasks, and only one
    row a slice meets in the task of a group. Group columns must not be null.
    """
    bits = slice_bits(rows)
    cut = F.shiftright(F.col(key), 60 - bits) if bits else F.lit(0).cast("long")
    sliced = frame.withColumn("slice", cut)
    keys = [*group, "slice"]
    before = Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sliced.groupBy(*keys).agg(F.sum(value).alias("in_slice"))
               .select(*keys, F.coalesce(F.sum("in_slice").over(before), F.lit(0)).alias("start")))
    inside = Window.partitionBy(*keys).orderBy(key, *order)
    return (sliced.join(offsets, keys)
            .withColumn("spot", F.row_number().over(inside))
            .withColumn("total", F.col("start") + F.sum(value).over(
                inside.rowsBetween(Window.unboundedPreceding, 0)))
            .drop("start"))
