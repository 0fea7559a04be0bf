"""Batch and streaming reads of the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapewright import schemas
from tapewright.session import prepare


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def events_stream(spark: SparkSession, folder: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """``events`` as a file stream; the glob accepts a single file and a folder of parts."""
    reader = prepare(spark).readStream.schema(schemas.EVENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{folder}/events.parque[t]")
