"""Warehouse export: flat, primitive columns in date partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, path: str = "", name: str = ""):
    for field in schema.fields:
        full, flat = f"{path}`{field.name}`", f"{name}{field.name}"
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, full + ".", flat + "_")
        else:
            yield full, flat, field.dataType


def flatten(rows: DataFrame) -> DataFrame:
    """Structs become ``outer_inner`` columns; arrays and maps become JSON text."""
    columns = []
    for path, flat, dtype in _leaves(rows.schema):
        value = F.col(path)
        if isinstance(dtype, (T.ArrayType, T.MapType, T.VariantType)):
            value = F.to_json(value)
        columns.append(value.alias(flat))
    return rows.select(*columns)


def export(rows: DataFrame, path: str, partition: str = "date") -> None:
    """Idempotent: a repeated export overwrites the same date partitions."""
    (flatten(rows).hint("rebalance", partition).write.mode("overwrite").partitionBy(partition)
     .option("partitionOverwriteMode", "dynamic").parquet(path))
