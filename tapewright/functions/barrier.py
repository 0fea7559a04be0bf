"""A boundary the optimizer keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def barrier(rows: DataFrame) -> DataFrame:
    """Each row unchanged, through a generator.

    A later filter on a computed column stays above it, instead of being pushed down as a second
    copy of the computation. The code on either side also lands in methods of its own: the JVM
    does not compile methods over 8,000 bytes of bytecode, and interprets them many times slower.
    """
    return rows.select(F.inline(F.array(F.struct("*"))))
