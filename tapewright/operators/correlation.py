"""Pairwise return correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pairwise(returns: DataFrame) -> DataFrame:
    """(symbol_a < symbol_b, bars, correlation) over the bars both have.

    An equi-join on the bar; Spark's correlation updates means and co-moments, so large levels
    lose no digits, and pairs are summed up before they are shuffled. NULL where a side is
    constant or fewer than two bars are shared.
    """
    known = returns.filter(F.col("ret").isNotNull())
    a = known.select("bar_ms", F.col("symbol").alias("symbol_a"), F.col("ret").alias("a"))
    b = known.select("bar_ms", F.col("symbol").alias("symbol_b"), F.col("ret").alias("b"))
    pairs = a.join(b, "bar_ms").filter("symbol_a < symbol_b").groupBy("symbol_a", "symbol_b").agg(
        F.count("*").alias("bars"), F.corr("a", "b").alias("r"),
        (F.least(F.max("a") - F.min("a"), F.max("b") - F.min("b")) > 0).alias("varied"))
    return pairs.select("symbol_a", "symbol_b", "bars", F.when(
        (F.col("bars") >= 2) & F.col("varied") & ~F.isnan("r"), F.col("r")).alias("correlation"))
