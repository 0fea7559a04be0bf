"""Ordered computations over long series without gathering one key in one task.

Two patterns. ``carried`` splits a key's rows by time bucket and hands each bucket the state its
predecessors leave behind. ``chunked`` cuts a series into runs of rows and repeats the rows a
frame reaches back to at the head of the next run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapewright.session import fresh_path

# Bars of one bucket: at most this many, since a slot holds one bar.
BUCKET_BARS = 1440
# Exponent span of one run's scaled sums: e**600 is far from overflow, and a run's own last values
# outweigh what came two runs earlier by more than a double resolves.
SPAN = 600.0
# What is older than this many times the decay's own length is below the resolution of a double: e**-80.
RESOLVED = 80.0


def bucket_states(rows: DataFrame, key: str, bucket: str, **state: Column) -> DataFrame:
    """One row per (key, bucket): a partial aggregate, so small whatever the tick count."""
    return rows.groupBy(key, bucket).agg(*[value.alias(name) for name, value in state.items()])


def before_bucket(key: str, bucket: str):
    """All earlier buckets of a key. One row a bucket, so a calendar bounds the group."""
    return W.partitionBy(key).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)


def time_parts(rows: DataFrame, order: list[str | Column], label: str) -> DataFrame:
    """Adds ``_part``: consecutive stretches of ``rows`` in ``order``, of nearly equal numbers of rows.

    The borders come from Spark's sample of the whole order, so a busy symbol has many short stretches
    and quiet ones share a stretch. The rows are read once and written, so parts stay what they are.
    """
    path = fresh_path(rows.sparkSession, label)
    cut = rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    cut.write.parquet(path)
    return rows.sparkSession.read.schema(cut.schema).parquet(path)


def with_position(bars: DataFrame, width_ms: int, key: str = "symbol",
                  time: str = "bar_ms") -> DataFrame:
    """Add ``pos``: 0, 1, 2 ... per key in time order."""
    rows = bars.withColumn("_bucket", F.floor(F.col(time) / F.lit(width_ms * BUCKET_BARS)))
    before = bucket_states(rows, key, "_bucket", _n=F.count("*")).select(
        key, "_bucket",
        F.coalesce(F.sum("_n").over(before_bucket(key, "_bucket")), F.lit(0)).alias("_before"))
    local = F.row_number().over(W.partitionBy(key, "_bucket").orderBy(time))
    return (rows.withColumn("_local", local).join(before, [key, "_bucket"])
            .withColumn("pos", F.col("_before") + F.col("_local") - 1)
            .drop("_bucket", "_local", "_before"))


class Chunks:
    """Rows of ``positioned`` in runs of ``size`` per key, each led by ``halo`` earlier rows."""

    def __init__(self, positioned: DataFrame, halo: int, size: int, key: str = "symbol"):
        self.halo, self.size, self.key = halo, size, key
        own = F.floor(F.col("pos") / F.lit(size))
        reach = F.floor((F.col("pos") + F.lit(halo)) / F.lit(size))
        self.rows = (positioned
                     .select("*", F.explode(F.sequence(own, reach)).alias("_chunk"))
                     .withColumn("_lead", F.col("_chunk") * F.lit(size) > F.col("pos"))
                     # Offset inside the run, counted from the first lead row.
                     .withColumn("_k", F.col("pos") - F.col("_chunk") * F.lit(size) + F.lit(halo)))
        self._by = W.partitionBy(key, "_chunk").orderBy("pos")

    def last(self, n: int):
        return self._by.rowsBetween(-n + 1, 0)

    def previous(self, n: int):
        return self._by.rowsBetween(-n, -1)

    @property
    def ordered(self):
        return self._by

    def recurrence(self, rows: DataFrame, inputs: dict[str, tuple[str, float]], ratio: bool = False) -> DataFrame:
        """Add, per name -> (input, decay), the sum of decay**age * input over this and all earlier rows; lead rows go.

        A run adds up its own values, scaled by decay**-k, and receives what its predecessors left:
        one row a run, read in order. That is the sum of the last run with a value other than 0 and
        of the run before it; all older ones are below its resolution, since runs are as long as
        SPAN allows (``one_run`` says which decays may share a run). Flat stretches of any length therefore
        change nothing. With ``ratio`` the sums of a row, of one decay, may share a positive factor, so that
        their ratio outlives sums that become 0.
        """
        own = rows.filter(~F.col("_lead"))
        own = own.withColumns({name: F.col(value) for name, (value, decay) in inputs.items() if decay <= 0.0})
        inputs = {name: given for name, given in inputs.items() if given[1] > 0.0}
        if not inputs:
            return own
        place = F.col("_k") - F.lit(self.halo)
        to_end = F.lit(self.size - 1) - place
        ends = own.groupBy(self.key, "_chunk").agg(*[
            F.coalesce(F.sum(F.col(value) * F.pow(F.lit(decay), to_end)), F.lit(0.0)).alias(name)
            for name, (value, decay) in inputs.items()])
        in_order = W.partitionBy(self.key).orderBy("_chunk")
        lives = F.lit(False)
        for name in inputs:
            lives = lives | (F.col(name) != 0)
        totals = [(F.col(name) + F.lit(decay ** self.size) * F.coalesce(F.lag(name).over(in_order), F.lit(0.0)))
                  .alias(name) for name, (_, decay) in inputs.items()]
        left = F.when(lives, F.struct(F.col("_chunk").alias("run"), *totals))
        carry = (ends.select(self.key, "_chunk", left.alias("_left"))
                 .select(self.key, "_chunk", F.last("_left", ignorenulls=True).over(
                     in_order.rowsBetween(W.unboundedPreceding, -1)).alias("_left")))
        so_far = self._by.rowsBetween(W.unboundedPreceding, 0)
        local = {}
        for name, (value, decay) in inputs.items():
            grow = F.pow(F.lit(1.0 / decay), place)
            local[f"_own_{name}"] = F.coalesce(F.sum(F.col(value) * grow).over(so_far) / grow, F.lit(0.0))
        age = (F.col("_chunk") - F.col("_left.run") - 1) * F.lit(self.size) + place + 1
        silent = F.lit(ratio)
        for name in local:
            silent = silent & (F.col(name) == 0)

        def whole(name: str, decay: float) -> Column:
            # No run before leaves null, which counts as nothing.
            faded = F.coalesce(F.col(f"_left.{name}") * F.pow(F.lit(decay), age), F.lit(0.0))
            return F.coalesce(F.when(silent, F.col(f"_left.{name}")).otherwise(F.col(f"_own_{name}") + faded), F.lit(0.0))
        return (own.withColumns(local).join(carry, [self.key, "_chunk"])
                .withColumns({name: whole(name, decay) for name, (_, decay) in inputs.items()})
                .drop("_left", *local))

    def finish(self, rows: DataFrame) -> DataFrame:
        return rows.filter(~F.col("_lead")).drop("_lead", "_chunk", "_k")


def ema_decay(span: int) -> float:
    return 1.0 - 2.0 / (span + 1)


def run_length(decay: float) -> int:
    """Rows of a run whose scaled sums stay finite."""
    return max(1, math.floor(SPAN / -math.log(decay))) if decay > 0.0 else 4096


def one_run(*decays: float) -> int | None:
    """Length of runs that serve all these decays, or None where the slowest outlasts two runs of the fastest."""
    size = min(map(run_length, decays))
    return size if all(d <= 0.0 or 2 * size * -math.log(d) >= RESOLVED for d in decays) else None
