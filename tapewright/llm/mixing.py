"""Mixing sources to target weights by weighted fair queueing (operator 1, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm.tables import WORD, running_total, stable_hash, stage

WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
MAX_COPIES = 2


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            budget_percent: int = BUDGET_PERCENT, max_copies: int = MAX_COPIES) -> DataFrame:
    """Adds ``source_no``, ``weight`` and ``target`` to (``source``, ``source_size``).

    Weights go round the sources by code point, null last. The budget is shared by weight; what a
    source cannot take (``max_copies`` times its size) is reshared. That is the water level: with
    sources ordered by cap / weight, the first whose share stays below its cap sets the level for
    all that follow. One row a source meets in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = (sources.withColumn("source_no", F.row_number().over(by_name) - 1)
                .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                   F.col("source_no") % len(weights) + 1))
                .withColumn("cap", F.col("source_size") * max_copies))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * budget_percent / 100
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    return (numbered.withColumn("level", level)
            .withColumn("water", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"),
                                              F.col("level"))).over(everything))
            .withColumn("target", F.coalesce(
                F.least(F.col("weight") * F.col("water"), F.col("cap").cast("double")),
                F.col("cap").cast("double")))
            .select("source", "source_size", "source_no", "weight", "target"))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS,
         budget_percent: int = BUDGET_PERCENT, max_copies: int = MAX_COPIES) -> DataFrame:
    """How often the mix takes each document.

    Every source queues its documents in hashed order, ``max_copies`` rounds of them. A document's
    virtual finish time is the words its source has queued up to it over the source's weight. All
    entries are range-sorted by finish time into slices; slices are taken while the running total
    stays within the budget, and the slice that crosses it is read in order.

    Returns doc_id, source, size, row_key (hash of all columns), source_size, target, copies, taken.
    Null or empty texts have size 0 and take nothing. A null source is a source of its own, last in
    order. Repeated rows are queued one by one; equal rows are interchangeable, so reruns agree. An
    empty table gives an empty plan. Extra columns matter only as tie-breaks between equal ids.
    """
    narrow = stage(docs.select(
        docs["doc_id"].alias("doc_id"), docs["source"].alias("source"),
        F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(*[docs[c] for c in docs.columns]).alias("row_key"),
        stable_hash(docs["doc_id"]).alias("place")), "mix-sizes")
    rows = narrow.count()
    # Salted by the hash first: a source with a third of all rows is summed in many tasks.
    sources = stage(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")),
                            weights, budget_percent, max_copies), "mix-targets")
    numbered = narrow.join(
        F.broadcast(sources) if sources.count() <= 10_000 else sources,
        narrow["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    queued = running_total(numbered, ["source_no"], "place",
                           [F.col("doc_id"), F.col("row_key")], "size", rows)
    entries = (queued.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_copies - 1))))
               .withColumn("finish", (F.col("copy") * F.col("source_size") + F.col("total"))
                           / F.col("weight")))
    order = ["finish", "source_no", "place", "doc_id", "row_key", "copy", "spot"]
    ranged = stage(entries.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("part", F.spark_partition_id()), "mix-order")

    # One row a part: their number is the shuffle's partitions, whatever the data.
    parts = sorted((r["part"], r["words"] or 0) for r in
                   ranged.groupBy("part").agg(F.sum("size").alias("words")).collect())
    budget = sum(words for _, words in parts) / max_copies * budget_percent / 100
    done, crossing = 0, -1
    for part, words in parts:
        if done + words > budget:
            crossing = part
            break
        done += words
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    edge = (ranged.filter(F.col("part") == crossing)
            .withColumn("in", F.sum("size").over(inside) + done <= budget))
    sure = ranged.filter(F.col("part") != crossing).withColumn(
        "in", F.lit(True) if crossing < 0 else F.col("part") < crossing)
    row = ["doc_id", "source", "size", "row_key", "source_size", "target", "source_no", "slice", "spot"]
    return (sure.unionByName(edge).groupBy(*row)
            .agg(F.sum(F.col("in").cast("int")).alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .drop("source_no", "slice", "spot"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS,
        budget_percent: int = BUDGET_PERCENT, max_copies: int = MAX_COPIES) -> DataFrame:
    """The mixed documents: the rows of ``docs``, each as often as ``plan`` takes it."""
    taken = (plan(docs, weights, budget_percent, max_copies)
             .groupBy("row_key").agg(F.sum("copies").alias("__mix_copies"),
                                     F.count("*").alias("__mix_rows")))
    taken = taken.filter("__mix_copies > 0").withColumnRenamed("row_key", "__mix_key")
    keyed = docs.withColumn("__mix_key", F.xxhash64(*[docs[c] for c in docs.columns]))
    # Equal rows share their copies: the first of them get one more where it does not divide.
    again = Window.partitionBy("__mix_key").orderBy(F.lit(1))
    joined = keyed.join(taken, "__mix_key")
    once = joined.filter("__mix_rows = 1").withColumn("__mix_no", F.lit(1))
    more = joined.filter("__mix_rows > 1").withColumn("__mix_no", F.row_number().over(again))
    share = (F.col("__mix_copies") / F.col("__mix_rows")).cast("int") + F.when(
        F.col("__mix_no") <= F.col("__mix_copies") % F.col("__mix_rows"), 1).otherwise(0)
    return (once.unionByName(more).withColumn("__mix_copy", F.sequence(F.lit(1), share.cast("int")))
            .filter(share > 0).withColumn("__mix_copy", F.explode("__mix_copy"))
            .select(*docs.columns))
