"""Partitioned Parquet tables: append, upsert and incremental read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapewright.session import fresh_path

PARTITION = ("symbol", "date")
KEY = ("symbol", "record_id")
ORDERINGS = {"event_time": ("event_time", "_batch_id"), "arrival": ("_batch_id", "event_time")}


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    file_system, target = _file_system(spark, path)
    return file_system.exists(target)


def drop(spark: SparkSession, path: str) -> None:
    file_system, target = _file_system(spark, path)
    file_system.delete(target, True)


def _write(rows: DataFrame, path: str, mode: str, partition) -> None:
    """Rebalance on the partition columns: few files a partition, and a big one is split."""
    (rows.hint("rebalance", *partition).write.mode(mode).partitionBy(*partition)
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def replace_partitions(rows: DataFrame, path: str, partition=PARTITION) -> None:
    """Overwrite the partitions that ``rows`` holds; ``rows`` must not be read from ``path``."""
    _write(rows, path, "overwrite", partition)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Partition columns stay text, whatever they look like."""
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(setting, before)


def latest_per_key(rows: DataFrame, key=KEY, ordering: str = "event_time") -> DataFrame:
    """One row per key. The rank filter lets Spark drop losers before the shuffle, so many copies
    of one key do not gather in one task."""
    order = [F.desc(c) for c in (*ORDERINGS[ordering], "_offset") if c in rows.columns]
    return (rows.withColumn("_rank", F.row_number().over(W.partitionBy(*key).orderBy(*order)))
            .filter("_rank = 1").drop("_rank"))


def insert(rows: DataFrame, path: str, batch_id: int = 0, partition=PARTITION) -> None:
    """Append without looking for earlier copies."""
    _write(rows.withColumn("_batch_id", F.lit(batch_id).cast("bigint")), path, "append", partition)


def upsert(spark: SparkSession, rows: DataFrame, path: str, batch_id: int = 0, key=KEY,
           partition=PARTITION, ordering: str = "event_time", scope: str = "key") -> None:
    """Merge ``rows`` into the table at ``path``, one row per key.

    ``ordering`` decides between two versions of a key: by event time (late rows lose) or by
    arrival. ``scope="key"`` also finds a stored version filed under any other day;
    ``scope="partition"`` looks only at the same partition. An empty batch changes nothing. Only partitions that change are
    rewritten. The merge is staged as a table first: the input of an overwrite must not be the
    path it overwrites, and a lost executor then recomputes nothing. Repeating a call is harmless.
    The changed partitions, emptied ones too, are noted by batch beside the table before they change.
    """
    match = list(key) if scope == "key" else list(dict.fromkeys((*partition, *key)))
    day = partition[-1]
    stage = fresh_path(spark, "upsert")
    batch = rows.withColumn("_batch_id", F.lit(batch_id).cast("bigint"))
    latest_per_key(batch, match, ordering).write.parquet(f"{stage}/incoming")
    incoming = spark.read.parquet(f"{stage}/incoming")
    if incoming.isEmpty():  # writes no folder without a schema, and changes nothing
        drop(spark, stage)
        return
    if not exists(spark, path):
        _note(incoming.select(*partition).distinct(), path, batch_id)
        _write(incoming, path, "overwrite", partition)
        drop(spark, stage)
        return

    # Partitions that get rows, and those that hold an earlier version of a key on any day; for
    # the latter only the key columns are read.
    touched = incoming.select(*partition)
    if scope == "key":
        held = read(spark, path).select(*dict.fromkeys((*partition, *key)))
        touched = touched.union(held.join(incoming.select(*match), match, "left_semi").select(*partition))
    touched = touched.distinct()
    first, last = touched.agg(F.min(day), F.max(day)).first()
    stored = (read(spark, path).filter(F.col(day).between(first, last))
              .join(touched, list(partition), "left_semi"))
    both = incoming.withColumn("_stored", F.lit(False)).unionByName(
        stored.withColumn("_stored", F.lit(True)), allowMissingColumns=True)
    order = [F.desc(c) for c in (*ORDERINGS[ordering], "_offset") if c in both.columns]
    rank = F.row_number().over(W.partitionBy(*match).orderBy(*order, "_stored"))
    both.withColumn("_rank", rank).write.parquet(f"{stage}/ranked")

    ranked = spark.read.parquet(f"{stage}/ranked")
    changed = (ranked.filter("(_rank = 1 AND NOT _stored) OR (_rank > 1 AND _stored)")
               .select(*partition).distinct())
    _note(changed, path, batch_id)
    winners = ranked.filter("_rank = 1").drop("_rank", "_stored")
    _write(winners.join(changed, list(partition), "left_semi"), path, "overwrite", partition)
    # A dynamic overwrite never empties a partition: drop those whose last row moved away.
    drop_partitions(spark, path, changed.join(winners, list(partition), "left_anti"), partition)
    drop(spark, stage)


def _note(changed: DataFrame, path: str, batch_id: int) -> None:
    """Appended, so a repeated batch, which changes nothing more, takes nothing back."""
    changed.write.mode("append").parquet(f"{path}_changes/batch={batch_id}")


def drop_partitions(spark: SparkSession, path: str, gone: DataFrame, partition=PARTITION) -> None:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for row in gone.select(*partition).toLocalIterator():
        drop(spark, "/".join([path, *(f"{c}={escape(str(row[c]))}" for c in partition)]))


def changed_since(spark: SparkSession, path: str, last_batch: int, partition=PARTITION) -> DataFrame:
    """Partitions that upserts of later batches than ``last_batch`` changed."""
    return (spark.read.parquet(f"{path}_changes").filter(F.col("batch") > last_batch)
            .select(*partition).distinct())


def since(spark: SparkSession, path: str, last_batch: int) -> DataFrame:
    """Rows that arrived after batch ``last_batch``."""
    return read(spark, path).filter(F.col("_batch_id") > last_batch)
