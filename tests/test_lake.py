import pytest
from pyspark.sql import functions as F

from tapewright.operators import bronze
from tapewright.session import fresh_path
from tapewright.sources import lake, message_log

DAY = 86_400_000


def rows(spark, *records):
    frame = spark.createDataFrame([(s, r, t, v) for s, r, t, v in records],
                                  "symbol string, record_id string, event_time bigint, v int")
    return frame.withColumn("date", F.date_format(F.timestamp_millis("event_time"), "yyyy-MM-dd"))


def content(spark, path):
    return sorted((r.symbol, r.date, r.record_id, r.event_time, r.v)
                  for r in lake.read(spark, path).collect())


def test_upsert_twice_is_upsert_once(spark):
    path = fresh_path(spark, "t")
    batch = rows(spark, ("A", "1", 5, 1), ("A", "2", 6, 1), ("B", "1", DAY + 5, 1))
    for _ in range(2):
        lake.upsert(spark, batch, path, 1)
    assert content(spark, path) == [("A", "1970-01-01", "1", 5, 1), ("A", "1970-01-01", "2", 6, 1),
                                    ("B", "1970-01-02", "1", DAY + 5, 1)]


@pytest.mark.parametrize("ordering, kept", [("event_time", 1), ("arrival", 2)])
def test_late_version(spark, ordering, kept):
    path = fresh_path(spark, "t")
    lake.upsert(spark, rows(spark, ("A", "1", 10, 1)), path, 1, ordering=ordering)
    lake.upsert(spark, rows(spark, ("A", "1", 5, 2)), path, 2, ordering=ordering)
    assert [r[4] for r in content(spark, path)] == [kept]


def test_row_that_crosses_midnight_leaves_its_old_day(spark):
    path = fresh_path(spark, "t")
    lake.upsert(spark, rows(spark, ("A", "1", DAY - 1, 1), ("B", "2", 1, 1)), path, 1)
    lake.upsert(spark, rows(spark, ("A", "1", DAY, 2)), path, 2)
    assert content(spark, path) == [("A", "1970-01-02", "1", DAY, 2), ("B", "1970-01-01", "2", 1, 1)]
    assert not lake.exists(spark, f"{path}/symbol=A/date=1970-01-01")


def test_partition_scope_keeps_both_days(spark):
    path = fresh_path(spark, "t")
    lake.upsert(spark, rows(spark, ("A", "1", DAY - 1, 1)), path, 1, scope="partition")
    lake.upsert(spark, rows(spark, ("A", "1", DAY, 2)), path, 2, scope="partition")
    assert len(content(spark, path)) == 2


def test_untouched_partitions_are_not_rewritten(spark):
    path = fresh_path(spark, "t")
    lake.upsert(spark, rows(spark, ("A", "1", 5, 1), ("B", "1", 5, 1)), path, 1)
    name = F.col("_metadata.file_path").alias("f")
    before = {r.symbol: r.f for r in lake.read(spark, path).select("symbol", name).collect()}
    lake.upsert(spark, rows(spark, ("A", "2", 6, 1)), path, 2)
    after = {r.symbol: r.f for r in lake.read(spark, path).select("symbol", name).collect()}
    assert after["B"] == before["B"] and after["A"] != before["A"]


def test_copies_are_dropped_before_the_shuffle(spark):
    batch = rows(spark, *[("A", "1", i, i) for i in range(50)])
    latest = lake.latest_per_key(batch.withColumn("_batch_id", F.lit(1)))
    assert "WindowGroupLimit" in latest._jdf.queryExecution().executedPlan().toString()
    assert [r.v for r in latest.collect()] == [49]


def test_empty_log_is_reported(spark):
    from tapewright import schemas
    empty = spark.createDataFrame([], schemas.MESSAGE_LOG)
    assert bronze.ingest(spark, empty, "unused", "t").first().status == "no_data"


def test_topic_scan_reads_one_folder(spark):
    path = fresh_path(spark, "log")
    sent = spark.createDataFrame([("A", "trade"), ("B", "trade")], "symbol string, stream_type string")
    message_log.publish(message_log.routed(sent), path=path)
    scan = message_log.bounded_scan(spark, "crypto_raw_a_trade", path=path)
    assert [r.key.decode() for r in scan.collect()] == ["A"]
    assert "PartitionFilters: [isnotnull(topic" in scan._jdf.queryExecution().executedPlan().toString()


def test_empty_first_batch_and_a_key_that_moves_ten_days(spark):
    path = fresh_path(spark, "t")
    lake.upsert(spark, rows(spark, ("A", "1", 5, 1)).limit(0), path, 0)
    lake.upsert(spark, rows(spark, ("A", "1", 5, 1), ("A", "2", 6, 1)), path, 1)
    lake.upsert(spark, rows(spark, ("A", "1", 10 * DAY, 2)), path, 2)
    assert content(spark, path) == [("A", "1970-01-01", "2", 6, 1), ("A", "1970-01-11", "1", 10 * DAY, 2)]


def test_every_log_row_is_stored_or_set_aside(spark):
    log = spark.createDataFrame(
        [('{"record_id":"1","symbol":"A","event_time":5}',), ('{"symbol":"A"}',), ("broken",)],
        "value string").withColumn("timestamp", F.lit(0).cast("timestamp"))
    path = fresh_path(spark, "bronze")
    summary = bronze.ingest(spark, log, path, "t", mode="insert").first()
    assert (summary.record_count, summary.rejected_count) == (1, 2)
    dead = spark.read.parquet(f"{path}_dead_letters")
    assert {(r.raw_text, r.reject_reason) for r in dead.collect()} == {
        ('{"symbol":"A"}', "no_record_id"), ("broken", "no_record_id")}
