"""Scans and streams over the message log."""

from tapewright.session import fresh_path
from tapewright.sources import message_log


def test_one_topic_reads_one_folder(spark):
    path = fresh_path(spark, "test-log")
    log = spark.sql("SELECT CAST('k' AS binary) AS key, CAST('v' AS binary) AS value, concat('t', id % 5) AS topic, "
                    "0 AS partition, id AS offset, timestamp_millis(id) AS timestamp, 0 AS timestampType FROM range(50)")
    message_log.publish(log, path=path)
    scan = message_log.bounded_scan(spark, "t3", path=path)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan and "(topic" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert sorted(r.offset for r in scan.collect()) == list(range(3, 50, 5))
