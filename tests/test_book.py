"""Order-book levels that cannot count: they are told apart and never the best."""

import pytest
from pyspark.sql import functions as F

from tapewright.functions.feed_json import levels as typed
from tapewright.operators import book


def snapshots(spark, bids, asks):
    rows = spark.createDataFrame([(1, bids, asks)], "id int, b array<array<string>>, a array<array<string>>")
    return rows.select("id", typed("b").alias("bids"), typed("a").alias("asks"))


FAULTY = [["NaN", "1"], ["9.5d", "1"], [None, "1"], ["inf", "1"], ["1e999", "1"], ["100", "NaN"], ["100", None],
          ["101", "0.00"], [" 1_0.5 ", "2"], ["7"], []]
REASONS = ["no_price"] * 5 + ["no_quantity"] * 2 + ["no_size", None, "no_quantity", "no_price"]


def test_every_level_says_why_it_does_not_count(spark):
    rows = book.levels(snapshots(spark, FAULTY, None)).orderBy("level").collect()
    assert [r.level_fault for r in rows] == REASONS and {r.side for r in rows} == {"bid"}


def test_faulty_levels_are_never_the_best(spark):
    row = book.imbalance(snapshots(spark, FAULTY + [["10.0", "6"]], FAULTY + [["11", "4"]])).first()
    assert (row.bid, row.bid_qty, row.ask, row.ask_qty) == (10.5, 2.0, 10.5, 2.0)
    assert row.imbalance == pytest.approx((8 - 6) / 14)


def test_no_sound_level(spark):
    row = book.imbalance(snapshots(spark, FAULTY[:8], []).withColumn("asks", F.when(F.lit(False), F.col("asks")))).first()
    assert row.bid is None and row.ask is None and row.mid is None and row.microprice is None
