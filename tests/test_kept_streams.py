"""Tables kept up to date by streams: equal to batch whatever the order, the repeats and the crashes."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tapewright.session import fresh_path
from tapewright.sources import lake
from tapewright.streaming import sinks, window_table
from tapewright.streaming.indicator_state import Indicators

HOUR = 3_600_000
BAR = "symbol string, bar_ms bigint, close double"
TICK = "symbol string, event_time bigint, trade_id bigint, price double, quantity double"


def plain(closes, span=12, n=14, window=20):
    """(ema, rsi, z) by one step a bar."""
    out, ema, up, down = [], None, None, None
    moves = [b - a for a, b in zip(closes, closes[1:])]
    for i, close in enumerate(closes):
        ema = close if ema is None else ema + (close - ema) * 2 / (span + 1)
        gain, loss = (max(moves[i - 1], 0.0), max(-moves[i - 1], 0.0)) if i else (0.0, 0.0)
        if i == n:
            up, down = (sum(max(s * m, 0.0) for m in moves[:n]) / n for s in (1, -1))
        elif i > n:
            up, down = (up * (n - 1) + gain) / n, (down * (n - 1) + loss) / n
        rsi = None if i < n else 50.0 if up == down == 0 else 100.0 if down == 0 else 100 - 100 / (1 + up / down)
        past = closes[max(0, i - window):i]
        sd = statistics.stdev(past) if i >= window else 0
        out.append((ema, rsi, (close - statistics.fmean(past)) / sd if sd > 0 else None))
    return out


def same(kept, bars):
    got = sorted(map(tuple, kept.values().select("symbol", "bar_ms", "close", "ema", "rsi", "zscore", "is_anomaly").collect()))
    want = []
    for symbol in sorted({s for s, _ in bars}):
        times = sorted(t for s, t in bars if s == symbol)
        closes = [bars[symbol, t] for t in times]
        want += [(symbol, t, c, *v, v[2] is not None and abs(v[2]) > 3) for t, c, v in zip(times, closes, plain(closes))]
    assert [g[:3] for g in got] == [w[:3] for w in want] and [g[6] for g in got] == [w[6] for w in want]
    for g, w in zip(got, want):
        for x, y in zip(g[3:6], w[3:6]):
            assert (x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9))


def test_late_repeated_and_corrected_bars(spark):
    rng = random.Random(4)
    kept, bars = Indicators(spark, fresh_path(spark, "test-indicators")), {}
    first = 1_700_000_000_000 // HOUR * HOUR
    price = {s: 100.0 for s in "AB"}
    series = []
    for k in range(3000):  # over two periods of 1,440 hours
        for s in "AB":
            price[s] += rng.choice([-1.5, 0.0, 0.25, 2.0, 30.0 if rng.random() < 0.01 else 0.5])
            series.append((s, first + k * HOUR, price[s]))
    young = [("C", first + k * HOUR, 5.0 + k % 3) for k in range(9)]
    held = set(rng.sample(range(len(series)), 12)) | {len(series) - 1}
    batches = [[r for i, r in enumerate(series) if i not in held and r[1] < first + 2900 * HOUR] + young[:4],
               [r for i, r in enumerate(series) if i not in held and r[1] >= first + 2900 * HOUR] + young[5:],
               [r for i, r in enumerate(series) if i in held and r[1] > first + 1500 * HOUR] + [young[4]],
               [("A", first - 5 * HOUR, 99.0), ("B", first + 2999 * HOUR, 1.0), ("B", first + 2999 * HOUR, 1.0)],
               []]
    for number, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, BAR).repartition(3)
        bars.update({(s, t): c for s, t, c in rows})
        kept.take(frame, number)
        if number in (1, 3):
            kept.take(frame, number)  # the same batch once more
        same(kept, bars)


def test_windows_equal_batch_in_any_order(spark):
    rng = random.Random(2)
    ticks = [("S%d" % (i % 2), 1_700_000_000_000 + rng.randrange(9) * 1000 + rng.randrange(3) * HOUR, i, float(rng.randrange(50)), 1.0)
             for i in range(300)] + [("S0", 1_700_000_000_000, None, 7.0, 2.0)]
    frame = spark.createDataFrame(ticks, TICK)
    root = fresh_path(spark, "test-windows")
    for _ in range(2):  # the second run finds nothing new
        window_table.keep_bars(window_table.arrivals(frame, "event_time", 4) if _ == 0 else stream, root, f"{root}/checkpoint")
        stream = window_table.arrivals(frame.filter("false"), "event_time", 1)
    got = {(r.symbol, r.bar_ms): (r.open, r.high, r.low, r.close, r.volume, r.trades) for r in window_table.read_bars(spark, root).collect()}
    want = {}
    for s, t, i, p, q in sorted(ticks, key=lambda r: (r[1], -1 if r[2] is None else r[2])):
        o, h, low, _, v, n = want.get((s, t - t % HOUR), (p, p, p, p, 0.0, 0))
        want[s, t - t % HOUR] = (o, max(h, p), min(low, p), p, v + q, n + 1)
    assert got == want


@pytest.mark.parametrize("crash", ["before aside", "half aside", "after aside", "done"])
def test_batch_counts_once_after_a_crash(spark, monkeypatch, crash):
    root = fresh_path(spark, "test-crash")
    schema = "symbol string, period string, k long, n long"

    def merge(rows):
        return rows.groupBy("symbol", "period", "k").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n")

    def give(number):
        window_table.merge_batch(spark, root, spark.createDataFrame([("a", "p", 1, 1), ("b", "p", 2, 1)], schema), merge, number)
    give(0)
    with monkeypatch.context() as patch:
        if crash != "done":
            patch.setattr(lake, "replace_partitions", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("crash")))
        if crash == "done":
            give(1)
        else:
            with pytest.raises(RuntimeError):
                give(1)
    if crash == "before aside":
        lake.drop(spark, f"{root}/aside")
    if crash == "half aside":
        lake.drop(spark, f"{root}/aside/batch=1/_SUCCESS")
    give(1)
    assert sorted(tuple(r) for r in lake.read(spark, f"{root}/table").select("symbol", "k", "n").collect()) == [("a", 1, 2), ("b", 2, 2)]
    give(2)
    assert {r.n for r in lake.read(spark, f"{root}/table").collect()} == {3}


def test_copies_are_dropped_and_late_trades_kept(spark):
    day, minute = 86_400_000, 60_000
    batches = [[("A", 1, day - 1, 1.0), ("A", 2, 5 * day, 2.0), ("A", None, 7, 3.0), (None, 9, 10, 9.0)],
               # The copy of 1 lies behind midnight; 3 is older than all before; 1 comes again an hour later.
               [("A", 1, day + 1, 1.0), ("A", 3, 20, 4.0), ("A", 1, day + 60 * minute, 1.0), ("A", None, 7, 3.5)],
               [("A", 3, 19, 4.0), ("A", 3, 21, 4.0), ("A", None, 7, 3.0), (None, 9, 11, 9.0), ("B", 3, 20, 5.0), ("B", 3, 20, 5.0)]]
    root, schema = fresh_path(spark, "test-first"), "symbol string, trade_id bigint, event_time bigint, price double"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        window_table.keep_first(stream, root, f"{root}/checkpoint")
    want = sorted([*batches[0], *batches[1][1:], ("B", 3, 20, 5.0)], key=str)
    assert sorted(map(tuple, window_table.read_first(spark, root).select(
        "symbol", "trade_id", "event_time", "price").collect()), key=str) == want


def test_all_cores_share_a_batch(spark):
    seen = []

    def handle(batch, number):
        seen.append([tuple(r) for r in batch.select("k", F.spark_partition_id()).collect()])
    rows = spark.range(6000).select((F.col("id") % 2000).alias("k"))
    sinks.drain_batches(window_table.arrivals(rows, "k", 3), handle, fresh_path(spark, "test-arrivals"))
    assert sorted(k for batch in seen for k, _ in batch) == sorted(3 * list(range(2000)))
    assert sum(len({k for k, _ in batch}) for batch in seen) == 2000
    assert len(seen) == 3 and all(len({part for _, part in batch}) == 8 for batch in seen)


def test_minute_counts_compute_no_other_column(spark):
    root = fresh_path(spark, "test-minutes")
    rows = spark.createDataFrame([(60_000 * (i % 3) + i, "trade" if i % 2 else None, i) for i in range(60)],
                                 "received_time bigint, stream_type string, k bigint")
    stream = window_table.arrivals(rows, "k", 2).withColumn("_never", F.raise_error(F.lit("computed")))
    window_table.keep_minute_counts(stream, root, f"{root}/checkpoint")
    assert {tuple(r) for r in window_table.read_minute_counts(spark, root).select("minute_ms", "stream_type", "n").collect()} == {
        (m * 60_000, kind, 10) for m in range(3) for kind in ("trade", None)}
