"""Long and lopsided series against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapewright.operators import bars, correlation, indicators, trades
from tapewright.operators.series import time_parts, with_position

N, WIDTH = 6000, "1m"


def closes(count=N, seed=1):
    rng = random.Random(seed)
    level, slot, out = 100.0, 0, []
    for _ in range(count):
        level = max(1.0, level + rng.gauss(0, 1))
        slot += rng.choice([1, 1, 1, 2, 400])
        out.append((slot * 60_000, level))
    return out


@pytest.fixture(scope="module")
def series():
    return {"HOT": closes(), "COLD": closes(37, 2)}


@pytest.fixture(scope="module")
def frame(spark, series):
    rows = [(s, t, c, c, c, c, 1.0, c, 1) for s, values in series.items() for t, c in values]
    return spark.createDataFrame(
        rows, "symbol string, bar_ms bigint, open double, high double, low double, close double, "
              "volume double, notional double, trades bigint").repartition(8)


def column(result, name, symbol):
    return [r[name] for r in result.filter(result.symbol == symbol).orderBy("bar_ms").collect()]


def same(found, expected):
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert (a is None) == (b is None)
        if a is not None:
            assert a == pytest.approx(b, rel=1e-9, abs=1e-9)


def plain_ema(values, span):
    alpha, out = 2 / (span + 1), []
    for v in values:
        out.append(v if not out else out[-1] * (1 - alpha) + v * alpha)
    return out


def plain_rsi(values, n=14):
    out, up, down = [None] * len(values), 0.0, 0.0
    moves = [b - a for a, b in zip(values, values[1:])]
    for i, move in enumerate(moves, start=1):
        gain, loss = max(move, 0), max(-move, 0)
        if i <= n:
            up, down = up + gain / n, down + loss / n
        else:
            up, down = (up * (n - 1) + gain) / n, (down * (n - 1) + loss) / n
        if i >= n:
            out[i] = 50.0 if up == down == 0 else 100.0 if down == 0 else 100 - 100 / (1 + up / down)
    return out


@pytest.mark.parametrize("symbol", ["HOT", "COLD"])
def test_positions(frame, series, symbol):
    assert column(with_position(frame, 60_000), "pos", symbol) == list(range(len(series[symbol])))


@pytest.mark.parametrize("symbol", ["HOT", "COLD"])
def test_indicators_across_runs(frame, series, symbol):
    values = [c for _, c in series[symbol]]
    same(column(indicators.sma(frame, WIDTH), "sma", symbol),
         [None if i < 19 else float(np.mean(values[i - 19:i + 1])) for i in range(len(values))])
    same(column(indicators.ema(frame, WIDTH), "ema", symbol), plain_ema(values, 12))
    same(column(indicators.rsi(frame, WIDTH), "rsi", symbol), plain_rsi(values))
    line = [a - b for a, b in zip(plain_ema(values, 12), plain_ema(values, 26))]
    found = indicators.macd(frame, WIDTH)
    same(column(found, "macd", symbol), line)
    same(column(found, "signal", symbol), plain_ema(line, 9))
    same(column(indicators.returns(frame, WIDTH), "simple_return", symbol),
         [None] + [b / a - 1 for a, b in zip(values, values[1:])])
    same(column(indicators.rolling_volatility(frame, WIDTH), "rolling_volatility", symbol),
         [None if i < 20 else float(np.std([values[j] / values[j - 1] - 1
                                            for j in range(i - 19, i + 1)], ddof=1))
          for i in range(len(values))])


def test_flat_series_has_neutral_strength(spark):
    flat = spark.createDataFrame([("A", i * 60_000, 5.0) for i in range(30)],
                                 "symbol string, bar_ms bigint, close double")
    assert set(column(indicators.rsi(flat, WIDTH), "rsi", "A")[14:]) == {50.0}


def test_recurrences_outlive_flat_stretches_of_several_runs(spark):
    """RSI keeps its value over any flat stretch, as exact arithmetic would, and moves on after it."""
    from fractions import Fraction
    moving = [v for _, v in closes(40, 4)]
    values = moving + [moving[-1]] * 26_000 + [moving[-1] + v for v in (1.0, -0.25, 2.0)] + [moving[-1] + 2.0] * 9_000
    rows = spark.createDataFrame([("A", i * 60_000, v) for i, v in enumerate(values)],
                                 "symbol string, bar_ms bigint, close double").repartition(4)
    found = column(indicators.rsi(rows, WIDTH), "rsi", "A")
    before = plain_rsi(moving)[-1]
    assert all(v == pytest.approx(before, rel=1e-9) for v in found[40:26_040])
    moves = [Fraction(b) - Fraction(a) for a, b in zip(values[26_038:26_043], values[26_039:26_043])]
    # The old averages have faded to e**-1900 of the new moves.
    late = [(Fraction(13, 14) ** (len(moves) - 1 - i), m) for i, m in enumerate(moves)]
    up, down = (sum(w * max(sign * m, 0) for w, m in late) for sign in (1, -1))
    expected = float(100 - 100 / (1 + up / down))
    assert all(v == pytest.approx(expected, rel=1e-9) for v in found[26_042:])


@pytest.mark.parametrize("spans", [(50, 200, 9), (1, 3, 2), (2, 1000, 5)])
def test_macd_with_any_spans(frame, series, spans):
    fast, slow, signal = spans
    values = [c for _, c in series["HOT"]]
    line = [a - b for a, b in zip(plain_ema(values, fast), plain_ema(values, slow))]
    found = indicators.macd(frame, WIDTH, fast, slow, signal)
    same(column(found, "macd", "HOT"), line)
    same(column(found, "signal", "HOT"), plain_ema(line, signal))


def test_strength_of_one_move(frame, series):
    values = [c for _, c in series["COLD"]]
    same(column(indicators.rsi(frame, WIDTH, n=1), "rsi", "COLD"), plain_rsi(values, 1))


def test_filled_series_is_gapless(frame, series):
    filled = bars.fill_gaps(frame, WIDTH)
    times = column(filled, "bar_ms", "COLD")
    first, last = series["COLD"][0][0], series["COLD"][-1][0]
    assert times == list(range(first, last + 1, 60_000))
    assert column(indicators.sma(frame, WIDTH, fill=True), "pos", "COLD") == list(range(len(times)))


def test_bars_aggregate_by_hash_and_roll_up_equals_direct(spark):
    rng = random.Random(3)
    ticks = spark.createDataFrame(
        [(rng.choice("AAAAB"), rng.randrange(0, 7_200_000, 500), i, float(rng.randrange(100)), 1.0)
         for i in range(5000)],
        "symbol string, event_time bigint, trade_id bigint, price double, quantity double")
    minute = bars.from_ticks(ticks, "1m")
    plan = minute._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    rolled = sorted(map(tuple, bars.roll_up(minute, "1h").select(
        "symbol", "bar_ms", *bars.VALUES).collect()))
    direct = sorted(map(tuple, bars.from_ticks(ticks, "1h").select(
        "symbol", "bar_ms", *bars.VALUES).collect()))
    assert rolled == direct and len(rolled) == 4


def test_klines_of_two_intervals_and_a_late_open_version(spark):
    rows = [("A", "1m", 0, 10, "r1", True, 1.0), ("A", "1h", 0, 20, "r2", True, 2.0), ("A", "1m", 0, 30, "r3", False, 3.0),
            ("A", None, 0, 10, "r4", True, 4.0), ("A", "1m", 60_000, 70, "r5", False, 5.0), ("A", "1m", None, 9, "r6", True, 6.0)]
    klines = spark.createDataFrame(rows, "symbol string, interval string, bar_open_time bigint, event_time bigint, "
                                         "record_id string, is_closed boolean, close double").selectExpr(
        "*", "close AS open", "close AS high", "close AS low", "1.0D AS volume")
    found = sorted((r["interval"] or "", r.bar_ms, r.close) for r in bars.bars_from_klines(klines).collect())
    assert found == [("", 0, 4.0), ("1h", 0, 2.0), ("1m", 0, 1.0)]


def test_gaps_and_asof_against_brute_force(spark):
    rng = random.Random(5)
    ticks = [("H" if i % 3 else "C", rng.randrange(10_000_000), i, float(i)) for i in range(800)]
    frame = spark.createDataFrame(
        ticks, "symbol string, event_time bigint, trade_id bigint, price double")
    found = {r.trade_id: r.gap_ms for r in trades.intertrade_time(frame).collect()}
    for symbol in "HC":
        ordered = sorted((t, i) for s, t, i, _ in ticks if s == symbol)
        for (before, _), (now, i) in zip([(None, None), *ordered], ordered):
            assert found[i] == (None if before is None else now - before)
    probes = [("H" if i % 2 else "C", rng.randrange(-100, 11_000_000), i) for i in range(300)]
    probes.append(("NONE", 5, 999))
    asked = spark.createDataFrame(probes, "symbol string, probe_time bigint, probe_id int")
    priced = {r.probe_id: r.asof_price for r in trades.asof_price(asked, frame).collect()}
    assert len(priced) == len(probes)
    for symbol, at, probe in probes:
        known = [(t, i, p) for s, t, i, p in ticks if s == symbol and t <= at]
        assert priced[probe] == (max(known)[2] if known else None)


def test_correlation_with_missing_bars(spark):
    rng = np.random.default_rng(0)
    data = {s: {d: float(v) for d, v in enumerate(rng.normal(size=60)) if rng.random() > 0.2}
            for s in "ABCD"}
    frame = spark.createDataFrame([(s, d, v) for s, days in data.items() for d, v in days.items()],
                                  "symbol string, bar_ms bigint, ret double")
    rows = {(r.symbol_a, r.symbol_b): r for r in correlation.pairwise(frame).collect()}
    assert len(rows) == 6
    for (a, b), row in rows.items():
        both = sorted(set(data[a]) & set(data[b]))
        expected = np.corrcoef([data[a][d] for d in both], [data[b][d] for d in both])[0, 1]
        assert row.bars == len(both) and row.correlation == pytest.approx(expected, abs=1e-9)
        assert not math.isnan(row.correlation)


def test_gaps_over_bucket_borders(spark):
    minute, day = 60_000, 86_400_000
    # A year without a bar, a gap that ends on a border, one that starts on it, neighbours over a border.
    starts = {"A": [0, minute, 365 * day + 7 * minute], "B": [day - 3 * minute, day, day + minute, 2 * day - minute, 2 * day],
              "C": [5 * day], None: [3 * minute, 2 * day + minute]}
    frame = spark.createDataFrame(
        [(s, t, float(i + 1), 2.0, 3) for s, times in starts.items() for i, t in enumerate(times)],
        "symbol string, bar_ms long, close double, volume double, trades long").withColumns(
            {name: F.col("close") for name in ("open", "high", "low")})
    filled = bars.fill_gaps(frame, "1m")
    assert set(filled.columns) == {*frame.columns, "is_filled"}
    rows = filled.groupBy("symbol").agg(
        F.count("*").alias("n"), F.countDistinct("bar_ms").alias("slots"), F.min("bar_ms").alias("low"),
        F.max("bar_ms").alias("high"), F.count_if("is_filled").alias("made"),
        F.sum("volume").alias("volume"), F.sum("trades").alias("trades")).collect()
    for r in rows:
        times = starts[r["symbol"]]
        n = (times[-1] - times[0]) // minute + 1
        assert (r["n"], r["slots"], r["low"], r["high"]) == (n, n, times[0], times[-1])
        assert (r["made"], r["volume"], r["trades"]) == (n - len(times), 2.0 * len(times), 3 * len(times))
    kept = filled.filter("symbol = 'A' and bar_ms > 60000 and is_filled").agg(
        F.min("close"), F.max("open")).first()
    assert tuple(kept) == (2.0, 2.0)
    parts = filled.filter("symbol = 'A'").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 4


def test_parts_of_a_busy_symbol_are_even(spark):
    """Half of the ticks are one symbol's, most of them within a second; no part has twice its share."""
    rng = random.Random(9)
    ticks = [("HOT", rng.randrange(1000) if i % 4 else rng.randrange(10**9), i, float(i)) for i in range(20_000)]
    ticks += [(f"S{i % 50}", rng.randrange(10**9), i, float(i)) for i in range(20_000, 40_000)]
    frame = spark.createDataFrame(ticks, "symbol string, event_time bigint, trade_id bigint, price double").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = time_parts(frame, ["symbol", "event_time", "trade_id"], "test-parts")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [r["n"] for r in cut.groupBy("_part").agg(F.count("*").alias("n")).collect()]
    assert len(parts) == 8 and sum(parts) == len(ticks) and max(parts) < 2 * len(ticks) / len(parts)


def test_asof_without_symbol_or_time(spark):
    ticks = spark.createDataFrame([("A", 10, 1, 1.0), (None, 5, 2, 2.0), ("A", None, 3, 3.0)],
                                  "symbol string, event_time bigint, trade_id bigint, price double")
    probes = spark.createDataFrame([("A", 10, 1), ("A", 9, 2), (None, 50, 3), ("A", None, 4)],
                                   "symbol string, probe_time bigint, probe_id int")
    assert {r.probe_id: r.asof_price for r in trades.asof_price(probes, ticks).collect()} == {1: 1.0, 2: None, 3: None, 4: None}
    assert trades.asof_price(probes, ticks.filter("false")).filter("asof_price is not null").count() == 0
