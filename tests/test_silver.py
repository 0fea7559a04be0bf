"""Incremental silver, and the regression on several lags."""

import pathlib

import numpy as np
import pytest

from tapewright.operators import bars, indicators, silver
from tapewright.session import fresh_path
from tapewright.sources import lake

HOUR, DAY = 3_600_000, 86_400_000
FIRST = 1_700_006_400_000  # midnight
TICK = "symbol string, record_id string, event_time bigint, trade_id bigint, price double, quantity double, date string"


def ticks(spark, rows):
    days = {t: str(np.datetime64(t, "ms").astype("datetime64[D]")) for _, _, t, _ in rows}
    return spark.createDataFrame([(s, str(i), t, i, float(p), 1.0, days[t]) for s, i, t, p in rows], TICK)


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in pathlib.Path(path.removeprefix("file:")).rglob("*.parquet")}


def whole(spark, root):
    rebuilt = bars.from_ticks(lake.read(spark, f"{root}/bronze"), "1h")
    return sorted(map(tuple, rebuilt.select("symbol", "bar_ms", "open", "close", "trades").collect()))


def test_only_changed_partitions_are_rebuilt(spark):
    root = fresh_path(spark, "test-silver")
    batches = [
        [("A", 1, FIRST, 5), ("A", 2, FIRST + DAY, 6), ("B", 3, FIRST, 7), ("B", 4, FIRST + 2 * DAY, 8)],
        [("A", 5, FIRST + 10, 9), ("B", 4, FIRST + 3 * DAY, 8)],  # a late tick; a tick that moves and leaves its day empty
        [("A", 1, FIRST + 1, 50)],  # a corrected price
    ]
    touched = [set(), {"symbol=A/date=2023-11-15", "symbol=B/date=2023-11-17", "symbol=B/date=2023-11-18"}, {"symbol=A/date=2023-11-15"}]
    for batch, rows in enumerate(batches):
        before = files(f"{root}/silver") if batch else {}
        lake.upsert(spark, ticks(spark, rows), f"{root}/bronze", batch)
        silver.refresh(spark, f"{root}/bronze", f"{root}/silver", batch - 1)
        after = files(f"{root}/silver")
        found = lake.read(spark, f"{root}/silver").select("symbol", "bar_ms", "open", "close", "trades")
        assert sorted(map(tuple, found.collect())) == whole(spark, root)
        if batch:
            changed = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
            assert {"/".join(f.split("/")[-3:-1]) for f in changed} == touched[batch]
    lake.upsert(spark, ticks(spark, batches[2]), f"{root}/bronze", 2)  # the same batch once more
    silver.refresh(spark, f"{root}/bronze", f"{root}/silver", 1)
    assert sorted(map(tuple, lake.read(spark, f"{root}/silver").select("symbol", "bar_ms", "open", "close", "trades").collect())) \
        == whole(spark, root)
    assert silver.refresh(spark, f"{root}/bronze", f"{root}/silver", 2).count() == 0


@pytest.mark.parametrize("lags", [1, 2, 4])
def test_lag_regression_is_least_squares(spark, lags):
    rng = np.random.default_rng(lags)
    close = 100 + np.cumsum(rng.standard_normal(300))
    rows = [("A", k * HOUR, float(c)) for k, c in enumerate(close)] + [("flat", k * HOUR, 5.0) for k in range(40)]
    rows += [("short", k * HOUR, 5.0 + k) for k in range(lags)]
    fit = {r.symbol: r for r in indicators.lag_regression(
        spark.createDataFrame(rows, "symbol string, bar_ms bigint, close double"), "1h", lags).collect()}
    x = np.column_stack([np.ones(300 - lags), *[close[lags - k:300 - k] for k in range(1, lags + 1)]])
    want = np.linalg.lstsq(x, close[lags:], rcond=None)[0]
    got = [fit["A"].intercept, *[fit["A"][f"beta_{k}"] for k in range(1, lags + 1)]]
    np.testing.assert_allclose(got, want, rtol=1e-7, atol=1e-8)
    assert fit["A"].forecast == pytest.approx(want[0] + want[1:] @ close[::-1][:lags])
    assert fit["A"].n == 300 - lags and "short" not in fit and fit["flat"].forecast is None
