"""Bars, trade metrics, indicators and operational reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.functions.routing import day_of, fixed6, timestamp_of
from tapewright.operators import bars, envelope, indicators, quality_report, silver
from tapewright.operators import trades as flow
from tapewright.plans.bronze_queries import trades
from tapewright.plans.check_views import fixed6 as sql6
from tapewright.plans.check_views import over
from tapewright.plans.envelope_queries import normalized
from tapewright.plans.registry import query
from tapewright.session import fresh_path
from tapewright.sources import feed, lake
from tapewright.sources.tables import table

def start():
    return timestamp_of(F.col("bar_ms")).alias("bar_start")


def six(*names: str):
    return [fixed6(F.col(n)).alias(n) for n in names]


def sql_bars(width_ms: int, source: str = "trades") -> str:
    return f"""bars AS (
  SELECT symbol, event_time - event_time % {width_ms} AS bar_ms,
    arg_min(price, (event_time, trade_id)) AS open, max(price) AS high, min(price) AS low,
    arg_max(price, (event_time, trade_id)) AS close, sum(quantity) AS volume,
    sum(price * quantity) AS notional, count(*) AS trades
  FROM {source} GROUP BY 1, 2)"""


SQL_START = "make_timestamp(bar_ms * 1000) AS bar_start"
BY = "OVER (PARTITION BY symbol ORDER BY bar_ms"
HOURLY = sql_bars(bars.WIDTHS_MS["1h"])


def hourly(spark, folder) -> DataFrame:
    return bars.from_ticks(trades(spark, folder), "1h")


def _ohlcv(width: str) -> None:
    width_ms = bars.WIDTHS_MS[width]

    @query(f"ohlcv_{width}", over("trades", f"""
SELECT symbol, {SQL_START}, open, high, low, close, volume, {sql6("notional")} AS notional, trades
FROM bars""", sql_bars(width_ms)))
    def ohlcv(spark, folder):
        rows = bars.from_ticks(trades(spark, folder), "1m")
        if width != "1m":
            rows = bars.roll_up(rows, width)
        return rows.select("symbol", start(), "open", "high", "low", "close", "volume",
                           *six("notional"), "trades")


for _width in bars.WIDTHS_MS:
    _ohlcv(_width)


@query("fills_ohlcv_1d", f"""
WITH fills AS (
  SELECT p_brand AS symbol, epoch_us(l_shipdate) // 1000 AS event_time, l_orderkey, l_linenumber,
         l_partkey, l_suppkey, l_extendedprice, l_extendedprice / l_quantity AS price,
         l_quantity AS quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT symbol, make_timestamp((event_time - event_time % 86400000) * 1000) AS bar_start,
  {sql6("arg_min(price, (event_time, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice))")}
    AS open, {sql6("max(price)")} AS high, {sql6("min(price)")} AS low,
  {sql6("arg_max(price, (event_time, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice))")}
    AS close, sum(quantity) AS volume, count(*) AS trades
FROM fills GROUP BY 1, 2""")
def fills_ohlcv_1d(spark, folder):
    """Daily bars of the larger table; these fills have no single id, so the order is a struct."""
    rows = feed.fills(table(spark, folder, "lineitem"), table(spark, folder, "part"))
    order = F.struct("event_time", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     "l_extendedprice")
    return bars.from_ticks(rows, "1d", order).select(
        "symbol", start(), *six("open", "high", "low", "close"), "volume", "trades")


@query("ohlcv_gapfill", over("trades", f"""
, grid AS (SELECT symbol, unnest(range(min(bar_ms), max(bar_ms) + 1, 3600000)) AS bar_ms
           FROM bars GROUP BY symbol),
filled AS (SELECT symbol, bar_ms, open, high, low, volume,
             last_value(close IGNORE NULLS) {BY}) AS close
           FROM grid LEFT JOIN bars USING (symbol, bar_ms))
SELECT symbol, {SQL_START}, coalesce(open, close) AS open, coalesce(high, close) AS high,
  coalesce(low, close) AS low, close, coalesce(volume, 0.0) AS volume, open IS NULL AS is_filled
FROM filled""", HOURLY))
def ohlcv_gapfill(spark, folder):
    return bars.fill_gaps(hourly(spark, folder), "1h").select(
        "symbol", start(), "open", "high", "low", "close", "volume", "is_filled")


@query("silver_read_pruned", over("trades", f"""
SELECT symbol, {SQL_START}, close FROM bars
WHERE strftime(make_timestamp(bar_ms * 1000), '%Y-%m-%d') >= '2024-01-15'""", HOURLY))
def silver_read_pruned(spark, folder):
    """The date filter is a partition filter: earlier folders are not listed for reading."""
    path = fresh_path(spark, "silver_bars")
    lake.insert(hourly(spark, folder).withColumn("date", day_of(F.col("bar_ms"))), path)
    return lake.read(spark, path).filter(F.col("date") >= "2024-01-15").select(
        "symbol", start(), "close")


@query("silver_upsert_bars", over("redelivered", f"""
SELECT symbol, {SQL_START}, open, high, low, close, volume, trades FROM bars""",
                                  sql_bars(3600000, "redelivered")))
def silver_upsert_bars(spark, folder):
    """Bars are rebuilt after redelivery and replace the earlier version by (symbol, bar)."""
    path = fresh_path(spark, "silver_upsert")
    ticks = trades(spark, folder)
    for batch, rows in enumerate((ticks, feed.redelivered(ticks))):
        built = bars.from_ticks(rows, "1h").withColumns({
            "date": day_of(F.col("bar_ms")), "event_time": F.col("bar_ms")})
        lake.upsert(spark, built, path, batch, key=("symbol", "bar_ms"), ordering="arrival",
                    scope="partition")
    return lake.read(spark, path).select("symbol", start(), "open", "high", "low", "close", "volume",
                                         "trades")


# Every tenth trade comes again a millisecond later, every fiftieth once more with another price.
_CORRECTED = """corrected AS (
  SELECT symbol, trade_id, quantity,
    event_time + CASE WHEN trade_id % 50 = 0 THEN 2 WHEN trade_id % 10 = 0 THEN 1 ELSE 0 END AS event_time,
    price + CASE WHEN trade_id % 50 = 0 THEN 1 ELSE 0 END AS price
  FROM trades)"""


@query("silver_incremental", over("trades", f"""
SELECT symbol, {SQL_START}, open, high, low, close, volume, trades FROM bars""", _CORRECTED, sql_bars(3600000, "corrected")))
def silver_incremental(spark, folder):
    """Three bronze batches, with silver refreshed after each from what it changed."""
    root, ticks = fresh_path(spark, "silver_incremental"), trades(spark, folder)
    again = feed.redelivered(ticks)
    late = F.pmod("trade_id", F.lit(10)) == 3
    fixed = ticks.filter(F.pmod("trade_id", F.lit(50)) == 0).withColumns(
        {"event_time": F.col("event_time") + 2, "price": F.col("price") + 1})
    for batch, rows in enumerate((ticks.filter(~late), ticks.filter(late).unionByName(again), fixed)):
        named = rows.withColumns({"record_id": F.col("trade_id").cast("string"), "date": day_of(F.col("event_time"))})
        lake.upsert(spark, named, f"{root}/bronze", batch)
        silver.refresh(spark, f"{root}/bronze", f"{root}/silver", batch - 1)
    return lake.read(spark, f"{root}/silver").select("symbol", start(), "open", "high", "low", "close", "volume", "trades")


@query("vwap", over("trades", f"""
SELECT symbol, {SQL_START}, {sql6("notional / volume")} AS vwap, volume FROM bars""", HOURLY))
def vwap(spark, folder):
    return flow.vwap(trades(spark, folder), "1h").select("symbol", start(), *six("vwap"), "volume")


_FLOW = """flow AS (
  SELECT symbol, event_time - event_time % 3600000 AS bar_ms, count(*) AS trades,
    sum(quantity) AS volume, sum(price * quantity) AS notional, avg(quantity) AS mean_size,
    max(quantity) AS max_size, min(quantity) AS min_size,
    sum(CASE WHEN is_buyer_maker THEN 0.0::DOUBLE ELSE quantity END) AS buy_volume,
    sum(CASE WHEN is_buyer_maker THEN quantity ELSE 0.0::DOUBLE END) AS sell_volume
  FROM trades GROUP BY 1, 2)"""


@query("trade_metrics", over("trades", f"""
SELECT symbol, {SQL_START}, trades, volume, {sql6("notional")} AS notional,
       {sql6("mean_size")} AS mean_size, max_size, min_size, buy_volume, sell_volume
FROM flow""", _FLOW))
def trade_metrics(spark, folder):
    return flow.metrics(trades(spark, folder), "1h").select(
        "symbol", start(), "trades", "volume", *six("notional", "mean_size"), "max_size", "min_size",
        "buy_volume", "sell_volume")


@query("order_imbalance", over("trades", f"""
SELECT symbol, {SQL_START}, {sql6("(buy_volume - sell_volume) / (buy_volume + sell_volume)")}
       AS imbalance, {sql6("trades / 3600.0::DOUBLE")} AS trades_per_second FROM flow""", _FLOW))
def order_imbalance(spark, folder):
    return flow.order_flow(trades(spark, folder), "1h").select(
        "symbol", start(), *six("imbalance", "trades_per_second"))


@query("illiquidity", over("trades", f"""
SELECT symbol, {sql6("1e6 * avg(abs(close / nullif(prior, 0) - 1) / nullif(notional, 0))")} AS amihud_e6
FROM (SELECT *, lag(close) {BY}) AS prior FROM bars) GROUP BY symbol""", HOURLY))
def illiquidity(spark, folder):
    rows = flow.illiquidity(indicators.returns(hourly(spark, folder), "1h"))
    return rows.select("symbol", fixed6(F.col("amihud") * 1e6).alias("amihud_e6"))


@query("intertrade_time", over("trades", """
SELECT symbol, trade_id, event_time - lag(event_time) OVER (PARTITION BY symbol
       ORDER BY event_time, trade_id) AS gap_ms FROM trades"""))
def intertrade_time(spark, folder):
    return flow.intertrade_time(trades(spark, folder)).select("symbol", "trade_id", "gap_ms")


@query("asof_price", over("trades", """
SELECT p.symbol, p.probe_id, q.price AS asof_price
FROM (SELECT symbol, trade_id AS probe_id, event_time - 1800000 AS probe_time FROM trades) p
ASOF LEFT JOIN (SELECT symbol, event_time, arg_max(price, trade_id) AS price
                FROM trades GROUP BY symbol, event_time) q
ON p.symbol = q.symbol AND p.probe_time >= q.event_time"""))
def asof_price(spark, folder):
    """What the symbol cost half an hour before each trade."""
    ticks = trades(spark, folder)
    probes = ticks.select("symbol", F.col("trade_id").alias("probe_id"),
                          (F.col("event_time") - 1_800_000).alias("probe_time"))
    return flow.asof_price(probes, ticks).select("symbol", "probe_id", "asof_price")


def _lead(n: int) -> str:
    return f"{BY} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


_POS = f"""pos AS (SELECT *, row_number() {BY}) - 1 AS pos, lag(close) {BY}) AS prior
FROM bars)"""


@query("returns", over("trades", f"""
SELECT symbol, {SQL_START}, {sql6("close / nullif(prior, 0) - 1")} AS simple_return,
       {sql6("CASE WHEN close > 0 AND prior > 0 THEN ln(close / prior) END")} AS log_return
FROM pos""", HOURLY, _POS))
def returns(spark, folder):
    return indicators.returns(hourly(spark, folder), "1h").select(
        "symbol", start(), *six("simple_return", "log_return"))


@query("sma", over("trades", f"""
SELECT symbol, {SQL_START}, {sql6(f"CASE WHEN pos >= 19 THEN avg(close) {_lead(20)} END")} AS sma
FROM pos""", HOURLY, _POS))
def sma(spark, folder):
    return indicators.sma(hourly(spark, folder), "1h").select("symbol", start(), *six("sma"))


@query("bollinger", over("trades", f"""
SELECT symbol, {SQL_START}, {sql6("m")} AS middle, {sql6("m + 2 * s")} AS upper,
       {sql6("m - 2 * s")} AS lower
FROM (SELECT *, CASE WHEN pos >= 19 THEN avg(close) {_lead(20)} END AS m,
             stddev_pop(close) {_lead(20)} AS s FROM pos)""", HOURLY, _POS))
def bollinger(spark, folder):
    return indicators.bollinger(hourly(spark, folder), "1h").select(
        "symbol", start(), *six("middle", "upper", "lower"))


def _recursion(value: str, name: str, decay: str, source: str) -> str:
    """A plain recursion, one step per bar: seeded by the first value."""
    return f"""{name} AS (
  SELECT symbol, pos, {value} AS y FROM {source} WHERE pos = 0
  UNION ALL
  SELECT s.symbol, s.pos, e.y * {decay} + s.{value} * (1 - {decay})
  FROM {name} e JOIN {source} s ON s.symbol = e.symbol AND s.pos = e.pos + 1)"""


def _recursive(body: str, *views: str) -> str:
    return over("trades", body, HOURLY, _POS, *views).replace("WITH ", "WITH RECURSIVE ", 1)


_D = {span: f"(1.0::DOUBLE - 2.0::DOUBLE / {span + 1})" for span in (9, 12, 26)}


@query("ema", _recursive(f"""
SELECT symbol, {SQL_START}, {sql6("y")} AS ema FROM e12 JOIN pos USING (symbol, pos)""",
                         _recursion("close", "e12", _D[12], "pos")))
def ema(spark, folder):
    return indicators.ema(hourly(spark, folder), "1h").select("symbol", start(), *six("ema"))


@query("macd", _recursive(
    f"""SELECT symbol, {SQL_START}, {sql6("line")} AS macd, {sql6("e9.y")} AS signal,
       {sql6("line - e9.y")} AS histogram
FROM e9 JOIN lines USING (symbol, pos) JOIN pos USING (symbol, pos)""",
    _recursion("close", "e12", _D[12], "pos"), _recursion("close", "e26", _D[26], "pos"),
    """lines AS (SELECT symbol, pos, e12.y - e26.y AS line
         FROM e12 JOIN e26 USING (symbol, pos))""",
    _recursion("line", "e9", _D[9], "lines")))
def macd(spark, folder):
    return indicators.macd(hourly(spark, folder), "1h").select(
        "symbol", start(), *six("macd", "signal", "histogram"))


_RSI_VALUE = """CASE WHEN up = 0 AND down = 0 THEN 50.0::DOUBLE
       WHEN down = 0 THEN 100.0::DOUBLE ELSE 100.0::DOUBLE - 100.0::DOUBLE / (1.0::DOUBLE + up / down)
       END"""
_WILDER = (
    "moves AS (SELECT *, greatest(close - prior, 0) AS gain, greatest(prior - close, 0) AS loss "
    "FROM pos WHERE pos > 0)",
    """w AS (
  SELECT symbol, 14 AS pos, avg(gain) AS up, avg(loss) AS down FROM moves WHERE pos <= 14
  GROUP BY symbol HAVING count(*) = 14
  UNION ALL
  SELECT m.symbol, m.pos, (w.up * 13 + m.gain) / 14, (w.down * 13 + m.loss) / 14
  FROM w JOIN moves m ON m.symbol = w.symbol AND m.pos = w.pos + 1)""")


@query("rsi", _recursive(f"""
SELECT symbol, {SQL_START}, {sql6(_RSI_VALUE)} AS rsi FROM pos LEFT JOIN w USING (symbol, pos)""",
                         *_WILDER))
def rsi(spark, folder):
    return indicators.rsi(hourly(spark, folder), "1h").select("symbol", start(), *six("rsi"))


@query("rolling_volatility", over("trades", f"""
SELECT symbol, {SQL_START}, {sql6(f"CASE WHEN pos >= 20 THEN stddev_samp(r) {_lead(20)} END")}
       AS rolling_volatility
FROM (SELECT *, close / nullif(prior, 0) - 1 AS r FROM pos)""", HOURLY, _POS))
def rolling_volatility(spark, folder):
    return indicators.rolling_volatility(hourly(spark, folder), "1h").select(
        "symbol", start(), *six("rolling_volatility"))


@query("anomaly_zscore", over("trades", f"""
SELECT symbol, {SQL_START}, {sql6("z")} AS zscore, coalesce(abs(z) > 3, FALSE) AS is_anomaly
FROM (SELECT *, CASE WHEN pos >= 20 AND sd > 0 THEN (close - mu) / sd END AS z
      FROM (SELECT *, avg(close) {BY} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS mu,
                   stddev_samp(close) {BY} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS sd
            FROM pos))""", HOURLY, _POS))
def anomaly_zscore(spark, folder):
    return indicators.anomalies(hourly(spark, folder), "1h").select(
        "symbol", start(), *six("zscore"), "is_anomaly")


_CROSS = (
    f"""means AS (SELECT *, CASE WHEN pos >= 4 THEN avg(close) {_lead(5)} END AS f,
               CASE WHEN pos >= 19 THEN avg(close) {_lead(20)} END AS s FROM pos)""",
    f"""crossed AS (SELECT *, CAST(CASE WHEN f > s AND before <= 0 THEN 1
         WHEN f < s AND before >= 0 THEN -1 ELSE 0 END AS INTEGER) AS cross_signal
       FROM (SELECT *, lag(sign(f - s)) {BY}) AS before FROM means))""")


@query("trading_signals", over("trades", f"""
SELECT symbol, {SQL_START}, {sql6("f")} AS sma_fast, {sql6("s")} AS sma_slow, cross_signal
FROM crossed""", HOURLY, _POS, *_CROSS))
def trading_signals(spark, folder):
    return indicators.crossings(hourly(spark, folder), "1h").select(
        "symbol", start(), *six("sma_fast", "sma_slow"), "cross_signal")


@query("rsi_signals", _recursive(f"""
SELECT symbol, {SQL_START}, cross_signal, CAST(CASE WHEN strength < 30 THEN 1
       WHEN strength > 70 THEN -1 ELSE 0 END AS INTEGER) AS rsi_signal
FROM crossed LEFT JOIN (SELECT symbol, pos, {_RSI_VALUE} AS strength FROM w) USING (symbol, pos)
""", *_CROSS, *_WILDER))
def rsi_signals(spark, folder):
    return indicators.signals(hourly(spark, folder), "1h").select(
        "symbol", start(), "cross_signal", "rsi_signal")


@query("forecast_ols", over("trades", f"""
SELECT symbol, {sql6("regr_slope(close, prior)")} AS slope,
       {sql6("regr_intercept(close, prior)")} AS intercept,
       CAST(regr_count(close, prior) AS BIGINT) AS n,
       {sql6('''regr_intercept(close, prior) + regr_slope(close, prior)
                * arg_max(close, bar_ms)''')} AS forecast
FROM pos GROUP BY symbol""", HOURLY, _POS))
def forecast_ols(spark, folder):
    return indicators.lagged_fit(hourly(spark, folder), "1h").select(
        "symbol", *six("slope", "intercept"), "n", *six("forecast"))


_LAGS = ", ".join(f"lag(close, {k}) {BY}) AS x{k}" for k in (1, 2, 3))
_LAGGED = f"lagged AS (SELECT * FROM (SELECT symbol, bar_ms, close AS y, {_LAGS} FROM bars) WHERE x3 IS NOT NULL)"
_SUMS = "sums AS (SELECT symbol, count(*) AS n, arg_max(y, bar_ms) AS l1, arg_max(x1, bar_ms) AS l2, arg_max(x2, bar_ms) AS l3, " \
    + ", ".join(f"avg({c}) AS m_{c}" for c in ("y", "x1", "x2", "x3")) + ", " + ", ".join(
        f"covar_pop({a}, {b}) AS c_{a}{b}" for i, a in enumerate(("x1", "x2", "x3")) for b in ("x1", "x2", "x3", "y")[i:]) \
    + " FROM lagged GROUP BY symbol)"


def _det(*rows: tuple[str, str, str]) -> str:
    (a, b, c), (d, e, f), (g, h, i) = rows
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


_M = [["c_x1x1", "c_x1x2", "c_x1x3"], ["c_x1x2", "c_x2x2", "c_x2x3"], ["c_x1x3", "c_x2x3", "c_x3x3"]]
_V = ["c_x1y", "c_x2y", "c_x3y"]
_CRAMER = "fitted AS (SELECT *, " + ", ".join(
    f"{_det(*[tuple(_V[r] if c == k else _M[r][c] for c in range(3)) for r in range(3)])} / {_det(*map(tuple, _M))} AS b{k + 1}"
    for k in range(3)) + " FROM sums)"


@query("forecast_lags", over("trades", f"""
SELECT symbol, n, {", ".join(f"{sql6(f'b{k}')} AS beta_{k}" for k in (1, 2, 3))},
  {sql6("m_y - b1 * m_x1 - b2 * m_x2 - b3 * m_x3")} AS intercept,
  {sql6("m_y - b1 * m_x1 - b2 * m_x2 - b3 * m_x3 + b1 * l1 + b2 * l2 + b3 * l3")} AS forecast
FROM fitted""", HOURLY, _LAGGED, _SUMS, _CRAMER))
def forecast_lags(spark, folder):
    """Least squares on three earlier closes; the check solves the normal equations by determinants."""
    return indicators.lag_regression(hourly(spark, folder), "1h").select(
        "symbol", "n", *six("beta_1", "beta_2", "beta_3", "intercept", "forecast"))


@query("minute_type_counts", over("ids", """
SELECT make_timestamp((received_time - received_time % 60000) * 1000) AS minute, stream_type,
       count(*) AS n FROM ids GROUP BY ALL"""))
def minute_type_counts(spark, folder):
    return quality_report.minute_counts(normalized(spark, folder)).select(
        timestamp_of(F.col("minute_ms")).alias("minute"), "stream_type", "n")


@query("throughput", over("ids", f"""
SELECT symbol, make_timestamp((received_time - received_time % 3600000) * 1000) AS window_start,
       count(*) AS n, {sql6("count(*) / 3600.0::DOUBLE")} AS per_second
FROM ids WHERE reject_reason IS NULL GROUP BY 1, 2"""))
def throughput(spark, folder):
    rows = quality_report.throughput(envelope.accepted(normalized(spark, folder)))
    return rows.select("symbol", timestamp_of(F.col("window_ms")).alias("window_start"), "n",
                       *six("per_second"))


@query("ingest_latency", over("ids", """
SELECT symbol, count(*) AS n,
       quantile_disc(received_time - event_time, 0.5) AS p50_ms,
       quantile_disc(received_time - event_time, 0.95) AS p95_ms,
       max(received_time - event_time) AS max_ms
FROM ids WHERE reject_reason IS NULL GROUP BY symbol"""))
def ingest_latency(spark, folder):
    return quality_report.latency(envelope.accepted(normalized(spark, folder)))


@query("dq_report", over("ids", f"""
SELECT symbol, stream_type, CAST(sum(c) AS BIGINT) AS n, {sql6("sum(sc)::DOUBLE / sum(c)")} AS avg_score,
       {sql6("sum(g) / sum(c)")} AS good_share, {sql6("sum(u) / sum(c)")} AS unnamed_rate,
       {sql6("1 - count(*) / sum(c)")} AS duplicate_rate
FROM (SELECT symbol, stream_type, record_id, count(*)::DOUBLE AS c, sum(CAST(data_quality_score AS DECIMAL(12,6))) AS sc,
        sum(CASE WHEN data_quality_score >= 0.8::DOUBLE THEN 1 ELSE 0 END)::DOUBLE AS g,
        sum(CASE WHEN stream_name IS NULL THEN 1 ELSE 0 END)::DOUBLE AS u
      FROM ids WHERE reject_reason IS NULL GROUP BY 1, 2, 3)
GROUP BY ROLLUP (symbol, stream_type)"""))
def dq_report(spark, folder):
    rows = quality_report.report(envelope.accepted(normalized(spark, folder)))
    return rows.select("symbol", "stream_type", "n", *six(
        "avg_score", "good_share", "unnamed_rate", "duplicate_rate"))


@query("dq_profile", over("ids", f"""
SELECT symbol, stream_type, CAST(grouping_id(symbol, stream_type) AS BIGINT) AS grouping_id, count(*) AS n,
  {sql6("count_if(trade_id IS NULL)::DOUBLE / count(*)")} AS trade_id_null_rate,
  {sql6("count_if(stream_name IS NULL)::DOUBLE / count(*)")} AS stream_name_null_rate,
  count_if(data_quality_score < 0.5::DOUBLE) AS n_poor,
  count_if(data_quality_score >= 0.5::DOUBLE AND data_quality_score < 0.8::DOUBLE) AS n_fair,
  count_if(data_quality_score >= 0.8::DOUBLE) AS n_good,
  {sql6("quantile_disc(data_quality_score, 0.5)")} AS p50, {sql6("quantile_disc(data_quality_score, 0.95)")} AS p95
FROM (SELECT * REPLACE (CASE WHEN event_id % 7 = 0 THEN NULL ELSE stream_type END AS stream_type) FROM ids
      WHERE reject_reason IS NULL)
GROUP BY ROLLUP (symbol, stream_type)"""))
def dq_profile(spark, folder):
    """A seventh of the rows lose their type: a missing type is told apart from the subtotal."""
    rows = envelope.accepted(envelope.normalize(feed.raw_messages(table(spark, folder, "events")), keep=("event_id",)))
    rows = rows.withColumn("stream_type", F.when(F.pmod("event_id", F.lit(7)) != 0, F.col("stream_type")))
    return quality_report.profile(rows).select(
        "symbol", "stream_type", "grouping_id", "n", *six("trade_id_null_rate", "stream_name_null_rate"),
        "n_poor", "n_fair", "n_good", *six("p50", "p95"))
