"""Daily returns, risk, portfolio and export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapewright.functions.routing import day_of
from tapewright.operators import bars, correlation, export, portfolio
from tapewright.plans.bronze_queries import trades
from tapewright.plans.check_views import fixed6 as sql6
from tapewright.plans.check_views import over
from tapewright.plans.market_queries import BY, SQL_START, six, sql_bars, start
from tapewright.plans.registry import query
from tapewright.session import fresh_path

DAILY = sql_bars(bars.WIDTHS_MS["1d"])
RETURNS = f"""rets AS (SELECT symbol, bar_ms, close, close / nullif(lag(close) {BY}), 0) - 1 AS ret
FROM bars)"""


def daily(spark, folder) -> DataFrame:
    return bars.roll_up(bars.from_ticks(trades(spark, folder), "1m"), "1d")


def daily_returns(spark, folder) -> DataFrame:
    return portfolio.daily_returns(daily(spark, folder))


def equal_weights(returns: DataFrame) -> DataFrame:
    """One over the number of symbols traded; the window sees one row a symbol."""
    everything = W.partitionBy(F.lit(0))
    return returns.select("symbol").distinct().select(
        "symbol", (F.lit(1.0) / F.count("*").over(everything)).alias("weight"))


def _check(body: str, *views: str) -> str:
    return over("trades", body, DAILY, RETURNS, *views)


@query("volatility", _check(f"""
SELECT symbol, {sql6("stddev_samp(ret) * sqrt(365)")} AS volatility FROM rets GROUP BY symbol"""))
def volatility(spark, folder):
    return portfolio.volatility(daily_returns(spark, folder)).select("symbol", *six("volatility"))


@query("sharpe_ratio", _check(f"""
SELECT symbol, {sql6('''CASE WHEN stddev_samp(ret) > 0
                             THEN avg(ret) / stddev_samp(ret) * sqrt(365) END''')} AS sharpe
FROM rets GROUP BY symbol"""))
def sharpe_ratio(spark, folder):
    return portfolio.sharpe(daily_returns(spark, folder)).select("symbol", *six("sharpe"))


_DRAWDOWN = f"dd AS (SELECT *, max(close) {BY}) AS peak FROM bars)"


@query("drawdown_series", _check(f"""
SELECT symbol, {SQL_START}, peak, {sql6("close / nullif(peak, 0) - 1")} AS drawdown FROM dd""",
                                 _DRAWDOWN))
def drawdown_series(spark, folder):
    return portfolio.drawdowns(daily(spark, folder)).select("symbol", start(), "peak",
                                                            *six("drawdown"))


@query("max_drawdown", _check(f"""
SELECT symbol, {sql6("min(close / nullif(peak, 0) - 1)")} AS max_drawdown
FROM dd GROUP BY symbol""", _DRAWDOWN))
def max_drawdown(spark, folder):
    return portfolio.max_drawdown(daily(spark, folder)).select("symbol", *six("max_drawdown"))


@query("return_correlation", _check(f"""
SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, count(*) AS bars,
       {sql6("corr(a.ret, b.ret)")} AS correlation
FROM rets a JOIN rets b ON a.bar_ms = b.bar_ms AND a.symbol < b.symbol
WHERE a.ret IS NOT NULL AND b.ret IS NOT NULL GROUP BY ALL"""))
def return_correlation(spark, folder):
    return correlation.pairwise(daily_returns(spark, folder)).select(
        "symbol_a", "symbol_b", "bars", *six("correlation"))


@query("risk_var_cvar", _check(f"""
, cut AS (SELECT symbol, quantile_cont(ret, 0.05) AS var FROM rets GROUP BY symbol)
SELECT symbol, {sql6("any_value(var)")} AS var,
       {sql6("avg(ret) FILTER (WHERE ret <= var)")} AS cvar,
       {sql6("sqrt(avg(least(ret, 0) * least(ret, 0)))")} AS downside_deviation
FROM rets JOIN cut USING (symbol) WHERE ret IS NOT NULL
GROUP BY symbol"""))
def risk_var_cvar(spark, folder):
    return portfolio.value_at_risk(daily_returns(spark, folder)).select(
        "symbol", *six("var", "cvar", "downside_deviation"))


@query("risk_beta", _check(f"""
, market AS (SELECT bar_ms, avg(ret) AS m FROM rets GROUP BY bar_ms)
SELECT symbol, {sql6("covar_samp(ret, m) / var_samp(m)")} AS beta
FROM rets JOIN market USING (bar_ms) WHERE ret IS NOT NULL AND m IS NOT NULL
GROUP BY symbol"""))
def risk_beta(spark, folder):
    return portfolio.beta(daily_returns(spark, folder)).select("symbol", *six("beta"))


_CURVE = """days AS (SELECT bar_ms, sum(coalesce(ret, 0) / n) AS ret
    FROM rets, (SELECT count(DISTINCT symbol) AS n FROM rets) GROUP BY bar_ms),
  growth AS (SELECT *, sum(ln(1 + ret)) OVER (ORDER BY bar_ms) AS log_equity,
    exp(log_equity) AS equity FROM days),
  curve AS (SELECT *, greatest(1, max(equity) OVER (ORDER BY bar_ms)) AS peak FROM growth)"""


def curve(spark, folder) -> DataFrame:
    returns = daily_returns(spark, folder)
    return portfolio.performance(returns, equal_weights(returns))


@query("portfolio_performance", _check(f"""
SELECT {SQL_START}, {sql6("ret")} AS ret, {sql6("log_equity")} AS log_equity,
       {sql6("equity / peak - 1")} AS drawdown FROM curve""", _CURVE))
def portfolio_performance(spark, folder):
    return curve(spark, folder).select(start(), *six("ret", "log_equity", "drawdown"))


@query("portfolio_summary", _check(f"""
SELECT count(*) AS days, {sql6("arg_max(log_equity, bar_ms)")} AS final_log_equity,
       {sql6("stddev_samp(ret) * sqrt(365)")} AS volatility,
       {sql6("avg(ret) / stddev_samp(ret) * sqrt(365)")} AS sharpe,
       {sql6("min(equity / peak - 1)")} AS max_drawdown FROM curve""", _CURVE))
def portfolio_summary(spark, folder):
    return portfolio.summary(curve(spark, folder)).select(
        "days", *six("final_log_equity", "volatility", "sharpe", "max_drawdown"))


@query("gold_export_flat", _check("""
SELECT symbol, strftime(make_timestamp(bar_ms * 1000), '%Y-%m-%d') AS date, open AS price_open,
       high AS price_high, low AS price_low, close AS price_close, volume, trades FROM bars"""))
def gold_export_flat(spark, folder):
    """Nested daily bars exported twice to the same place; the second changes nothing."""
    path = fresh_path(spark, "gold_export")
    nested = daily(spark, folder).select(
        "symbol", day_of(F.col("bar_ms")).alias("date"),
        F.struct("open", "high", "low", "close").alias("price"), "volume", "trades")
    export.export(nested, path)
    export.export(nested, path)
    return spark.read.parquet(path).select(
        "symbol", F.col("date").cast("string").alias("date"), "price_open", "price_high",
        "price_low", "price_close", "volume", "trades")
