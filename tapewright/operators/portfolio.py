"""Daily returns, risk and portfolio reports.

Input is daily bars: one row per symbol and day, so a calendar bounds every per-symbol group.
Year = 365 periods, risk-free rate 0; a figure needs two returns and a non-zero deviation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PERIODS = 365


def _by_day():
    return W.partitionBy("symbol").orderBy("bar_ms")


def daily_returns(daily: DataFrame) -> DataFrame:
    prior = F.lag("close").over(_by_day())
    return daily.select("symbol", "bar_ms", "close",
                        (F.try_divide(F.col("close"), prior) - 1).alias("ret"))


def _deviation(periods: int) -> Column:
    return F.stddev_samp("ret") * F.sqrt(F.lit(float(periods)))


def volatility(returns: DataFrame, periods: int = PERIODS) -> DataFrame:
    return returns.groupBy("symbol").agg(
        F.when(F.count("ret") >= 2, _deviation(periods)).alias("volatility"))


def _sharpe(periods: int, risk_free: float) -> Column:
    return F.when((F.count("ret") >= 2) & (F.stddev_samp("ret") > 0),
                  (F.avg("ret") - F.lit(risk_free)) / F.stddev_samp("ret")
                  * F.sqrt(F.lit(float(periods))))


def sharpe(returns: DataFrame, periods: int = PERIODS, risk_free: float = 0.0) -> DataFrame:
    return returns.groupBy("symbol").agg(_sharpe(periods, risk_free).alias("sharpe"))


def drawdowns(daily: DataFrame) -> DataFrame:
    """Running peak of the close and the loss from it."""
    peak = F.max("close").over(_by_day().rowsBetween(W.unboundedPreceding, 0))
    return daily.withColumn("peak", peak).withColumn(
        "drawdown", F.try_divide(F.col("close"), F.col("peak")) - 1)


def max_drawdown(daily: DataFrame) -> DataFrame:
    return drawdowns(daily).groupBy("symbol").agg(F.min("drawdown").alias("max_drawdown"))


def value_at_risk(returns: DataFrame, level: float = 0.05) -> DataFrame:
    """Historical VaR, the mean return beyond it, and downside deviation."""
    cut = returns.groupBy("symbol").agg(F.percentile("ret", F.lit(level)).alias("var"))
    joined = returns.filter(F.col("ret").isNotNull()).join(cut, "symbol")
    below = F.least(F.col("ret"), F.lit(0.0))
    return joined.groupBy("symbol").agg(
        F.max("var").alias("var"),
        F.avg(F.when(F.col("ret") <= F.col("var"), F.col("ret"))).alias("cvar"),
        F.sqrt(F.avg(below * below)).alias("downside_deviation"))


def beta(returns: DataFrame) -> DataFrame:
    """Against the equal-weight market: the mean return of the day over all symbols."""
    market = returns.groupBy("bar_ms").agg(F.avg("ret").alias("market"))
    return (returns.join(market, "bar_ms").filter("ret IS NOT NULL AND market IS NOT NULL")
            .groupBy("symbol").agg(F.try_divide(F.covar_samp("ret", "market"),
                                                F.var_samp("market")).alias("beta")))


def performance(returns: DataFrame, weights: DataFrame) -> DataFrame:
    """Daily portfolio return, equity from 1 and drawdown; fixed weights, a gap returns 0.

    The final window runs over days alone: one row a day for the whole portfolio.
    """
    by_day = (returns.join(weights, "symbol").groupBy("bar_ms")
              .agg(F.sum(F.col("weight") * F.coalesce("ret", F.lit(0.0))).alias("ret")))
    so_far = W.partitionBy(F.lit(0)).orderBy("bar_ms").rowsBetween(W.unboundedPreceding, 0)
    equity = (by_day.withColumn("log_equity", F.sum(F.log1p("ret")).over(so_far))
              .withColumn("equity", F.exp("log_equity")))
    peak = F.greatest(F.lit(1.0), F.max("equity").over(so_far))
    return equity.withColumn("peak", peak).withColumn(
        "drawdown", F.col("equity") / F.col("peak") - 1)


def summary(curve: DataFrame, periods: int = PERIODS) -> DataFrame:
    return curve.agg(
        F.count("*").alias("days"), F.max_by("equity", "bar_ms").alias("final_equity"),
        F.max_by("log_equity", "bar_ms").alias("final_log_equity"),
        F.when(F.count("ret") >= 2, _deviation(periods)).alias("volatility"),
        _sharpe(periods, 0.0).alias("sharpe"), F.min("drawdown").alias("max_drawdown"))
