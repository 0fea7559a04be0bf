"""Technical indicators over bars: all in built-in windows, none needs a whole series in a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.operators.bars import WIDTHS_MS, fill_gaps
from tapewright.operators.series import Chunks, ema_decay, one_run, run_length, with_position

PLAIN_RUN = 4096
# Decays closer than this are not told apart by a difference without loss of digits.
LEAST_GAP = 1e-3


def _positioned(bars: DataFrame, width: str, fill: bool) -> DataFrame:
    return with_position(fill_gaps(bars, width) if fill else bars, WIDTHS_MS[width])


def _full(chunks: Chunks, value: Column, n: int, first: int = 0) -> Column:
    """NULL until ``n`` values exist; ``first`` is the position of the first value."""
    return F.when(F.col("pos") >= n - 1 + first, value)


def returns(bars: DataFrame, width: str, fill: bool = False) -> DataFrame:
    chunks = Chunks(_positioned(bars, width, fill), 1, PLAIN_RUN)
    prior = F.lag("close").over(chunks.ordered)
    rows = chunks.rows.withColumn("_prior", prior).withColumns({
        "simple_return": F.try_divide(F.col("close"), F.col("_prior")) - 1,
        "log_return": F.ln(F.try_divide(F.col("close"), F.col("_prior")))})
    return chunks.finish(rows).drop("_prior")


def sma(bars: DataFrame, width: str, n: int = 20, fill: bool = False) -> DataFrame:
    chunks = Chunks(_positioned(bars, width, fill), n - 1, PLAIN_RUN)
    return chunks.finish(chunks.rows.withColumn(
        "sma", _full(chunks, F.avg("close").over(chunks.last(n)), n)))


def bollinger(bars: DataFrame, width: str, n: int = 20, k: float = 2.0,
              fill: bool = False) -> DataFrame:
    chunks = Chunks(_positioned(bars, width, fill), n - 1, PLAIN_RUN)
    spread = F.lit(k) * F.stddev_pop("close").over(chunks.last(n))
    rows = (chunks.rows
            .withColumns({"middle": _full(chunks, F.avg("close").over(chunks.last(n)), n),
                          "_spread": spread})
            .withColumns({"upper": F.col("middle") + F.col("_spread"),
                          "lower": F.col("middle") - F.col("_spread")}))
    return chunks.finish(rows).drop("_spread")


def _ema_input(column: str, decay: float) -> Column:
    """The first value seeds the average, later ones enter with weight alpha."""
    return F.when(F.col("pos") == 0, F.col(column)).otherwise(F.lit(1.0 - decay) * F.col(column))


def _smoothed(rows: DataFrame, column: str, span: int, name: str) -> DataFrame:
    """Exponential average of ``column`` over all earlier positions, in runs of its own decay."""
    decay = ema_decay(span)
    chunks = Chunks(rows, 0, run_length(decay))
    taken = chunks.rows.withColumn("_in", _ema_input(column, decay))
    return chunks.finish(chunks.recurrence(taken, {name: ("_in", decay)})).drop("_in")


def ema(bars: DataFrame, width: str, span: int = 12, fill: bool = False) -> DataFrame:
    return _smoothed(_positioned(bars, width, fill), "close", span, "ema")


def macd(bars: DataFrame, width: str, fast: int = 12, slow: int = 26, signal: int = 9,
         fill: bool = False) -> DataFrame:
    """The line is the fast average less the slow one, the signal the average of the line.

    An average (decay b) of an average (decay a) is a difference of two sums over the same input, one
    fading by a and one by b, over a - b. So all of it is four sums of one pass. Where a and b agree,
    or differ so much that they cannot share runs, the averages are taken one after the other.
    """
    rows = _positioned(bars, width, fill)
    a, c, b = (ema_decay(span) for span in (fast, slow, signal))
    size = one_run(a, c, b)
    if size is None or min(abs(a - b), abs(c - b)) < LEAST_GAP or min(a, b, c) <= 0.0:
        rows = _smoothed(rows, "close", fast, "_fast")
        rows = _smoothed(rows, "close", slow, "_slow").withColumn("macd", F.col("_fast") - F.col("_slow"))
        rows = _smoothed(rows, "macd", signal, "signal")
        return rows.withColumn("histogram", F.col("macd") - F.col("signal")).drop("_fast", "_slow")
    chunks = Chunks(rows, 0, size)
    taken = chunks.rows.withColumns({"_fast_in": _ema_input("close", a), "_slow_in": _ema_input("close", c)})
    rows = chunks.recurrence(taken, {"_fast": ("_fast_in", a), "_slow": ("_slow_in", c),
                                     "_fast_b": ("_fast_in", b), "_slow_b": ("_slow_in", b)})
    again = ((a * F.col("_fast") - b * F.col("_fast_b")) / (a - b) - (c * F.col("_slow") - b * F.col("_slow_b")) / (c - b))
    rows = rows.withColumns({"macd": F.col("_fast") - F.col("_slow"), "signal": F.lit(1.0 - b) * again})
    return chunks.finish(rows.withColumn("histogram", F.col("macd") - F.col("signal"))).drop(
        "_fast_in", "_slow_in", "_fast", "_slow", "_fast_b", "_slow_b")


def rsi(bars: DataFrame, width: str, n: int = 14, fill: bool = False) -> DataFrame:
    """Wilder: the mean of the first n moves seeds both averages, later moves weigh 1/n.

    Both averages zero gives 50, only losses zero gives 100. A flat stretch keeps the value before it.
    """
    decay = 1.0 - 1.0 / n
    chunks = Chunks(_positioned(bars, width, fill), n, run_length(decay))
    move = F.col("close") - F.lag("close").over(chunks.ordered)
    rows = (chunks.rows.withColumn("_move", move)
            .withColumns({"_gain": F.greatest(F.col("_move"), F.lit(0.0)),
                          "_loss": F.greatest(-F.col("_move"), F.lit(0.0))}))

    def seeded(column: str) -> Column:
        seed = F.avg(column).over(chunks.last(n))
        return (F.when(F.col("pos") < n, 0.0).when(F.col("pos") == n, seed)
                .otherwise(F.coalesce(F.col(column), F.lit(0.0)) / n))

    rows = rows.withColumns({"_up_in": seeded("_gain"), "_down_in": seeded("_loss")})
    rows = chunks.recurrence(rows, {"_up": ("_up_in", decay), "_down": ("_down_in", decay)}, ratio=True)
    value = (F.when((F.col("_up") == 0) & (F.col("_down") == 0), 50.0)
             .when(F.col("_down") == 0, 100.0)
             .otherwise(100.0 - 100.0 / (1.0 + F.col("_up") / F.col("_down"))))
    rows = rows.withColumn("rsi", F.when(F.col("pos") >= n, value))
    return chunks.finish(rows).drop("_move", "_gain", "_loss", "_up_in", "_down_in", "_up",
                                    "_down")


def rolling_volatility(bars: DataFrame, width: str, n: int = 20, fill: bool = False) -> DataFrame:
    """Sample deviation of the last n simple returns; the first return is at position 1."""
    chunks = Chunks(_positioned(bars, width, fill), n, PLAIN_RUN)
    rows = chunks.rows.withColumn("_return", F.try_divide(
        F.col("close"), F.lag("close").over(chunks.ordered)) - 1)
    rows = rows.withColumn("rolling_volatility", _full(
        chunks, F.stddev_samp("_return").over(chunks.last(n)), n, first=1))
    return chunks.finish(rows).drop("_return")


def anomalies(bars: DataFrame, width: str, n: int = 20, limit: float = 3.0,
              fill: bool = False) -> DataFrame:
    """Deviation of a close from the n closes before it, in their sample deviations."""
    chunks = Chunks(_positioned(bars, width, fill), n, PLAIN_RUN)
    frame = chunks.previous(n)
    rows = chunks.rows.withColumns({"_mean": F.avg("close").over(frame),
                                    "_sd": F.stddev_samp("close").over(frame)})
    z = F.when((F.col("pos") >= n) & (F.col("_sd") > 0),
               (F.col("close") - F.col("_mean")) / F.col("_sd"))
    rows = rows.withColumn("zscore", z).withColumn(
        "is_anomaly", F.coalesce(F.abs("zscore") > limit, F.lit(False)))
    return chunks.finish(rows).drop("_mean", "_sd")


def crossings(bars: DataFrame, width: str, fast: int = 5, slow: int = 20,
              fill: bool = False) -> DataFrame:
    """+1 where the fast mean crosses above the slow one, -1 below, 0 otherwise."""
    chunks = Chunks(_positioned(bars, width, fill), slow, PLAIN_RUN)
    rows = chunks.rows.withColumns({
        "sma_fast": _full(chunks, F.avg("close").over(chunks.last(fast)), fast),
        "sma_slow": _full(chunks, F.avg("close").over(chunks.last(slow)), slow)})
    rows = rows.withColumn("_side", F.signum(F.col("sma_fast") - F.col("sma_slow")))
    before = F.lag("_side").over(chunks.ordered)
    rows = rows.withColumn("_before", before).withColumn(
        "cross_signal", F.when((F.col("_side") > 0) & (F.col("_before") <= 0), 1)
        .when((F.col("_side") < 0) & (F.col("_before") >= 0), -1).otherwise(0))
    return chunks.finish(rows).drop("_side", "_before")


def signals(bars: DataFrame, width: str, low: float = 30.0, high: float = 70.0,
            fill: bool = False) -> DataFrame:
    """Mean crossings and RSI extremes side by side; the join keeps the bars' partitioning."""
    crossed = crossings(bars, width, fill=fill)
    strength = rsi(bars, width, fill=fill).select("symbol", "bar_ms", "rsi")
    return crossed.join(strength, ["symbol", "bar_ms"]).withColumn(
        "rsi_signal", F.when(F.col("rsi") < low, 1).when(F.col("rsi") > high, -1).otherwise(0))


def lagged_fit(bars: DataFrame, width: str, fill: bool = False) -> DataFrame:
    """Per symbol, the least-squares line of a close on the one before it, and its next value."""
    chunks = Chunks(_positioned(bars, width, fill), 1, PLAIN_RUN)
    rows = chunks.finish(chunks.rows.withColumn("_prior", F.lag("close").over(chunks.ordered)))
    fit = rows.groupBy("symbol").agg(
        F.regr_slope("close", "_prior").alias("slope"),
        F.regr_intercept("close", "_prior").alias("intercept"),
        F.regr_count("close", "_prior").alias("n"),
        F.max_by("close", "bar_ms").alias("last_close"))
    return fit.withColumn("forecast", F.col("intercept") + F.col("slope") * F.col("last_close"))


def lag_regression(bars: DataFrame, width: str, lags: int = 3, fill: bool = False) -> DataFrame:
    """Per symbol, least squares of a close on the ``lags`` closes before it: beta_1 .. beta_k, intercept, n, forecast.

    One aggregate takes the covariances of all pairs (mergeable, so a long series is spread over many tasks); the
    small symmetric system is then eliminated column by column, which needs no pivot. Where the
    closes do not determine the weights (a flat series, too few bars) they are null.
    """
    chunks = Chunks(_positioned(bars, width, fill), lags, PLAIN_RUN)
    names = [f"_x{k}" for k in range(1, lags + 1)]
    rows = chunks.finish(chunks.rows.withColumns(
        {name: F.lag("close", k).over(chunks.ordered) for k, name in enumerate(names, 1)})).filter(F.col("pos") >= lags)
    every = [*names, "close"]
    fit = rows.groupBy("symbol").agg(
        F.count("*").alias("n"), F.max_by(F.struct(*every), "bar_ms").alias("_last"),
        *[F.avg(c).alias(f"_mean{c}") for c in every],
        *[F.covar_pop(a, b).alias(f"_a{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(every) if j >= i])
    for i in range(lags):  # forward: row i takes itself out of the rows below
        pivot = F.when(F.abs(f"_a{i}_{i}") > 1e-12 * F.greatest(F.abs(f"_mean{names[i]}"), F.lit(1e-150)), F.col(f"_a{i}_{i}"))
        fit = fit.withColumns({f"_a{r}_{c}": F.col(f"_a{r}_{c}") - F.col(f"_a{i}_{r}") / pivot * F.col(f"_a{i}_{c}")
                               for r in range(i + 1, lags) for c in range(r, lags + 1)})
    for i in reversed(range(lags)):  # back: from the last weight up
        rest = F.col(f"_a{i}_{lags}")
        for j in range(i + 1, lags):
            rest = rest - F.col(f"_a{i}_{j}") * F.col(f"beta_{j + 1}")
        fit = fit.withColumn(f"beta_{i + 1}", F.try_divide(rest, F.col(f"_a{i}_{i}")))
    betas = [f"beta_{k}" for k in range(1, lags + 1)]
    level = F.col("_meanclose")
    for beta, name in zip(betas, names):
        level = level - F.col(beta) * F.col(f"_mean{name}")
    fit = fit.withColumn("intercept", level)
    ahead = F.col("intercept")
    for beta, latest in zip(betas, ["close", *names]):
        ahead = ahead + F.col(beta) * F.col(f"_last.{latest}")
    return fit.select("symbol", *betas, "intercept", "n", ahead.alias("forecast"))
