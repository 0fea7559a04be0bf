"""Which symbols and streams to subscribe to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright import feed_values as fv


def active(dim: DataFrame, environment: str = "development",
           override: str | None = None) -> DataFrame:
    """Active symbols with their config columns.

    A non-empty ``override`` list wins and is not checked against the table. Otherwise a symbol is
    active when enabled and important enough; with none, the two fallback symbols are.
    """
    spark = dim.sparkSession
    if override:
        names = F.explode(F.transform(F.split(F.lit(override), ","),
                                      lambda s: F.upper(F.trim(s)))).alias("symbol")
        return spark.range(1).select(names)
    limit = (fv.DEVELOPMENT_MAX_PRIORITY if environment == "development" else fv.MAX_PRIORITY)
    chosen = dim.filter(F.col("enabled") & (F.col("priority") <= limit)).select("symbol")
    if chosen.isEmpty():
        return spark.createDataFrame([(s,) for s, _, _ in fv.FALLBACK_SYMBOLS], "symbol string")
    return chosen


def with_config(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Add name, priority, enabled and streams by upper-cased symbol; unknown symbols get the
    default streams. The dimension is a configuration file, so Spark broadcasts it by size."""
    config = dim.select(F.col("symbol").alias("_symbol"), "name", "priority", "enabled",
                        F.col("streams").alias("_streams"))
    default = F.array(*[F.lit(s) for s in fv.DEFAULT_STREAMS])
    return (rows.join(config, F.upper("symbol") == F.col("_symbol"), "left")
            .withColumn("streams", F.coalesce("_streams", default)).drop("_symbol", "_streams"))


def plan(symbols: DataFrame, dim: DataFrame, exact: bool = False) -> DataFrame:
    """(symbol, stream, feed_name) per subscription.

    By default every symbol gets every known stream that any symbol asks for; ``exact=True`` gives
    a symbol only its own. Unknown stream names are ignored.
    """
    wanted = with_config(symbols, dim).select("symbol", F.explode("streams").alias("stream"))
    offered = F.array(*[F.struct(F.lit(name).alias("stream"), F.lit(suffix).alias("suffix"))
                        for name, suffix, _ in fv.KNOWN_STREAMS])
    known = symbols.select("symbol", F.inline(offered))
    on = ["symbol", "stream"] if exact else ["stream"]
    rows = known.join(wanted.select(*on).distinct(), on, "left_semi")
    return rows.select("symbol", "stream",
                       F.concat(F.lower("symbol"), F.lit("@"), "suffix").alias("feed_name"))


def stream_url(plan_rows: DataFrame, base_url: str = fv.FEED_BASE_URL) -> DataFrame:
    """One row with the subscription address; no known stream is an error."""
    joined = F.array_join(F.sort_array(F.collect_list("feed_name")), "/")
    return plan_rows.agg(F.when(F.count("*") == 0, F.raise_error(F.lit(
        "no valid streams configured"))).otherwise(F.concat(F.lit(base_url), joined)).alias("url"))
