"""Topic names, record ids and epoch-time columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapewright import feed_values as fv


def topic_name(symbol: Column, stream_type: Column, prefix: str = fv.TOPIC_PREFIX) -> Column:
    """Only the symbol is lower-cased: ``crypto_raw_btcusdt_24hrTicker``."""
    return F.concat(F.lit(prefix), F.lower(F.coalesce(symbol, F.lit("UNKNOWN"))), F.lit("_"),
                    F.coalesce(stream_type, F.lit("unknown")))


def stable_record_id(symbol: Column, stream_type: Column, trade_id: Column,
                     raw_data: Column) -> Column:
    """The same message always gets the same id, so a replay is not a new row."""
    natural = F.when((stream_type == fv.TRADE) & trade_id.isNotNull(),
                     F.concat(F.lit("t:"), trade_id.cast("string"))) \
        .otherwise(F.concat(F.lit("h:"), F.sha2(raw_data, 256)))
    return F.sha2(F.concat_ws("|", symbol, stream_type, natural), 256)


def timestamp_of(epoch_ms: Column) -> Column:
    return F.timestamp_millis(epoch_ms).cast("timestamp_ntz")


def day_of(epoch_ms: Column) -> Column:
    return F.timestamp_millis(epoch_ms).cast("date").cast("string")


def with_event_date_parts(df):
    """year, month, day of ``event_time`` in UTC."""
    moment = F.timestamp_millis(F.col("event_time"))
    return df.withColumns({"year": F.year(moment), "month": F.month(moment),
                           "day": F.dayofmonth(moment)})


def tick_order(event_time: Column, trade_id: Column) -> Column:
    """(event_time, trade_id) as one DECIMAL(38,0).

    A decimal ordering key keeps min_by/max_by in a hash aggregate; a struct key would make Spark
    sort every tick first. A missing trade id sorts before the others of its millisecond.
    """
    scale = F.lit("20000000000000000000").cast("decimal(20,0)")
    return (event_time.cast("decimal(18,0)") * scale
            + F.coalesce(trade_id, F.lit(-1)).cast("decimal(20,0)")).cast("decimal(38,0)")


def bar_of(epoch_ms: Column, width_ms: int) -> Column:
    """Start of the UTC-aligned bucket, in epoch ms."""
    return epoch_ms - F.pmod(epoch_ms, F.lit(width_ms))


def fixed6(value: Column) -> Column:
    """Round half up to six decimals by plain double arithmetic."""
    return F.floor(value * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6)
