"""Quality score of one feed event, 0..1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapewright import feed_values as fv


def _less(score: Column, condition: Column, penalty: float) -> Column:
    return score - F.when(condition, F.lit(penalty)).otherwise(F.lit(0.0))


def common_score(no_time: Column, no_symbol: Column) -> Column:
    """What every event type starts from."""
    return _less(_less(F.lit(1.0), no_time, fv.PENALTY_NO_EVENT_TIME),
                 no_symbol, fv.PENALTY_NO_SYMBOL)


def quality_score(stream_type: Column, base: Column, no_trade_id: Column, no_bar: Column,
                  missing: list[Column], numbers: list[Column]) -> Column:
    """Subtract from ``base`` per missing or implausible field; never below 0.

    The ``no_*`` flags and ``missing`` tell absent keys. ``missing`` and ``numbers`` describe the
    five numeric fields of the event type: trade p, q; ticker p, q, P, c, v; kline o, h, l, c, v.
    The price rule comes before the quantity rule, and a price that
    is no number ends the number rules, so at most one conversion penalty applies.
    """
    price, quantity = numbers[0], numbers[1]
    trade = base
    for absent in (missing[0], missing[1], no_trade_id):
        trade = _less(trade, absent, fv.PENALTY_TRADE_FIELD)
    trade = (trade
             - F.when(price.isNull(), fv.PENALTY_TRADE_NUMBER)
             .when(price <= 0, fv.PENALTY_TRADE_PRICE).otherwise(0.0)
             - F.when(price.isNull(), 0.0).when(quantity.isNull(), fv.PENALTY_TRADE_NUMBER)
             .when(quantity <= 0, fv.PENALTY_TRADE_QUANTITY).otherwise(0.0))

    ticker = base
    for absent in (missing[3], missing[4]):
        ticker = _less(ticker, absent, fv.PENALTY_TICKER_FIELD)

    kline = _less(base, no_bar, fv.PENALTY_KLINE_BODY)
    for absent in missing:
        kline = _less(kline, absent & ~no_bar, fv.PENALTY_KLINE_FIELD)

    score = (F.when(stream_type == fv.TRADE, trade).when(stream_type == fv.TICKER, ticker)
             .when(stream_type == fv.KLINE, kline).otherwise(base))
    return F.greatest(F.lit(0.0), score)
