"""Feed text -> normalised, scored, typed rows, or a reasoned rejection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright import feed_values as fv
from tapewright.functions import feed_json as fj
from tapewright.functions.barrier import barrier
from tapewright.functions.quality import common_score, quality_score
from tapewright.functions.routing import day_of, stable_record_id, topic_name

HEADER = ["record_id", "symbol", "stream_type", "stream_name", "event_time", "received_time",
          "date", "received_date", "raw_data", "data_quality_score"]
TRADE_COLUMNS = ["price", "quantity", "trade_id", "is_buyer_maker"]
TICKER_COLUMNS = ["price_change", "price_change_percent", "last_price", "volume", "quote_volume"]
KLINE_COLUMNS = ["interval", "open", "high", "low", "close", "volume", "is_closed",
                 "bar_open_time", "bar_close_time"]


_VALUES = [f"_value{i}" for i in range(5)]
_TEXTS = [f"_text{i}" for i in range(5)]
_MISSING = [f"_missing{i}" for i in range(5)]
_NUMBERS = [f"_number{i}" for i in range(5)]


def _with_body(messages: DataFrame, text: str) -> DataFrame:
    """Unwrap ``{"stream", "data"}``; anything else is its own body."""
    return (messages
            .withColumn("_box", fj.boxed(F.col(text)))
            .withColumn("_valid", fj.intact("_box", text))
            .withColumn("_enveloped", F.expr(f"_valid AND {fj.may_hold(text, 'stream', 'data')}"))
            .withColumns({key: F.expr(f"CASE WHEN _enveloped THEN "
                                      f"variant_get(_box, '$[0].{key[1:]}', 'variant') END")
                          for key in ("_stream", "_data")})
            .withColumn("_wrapped", F.expr("_stream IS NOT NULL AND _data IS NOT NULL"))
            .withColumns({
                "_body": F.expr("CASE WHEN NOT _valid THEN NULL WHEN _wrapped THEN _data "
                                "ELSE variant_get(_box, '$[0]', 'variant') END"),
                "_name": F.expr("CASE WHEN _valid AND _wrapped "
                                "THEN try_variant_get(_stream, '$', 'string') END"),
                # The body as it was sent; re-rendering the VARIANT would cost more than the parse.
                "raw_data": F.expr(f"CASE WHEN NOT _valid THEN NULL WHEN _wrapped "
                                   f"THEN get_json_object({text}, '$.data') "
                                   f"ELSE trim({text}) END")}))


def _with_fields(rows: DataFrame) -> DataFrame:
    """Header fields, and the numeric fields of the event type in five shared slots."""
    def slot(feed_key: str, bar_key: str, types: str) -> Column:
        return F.expr(f"CASE WHEN stream_type = '{fv.KLINE}' "
                      f"THEN variant_get(_k, '$.{bar_key}', 'variant') "
                      f"WHEN stream_type IN ({types}) "
                      f"THEN variant_get(_body, '$.{feed_key}', 'variant') END")

    both, ticker = f"'{fv.TRADE}', '{fv.TICKER}'", f"'{fv.TICKER}'"
    return (rows
            .withColumn("_type", F.expr("variant_get(_body, '$.e', 'variant')"))
            .withColumns({
                "stream_type": F.expr("CASE WHEN _type IS NULL THEN 'unknown' "
                                      "ELSE try_variant_get(_type, '$', 'string') END"),
                "_s": fj.field("_body", "s"), "_E": fj.field("_body", "E")})
            .withColumns({
                "_symbol": fj.text_of("_s", None), "_time": fj.long_of("_E", None),
                "_k": F.expr(f"CASE WHEN stream_type = '{fv.KLINE}' "
                             f"THEN variant_get(_body, '$.k', 'variant') END"),
                "_no_s": F.col("_s").isNull(), "_no_E": F.col("_E").isNull(),
                "_no_t": F.expr(f"stream_type = '{fv.TRADE}' "
                                f"AND variant_get(_body, '$.t', 'variant') IS NULL"),
                "_is_depth": F.expr(
                    f"stream_type = 'unknown' AND {fj.may_hold('raw_data', 'bids', 'asks')} "
                    "AND variant_get(_body, '$.bids', 'variant') IS NOT NULL "
                    "AND variant_get(_body, '$.asks', 'variant') IS NOT NULL"),
            })
            .withColumns({"_no_k": F.col("_k").isNull(),
                          "_plain_symbol": F.expr("_symbol RLIKE '^[A-Za-z]' "
                                                  "AND _symbol NOT IN ('true', 'false')"),
                          "_base": common_score(F.col("_no_E"), F.col("_no_s"))})
            .withColumns(dict(zip(_VALUES, [
                slot("p", "o", both), slot("q", "h", both), slot("P", "l", ticker),
                slot("c", "c", ticker), slot("v", "v", ticker)])))
            .withColumns({text: F.expr(f"try_variant_get({value}, '$', 'string')")
                          for value, text in zip(_VALUES, _TEXTS)}))


def _with_numbers(rows: DataFrame) -> DataFrame:
    return (rows
            .withColumns({**{number: fj.number(F.col(text), F.col(value)) for value, text, number
                             in zip(_VALUES, _TEXTS, _NUMBERS)},
                          **{missing: F.col(value).isNull()
                             for value, missing in zip(_VALUES, _MISSING)}})
            .withColumns({
                "_bad_number": F.expr(" OR ".join(f"{name} IS NULL" for name in _NUMBERS)),
                "_any_field": F.expr(" OR ".join(f"NOT {name}" for name in _MISSING))}))


def _reason() -> Column:
    """Why a row cannot enter bronze; NULL when it can. First matching reason wins.

    A body or bar with a known key is an object; only the others are asked for their type. In the
    same way a symbol that starts with a letter is text unless it reads like a literal.
    """
    col = F.col
    stream_type, symbol = col("stream_type"), col("_symbol")
    plain_body = ~(col("_no_s") & col("_no_E"))
    is_object = plain_body | fj.is_kind(col("_body"), "OBJECT")
    bad_kline = ~col("_no_k") & (~(col("_any_field") | fj.is_kind(col("_k"), "OBJECT"))
                                 | col("_bad_number"))
    text_symbol = col("_plain_symbol") | fj.is_kind(col("_s"), "STRING")
    return (F.when(~col("_valid"), "invalid_json")
            .when(~is_object, "not_an_object")
            .when(stream_type.isin(fv.TRADE, fv.TICKER) & col("_bad_number"), "invalid_number")
            .when((stream_type == fv.KLINE) & bad_kline, "invalid_kline")
            .when(~col("_no_s") & symbol.isNull(), "null_symbol")
            .when(~col("_no_s") & ~text_symbol, "invalid_symbol")
            .when(~col("_no_E") & col("_time").isNull(),
                  F.when(fj.text_of("_E", None).isNull(), "null_event_time")
                  .otherwise("invalid_event_time")))


def _score() -> Column:
    return quality_score(F.col("stream_type"), F.col("_base"), F.col("_no_t"), F.col("_no_k"),
                         [F.col(c) for c in _MISSING],
                         [F.col(c) for c in _NUMBERS])


def _typed() -> dict[str, Column]:
    """SQL per typed column; a column of another event type is NULL."""
    def when(types: tuple[str, ...], value: str) -> Column:
        listed = ", ".join(f"'{t}'" for t in types)
        return F.expr(f"CASE WHEN reject_reason IS NULL AND stream_type IN ({listed}) "
                      f"THEN {value} END")

    trade, ticker, kline = (fv.TRADE,), (fv.TICKER,), (fv.KLINE,)
    get = "try_variant_get({0}, '$.{1}', '{2}')".format
    flag = ("CASE WHEN variant_get({0}, '$.{1}', 'variant') IS NULL THEN false "
            "ELSE try_variant_get({0}, '$.{1}', 'boolean') END").format
    n = _NUMBERS
    return {
        "price": when(trade, n[0]), "quantity": when(trade, n[1]),
        "trade_id": when(trade, get("_body", "t", "bigint")),
        "is_buyer_maker": when(trade, flag("_body", "m")),
        "price_change": when(ticker, n[0]), "price_change_percent": when(ticker, n[2]),
        "last_price": when(ticker, n[3]), "volume": when(ticker + kline, n[4]),
        "quote_volume": when(ticker, n[1]),
        "interval": when(kline, get("_k", "i", "string")),
        "open": when(kline, n[0]), "high": when(kline, n[1]), "low": when(kline, n[2]),
        "close": when(kline, n[3]), "is_closed": when(kline, flag("_k", "x")),
        "bar_open_time": when(kline, get("_k", "t", "bigint")),
        "bar_close_time": when(kline, get("_k", "T", "bigint")),
    }


def normalize(messages: DataFrame, text: str = "message", received: str | None = "received_time",
              keep: tuple[str, ...] = (), record_id: str = "stable") -> DataFrame:
    """One row per message with header, typed columns and ``reject_reason``.

    ``received`` names an epoch-ms column; None stamps the current time. ``record_id`` is
    ``"stable"`` (derived from the message) or ``"uuid"`` (new on every read).
    """
    clock = F.col(received) if received else F.unix_millis(F.current_timestamp())
    header = ["raw_text", "received_time", "raw_data", "stream_type", "_body", "_k", "_name",
              "_symbol", "_time", "_is_depth"]
    read = _with_fields(_with_body(
        messages.select(*keep, F.col(text).alias("raw_text"), clock.alias("received_time")),
        "raw_text"))
    # The two barriers also keep each generated method small enough for the JIT compiler.
    parsed = _with_numbers(barrier(read.select(
        *keep, *header, "_valid", "_s", "_E", "_no_s", "_no_E", "_no_t", "_no_k", "_base",
        "_plain_symbol", *_VALUES, *_TEXTS)))
    parsed = barrier(parsed.select(
        *keep, *header, *_NUMBERS, _reason().alias("reject_reason"),
        _score().alias("_score")))
    ok = F.col("reject_reason").isNull()
    rows = (parsed
            .withColumn("event_kind", F.when(F.col("_is_depth"), fv.DEPTH)
                        .otherwise(F.col("stream_type")))
            .select(
                *keep, "raw_text", "reject_reason", "stream_type", "received_time", "event_kind",
                "raw_data", F.col("_name").alias("stream_name"),
                F.when(ok, F.coalesce("_symbol", F.lit("UNKNOWN"))).alias("symbol"),
                F.when(ok, F.coalesce("_time", "received_time")).alias("event_time"),
                F.when(ok, F.col("_score")).otherwise(0.0).alias("data_quality_score"),
                *[value.alias(name) for name, value in _typed().items()]))
    if record_id == "uuid":
        rid = F.expr("uuid()")
    else:
        rid = F.when(F.col("reject_reason").isNull(), stable_record_id(
            F.col("symbol"), F.col("stream_type"), F.col("trade_id"), F.col("raw_data"))) \
            .otherwise(F.sha2(F.coalesce(F.col("raw_text"), F.lit("")), 256))
    return rows.withColumns({
        "record_id": rid,
        "date": day_of(F.col("event_time")),
        "received_date": day_of(F.col("received_time")),
        "is_unexpected_type": ~F.coalesce(F.col("stream_type"), F.lit("")).isin(
            *fv.EXPECTED_TYPES),
    })


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.filter(F.col("reject_reason").isNull())


def dead_letters(normalized: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rejected rows: a short preview for logs, and the whole text so nothing is lost."""
    return normalized.filter(F.col("reject_reason").isNotNull()).select(
        *keep, "record_id", F.col("reject_reason").alias("error"),
        F.substring("raw_text", 1, fv.RAW_PREVIEW_CHARS).alias("raw_message"), "raw_text",
        "received_time", "data_quality_score", topic_name(F.lit(None), F.lit(None)).alias("topic"))


def typed_rows(normalized: DataFrame, stream_type: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The typed bronze projection of one event type."""
    rows = accepted(normalized).filter(F.col("event_kind") == stream_type)
    if stream_type == fv.DEPTH:
        return with_levels(rows).select(*keep, *HEADER, "bids", "asks")
    columns = {fv.TRADE: TRADE_COLUMNS, fv.TICKER: TICKER_COLUMNS,
               fv.KLINE: KLINE_COLUMNS}[stream_type]
    return rows.select(*keep, *HEADER, *columns)


def with_levels(depth_rows: DataFrame) -> DataFrame:
    """Order-book sides as ARRAY<STRUCT<price, qty>>."""
    pairs = F.from_json("raw_data", "bids array<array<string>>, asks array<array<string>>")
    return (depth_rows.withColumn("_pairs", pairs)
            .withColumns({side: fj.levels(f"_pairs.{side}") for side in ("bids", "asks")})
            .drop("_pairs"))
