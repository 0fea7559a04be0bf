"""Message log, bronze tables, topics, symbols and subscriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright import feed_values as fv
from tapewright.functions.routing import day_of, topic_name, with_event_date_parts
from tapewright.operators import bronze, envelope, subscriptions, topics
from tapewright.plans.check_views import over
from tapewright.plans.envelope_queries import klines, messages, normalized
from tapewright.plans.registry import query
from tapewright.session import fresh_path
from tapewright.sources import feed, lake, message_log, symbols
from tapewright.sources.tables import table

# Topic and partition of each message, as the producer would route it.
LOG = """log AS (
  SELECT *, CASE WHEN reject_reason IS NOT NULL THEN 'crypto_raw_unknown_unknown'
    ELSE 'crypto_raw_' || lower(symbol) || '_' || stream_type END AS topic,
    CAST(CASE WHEN reject_reason IS NULL THEN ('0x' || substr(md5(symbol), 1, 15))::BIGINT ELSE event_id END % 3
      AS INTEGER) AS "partition", event_id AS "offset" FROM ids)"""


def log(spark, folder) -> DataFrame:
    return feed.message_log(messages(spark, folder))


def trades(spark, folder) -> DataFrame:
    return feed.trades(table(spark, folder, "events"))


def trade_records(rows: DataFrame) -> DataFrame:
    """Trades as bronze rows: record id from the trade id, day from the event time."""
    return rows.withColumns({
        "record_id": F.sha2(F.concat_ws("|", "symbol", F.lit(fv.TRADE),
                                        F.col("trade_id").cast("string")), 256),
        "date": day_of(F.col("event_time"))})


@query("bronze_scan_count", over("ids", "SELECT topic, count(*) AS n FROM log GROUP BY topic", LOG))
def bronze_scan_count(spark, folder):
    """The log is stored by topic once; each topic scan then reads only its own folder."""
    path = fresh_path(spark, "log")
    message_log.publish(log(spark, folder), path=path)
    return spark.read.parquet(path).groupBy("topic").agg(F.count("*").alias("n"))


@query("bronze_topic_scan", over("ids", """
SELECT "partition", count(*) AS n, min("offset") AS first_offset, max("offset") AS last_offset
FROM log WHERE topic = 'crypto_raw_btcusdt_trade' GROUP BY "partition"
""", LOG))
def bronze_topic_scan(spark, folder):
    """A bounded scan of one topic: the topic is a partition filter, other folders are not read."""
    path = fresh_path(spark, "log")
    message_log.publish(log(spark, folder), path=path)
    return message_log.bounded_scan(spark, f"{fv.TOPIC_PREFIX}btcusdt_{fv.TRADE}", path=path).groupBy("partition").agg(
        F.count("*").alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


@query("bronze_run_summary", over("ids", """
SELECT 'success' AS status, 'bronze_events' AS table_name,
       count(DISTINCT symbol) FILTER (reject_reason IS NULL) AS symbols,
       count(*) FILTER (reject_reason IS NULL) AS record_count,
       count(*) FILTER (reject_reason IS NOT NULL) AS rejected_count
FROM ids"""))
def bronze_run_summary(spark, folder):
    return bronze.ingest(spark, log(spark, folder), fresh_path(spark, "bronze"), "bronze_events",
                         mode="insert")


@query("bronze_parse_fixed", over("ids", """
SELECT CASE WHEN reject_reason IS NULL THEN record_id
       END AS accepted_id, symbol,
       CASE WHEN reject_reason IS NULL THEN stream_type END AS stream_type, event_time,
       received_time, date, CASE WHEN reject_reason IS NULL THEN raw_data END AS raw_data,
       data_quality_score, received_time AS logged_ms FROM ids"""))
def bronze_parse_fixed(spark, folder):
    rows = bronze.parse_fixed(log(spark, folder))
    return rows.select(
        F.when(F.col("symbol").isNotNull(), F.col("record_id")).alias("accepted_id"), "symbol",
        "stream_type", "event_time", "received_time", "date", "raw_data", "data_quality_score",
        F.unix_millis("kafka_timestamp").alias("logged_ms"))


@query("bronze_event_date_parts", over("trades", """
SELECT trade_id, CAST(year(make_timestamp(event_time * 1000)) AS INTEGER) AS year,
       CAST(month(make_timestamp(event_time * 1000)) AS INTEGER) AS month,
       CAST(day(make_timestamp(event_time * 1000)) AS INTEGER) AS day FROM trades"""))
def bronze_event_date_parts(spark, folder):
    return with_event_date_parts(trades(spark, folder)).select("trade_id", "year", "month", "day")


@query("bronze_upsert_latest", over("redelivered", """
SELECT symbol, strftime(make_timestamp(max(event_time) * 1000), '%Y-%m-%d') AS date, trade_id,
       max(event_time) AS event_time, any_value(price) AS price,
       any_value(quantity) AS quantity
FROM redelivered GROUP BY symbol, trade_id"""))
def bronze_upsert_latest(spark, folder):
    """A first load, then a load in which a tenth of the trades arrive again, later."""
    path = fresh_path(spark, "bronze_trade")
    first = trades(spark, folder)
    lake.upsert(spark, trade_records(first), path, batch_id=1)
    lake.upsert(spark, trade_records(feed.redelivered(first)), path, batch_id=2)
    return lake.read(spark, path).select("symbol", "date", "trade_id", "event_time", "price",
                                         "quantity")


@query("bronze_insert_append", over("redelivered", """
SELECT symbol, count(*) AS n, count(DISTINCT trade_id) AS n_trades
FROM redelivered GROUP BY symbol"""))
def bronze_insert_append(spark, folder):
    path = fresh_path(spark, "bronze_append")
    lake.insert(trade_records(feed.redelivered(trades(spark, folder))), path, batch_id=1)
    per_trade = lake.read(spark, path).groupBy("symbol", "trade_id").agg(F.count("*").alias("c"))
    return per_trade.groupBy("symbol").agg(F.sum("c").alias("n"), F.count("*").alias("n_trades"))


@query("bronze_partition_layout", over("trades", """
SELECT symbol, strftime(make_timestamp(event_time * 1000), '%Y-%m-%d') AS date,
       'symbol=' || symbol || '/date=' || strftime(make_timestamp(event_time * 1000), '%Y-%m-%d')
         AS folder, count(*) AS n
FROM trades GROUP BY ALL"""))
def bronze_partition_layout(spark, folder):
    path = fresh_path(spark, "bronze_layout")
    lake.insert(trade_records(trades(spark, folder)), path)
    place = F.regexp_extract(F.col("_metadata.file_path"), r"(symbol=[^/]+/date=[^/]+)/", 1)
    return (lake.read(spark, path).groupBy("symbol", "date", place.alias("folder"))
            .agg(F.count("*").alias("n")))


@query("bronze_incremental", over("trades", """
SELECT trade_id, event_time + 1 AS event_time FROM trades WHERE trade_id % 10 = 0"""))
def bronze_incremental(spark, folder):
    """Only what the second batch brought."""
    path = fresh_path(spark, "bronze_incremental")
    first = trades(spark, folder)
    lake.insert(trade_records(first), path, batch_id=1)
    again = feed.redelivered(first).join(first.select("trade_id", "event_time"),
                                         ["trade_id", "event_time"], "left_anti")
    lake.insert(trade_records(again), path, batch_id=2)
    return lake.since(spark, path, last_batch=1).select("trade_id", "event_time")


@query("bronze_union_types", over("ids", """
SELECT event_kind, count(*) AS n, count(p_value) FILTER (WHERE event_kind = 'trade') AS n_price,
       count(*) FILTER (WHERE event_kind = '24hrTicker') AS n_last_price,
       count(*) FILTER (WHERE event_kind = 'kline') AS n_close,
       count(*) FILTER (WHERE event_kind = 'depthUpdate') AS n_bids
FROM ids WHERE reject_reason IS NULL GROUP BY event_kind"""))
def bronze_union_types(spark, folder):
    """Four typed tables stored one by one, read back as one relation; other types have their header."""
    rows = envelope.with_levels(envelope.accepted(normalized(spark, folder)))
    path = fresh_path(spark, "bronze_typed")
    (rows.select("event_kind", *envelope.HEADER, *envelope.TRADE_COLUMNS, "last_price", "close",
                 "bids").hint("rebalance", "event_kind")
     .write.partitionBy("event_kind").parquet(path))
    stored = spark.read.parquet(path)
    kinds = {fv.TRADE: "price", fv.TICKER: "last_price", fv.KLINE: "close", fv.DEPTH: "bids"}
    union = stored.filter(~F.col("event_kind").isin(*kinds)).select("event_kind", "record_id")
    for kind, column in kinds.items():
        part = stored.filter(F.col("event_kind") == kind).select("event_kind", "record_id", column)
        union = union.unionByName(part, allowMissingColumns=True)
    return union.groupBy("event_kind").agg(
        F.count("*").alias("n"),
        *[F.count(column).alias(f"n_{column}") for column in kinds.values()])


def _upsert_twice(spark, rows: DataFrame, label: str) -> DataFrame:
    """Load, then load everything again one millisecond later: the later copy stays."""
    path = fresh_path(spark, label)
    staged = fresh_path(spark, f"{label}_rows")
    rows.write.parquet(staged)
    rows = spark.read.parquet(staged)
    lake.upsert(spark, rows, path, batch_id=1)
    lake.upsert(spark, rows.withColumn("event_time", F.col("event_time") + 1), path, batch_id=2)
    return lake.read(spark, path)


@query("bronze_ticker_upsert", over("ids", """
SELECT record_id, any_value(symbol) AS symbol, max(event_time) + 1 AS event_time,
       any_value(price_in::DOUBLE) AS last_price
FROM ids WHERE reject_reason IS NULL AND stream_type = '24hrTicker' GROUP BY record_id"""))
def bronze_ticker_upsert(spark, folder):
    rows = envelope.typed_rows(normalized(spark, folder), fv.TICKER)
    return _upsert_twice(spark, rows, "bronze_ticker").select("record_id", "symbol", "event_time",
                                                              "last_price")


@query("bronze_kline_upsert", over("ids", """
SELECT record_id, any_value(symbol) AS symbol, max(event_time) + 1 AS event_time,
       any_value(CASE WHEN p_state = 'text' THEN 0.0 ELSE close_in::DOUBLE END) AS close
FROM ids WHERE reject_reason IS NULL AND stream_type = 'kline' GROUP BY record_id"""))
def bronze_kline_upsert(spark, folder):
    return _upsert_twice(spark, klines(spark, folder), "bronze_kline").select(
        "record_id", "symbol", "event_time", "close")


@query("topic_route", over("ids", """
SELECT event_id, topic, symbol AS key FROM log WHERE reject_reason IS NULL""", LOG))
def topic_route(spark, folder):
    rows = envelope.accepted(normalized(spark, folder))
    return rows.select("event_id", topic_name(F.col("symbol"), F.col("stream_type")).alias("topic"),
                       F.col("symbol").alias("key"))


@query("topic_inventory", over("ids", """
SELECT DISTINCT topic FROM log WHERE starts_with(topic, 'crypto_')""", LOG))
def topic_inventory(spark, folder):
    return topics.inventory(log(spark, folder))


@query("topic_counts", over("ids", """
SELECT topic, CAST(sum(last + 1) AS BIGINT) AS end_offsets, CAST(sum(n) AS BIGINT) AS messages
FROM (SELECT topic, "partition", max("offset") AS last, count(*) AS n FROM log GROUP BY ALL)
GROUP BY topic""", LOG))
def topic_counts(spark, folder):
    return topics.counts(log(spark, folder))


@query("topic_sample", over("ids", """
SELECT topic, "partition", "offset", symbol,
       CASE WHEN reject_reason IS NULL THEN stream_type END AS stream_type
FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY "partition", "offset") AS rn
      FROM log) WHERE rn = 1""", LOG))
def topic_sample(spark, folder):
    return topics.first_message(log(spark, folder))


@query("topic_first_key", over("ids", """
SELECT topic, "partition", "offset" FROM log WHERE symbol = 'ADAUSDT'
ORDER BY received_time, topic, "partition", "offset" LIMIT 1""", LOG))
def topic_first_key(spark, folder):
    return topics.first_with_key(log(spark, folder), "ADAUSDT").select("topic", "partition",
                                                                       "offset")


_DIM = "dim AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', '{e['name']}', {e['priority']}, {str(e.get('enabled', True)).upper()}, "
    f"{e['streams']})" for s, e in fv.SYMBOL_TABLE.items()) + \
    ") AS d(symbol, name, priority, enabled, streams))"


@query("symbol_dim", over("trades", """
SELECT symbol, any_value(name) AS name, CAST(any_value(priority) AS INTEGER) AS priority,
       any_value(enabled) AS enabled, count(*) AS trades
FROM trades JOIN dim USING (symbol) GROUP BY symbol""", _DIM))
def symbol_dim(spark, folder):
    """The dimension next to what was traded."""
    per_symbol = trades(spark, folder).groupBy("symbol").agg(F.count("*").alias("trades"))
    return symbols.symbol_dim(spark).join(per_symbol, "symbol").select(
        "symbol", "name", "priority", "enabled", "trades")


@query("symbol_lookup", over("ids", """
SELECT symbol, name, CAST(priority AS INTEGER) AS priority,
       array_to_string(coalesce(streams, ['trade', 'ticker', 'kline_1m']), ',') AS streams,
       count(*) AS n
FROM ids LEFT JOIN dim USING (symbol) WHERE reject_reason IS NULL GROUP BY ALL""", _DIM))
def symbol_lookup(spark, folder):
    rows = envelope.accepted(normalized(spark, folder)).groupBy("symbol").agg(
        F.count("*").alias("n"))
    return subscriptions.with_config(rows, symbols.symbol_dim(spark)).select(
        "symbol", "name", "priority", F.array_join("streams", ",").alias("streams"), "n")


@query("active_symbols", over("trades", """
SELECT symbol, count(*) AS trades, any_value(priority) <= 1 AS in_development
FROM trades JOIN dim USING (symbol) WHERE enabled AND priority <= 3 GROUP BY symbol""", _DIM))
def active_symbols(spark, folder):
    """Trades of the symbols active outside development, and whether they also are within it."""
    dim = symbols.symbol_dim(spark)
    development = subscriptions.active(dim, "development").withColumn("in_development", F.lit(True))
    chosen = (subscriptions.active(dim, "production").join(development, "symbol", "left")
              .na.fill({"in_development": False}))
    per_symbol = trades(spark, folder).groupBy("symbol").agg(F.count("*").alias("trades"))
    return per_symbol.join(chosen, "symbol").select("symbol", "trades", "in_development")


@query("subscription_plan", over("ids", """
, seen AS (SELECT symbol, count(*) AS n FROM ids WHERE reject_reason IS NULL GROUP BY symbol),
wanted AS (SELECT DISTINCT unnest(coalesce(streams, ['trade', 'ticker', 'kline_1m'])) AS stream
           FROM seen LEFT JOIN dim USING (symbol)),
known AS (SELECT * FROM (VALUES ('trade', 'trade'), ('ticker', 'ticker'),
          ('kline_1m', 'kline_1m'), ('depth5', 'depth5@100ms')) AS k(stream, suffix))
SELECT symbol, stream, lower(symbol) || '@' || suffix AS feed_name, n
FROM seen, known WHERE stream IN (SELECT stream FROM wanted)""", _DIM))
def subscription_plan(spark, folder):
    """The subscriptions that the symbols seen in the feed call for."""
    seen = envelope.accepted(normalized(spark, folder)).groupBy("symbol").agg(
        F.count("*").alias("n"))
    rows = subscriptions.plan(seen.select("symbol"), symbols.symbol_dim(spark))
    return rows.join(seen, "symbol").select("symbol", "stream", "feed_name", "n")
