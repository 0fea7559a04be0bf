"""SQL views that the checks start from.

They state the expected result of parsing straight from ``events``; no JSON is parsed here.
"""

from tapewright import feed_values as fv

_SYMBOL_LIST = "[" + ", ".join(f"'{s}'" for s in fv.SYMBOL_TABLE) + "]"
_HOUR = 3600000

BASE = f"""base AS (
  SELECT event_id, user_id, event_type, value,
         epoch_us(ts) // 1000 AS event_time,
         epoch_us(ts) // 1000 + event_id % 500 AS received_time,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         ({_SYMBOL_LIST})[CAST(user_id % 7 AS INTEGER) + 1] AS symbol
  FROM events)"""

TRADES = """trades AS (
  SELECT symbol, event_time, event_id AS trade_id, value AS price,
         CAST(k + 1 AS DOUBLE) AS quantity, event_id % 2 = 0 AS is_buyer_maker, received_time
  FROM base)"""

REDELIVERED = """redelivered AS (
  SELECT * FROM trades
  UNION ALL
  SELECT * REPLACE (event_time + 1 AS event_time) FROM trades WHERE trade_id % 10 = 0)"""


def _side(name: str, sign: int) -> str:
    rows = " || ',' || ".join(
        f"""'["' || CAST(price + {sign * (i + 1)} * 0.01 AS DECIMAL(18,2)) || '","' ||
        CAST(size + {i} * (event_id % 3 + {sign + 1}) AS DECIMAL(18,2)) || '"]'"""
        for i in range(5))
    return f"""'"{name}":[' || {rows} || ']'"""


BODIES = f"""parts AS (
  SELECT *, CAST(value AS DECIMAL(18,2)) AS price, CAST(k + 1 AS DECIMAL(18,2)) AS size,
    CASE WHEN event_id % 11 <> 0 THEN '"E":' || event_time END AS e_key,
    CASE WHEN event_id % 13 <> 0 THEN '"s":"' || symbol || '"' END AS s_key,
    CASE WHEN event_id % 23 = 0 THEN 'null' WHEN event_id % 19 = 0 THEN 'text'
         WHEN event_id % 17 = 0 THEN 'zero' ELSE 'good' END AS p_state,
    event_time - event_time % {_HOUR} AS opened
  FROM base),
bars_in AS (
  SELECT *, CAST(price + (k % 7 - 3) * 0.1 AS DECIMAL(18,2)) AS close_in,
    CASE p_state WHEN 'null' THEN '"p":null' WHEN 'text' THEN '"p":"abc"'
         WHEN 'zero' THEN '"p":"0.00"' ELSE '"p":"' || price || '"' END AS p_key,
    greatest(price, close_in) + 0.5 AS top_in, least(price, close_in) - 0.5 AS bottom_in,
    CAST(CASE WHEN event_id % 31 = 0 THEN bottom_in ELSE top_in END AS DECIMAL(18,2)) AS high_in,
    CAST(CASE WHEN event_id % 31 = 0 THEN top_in ELSE bottom_in END AS DECIMAL(18,2)) AS low_in
  FROM parts),
bodies AS (
  SELECT *, CASE
    WHEN event_type = 'click' THEN '{{' || concat_ws(',', e_key, '"M":true', '"T":' || event_time,
      '"e":"trade"', '"m":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END, p_key,
      '"q":"' || size || '"', s_key,
      CASE WHEN event_id % 29 <> 0 THEN '"t":' || event_id END) || '}}'
    WHEN event_type = 'view' THEN '{{' || concat_ws(',', e_key,
      '"P":"' || CAST(k AS DECIMAL(18,2)) || '"', '"c":"' || price || '"', '"e":"24hrTicker"',
      p_key, '"q":"' || CAST(price * (k + 1) AS DECIMAL(18,2)) || '"', s_key,
      '"v":"' || size || '"') || '}}'
    WHEN event_type = 'purchase' THEN '{{' || concat_ws(',', e_key, '"e":"kline"',
      CASE WHEN p_state = 'null' THEN '"k":null' WHEN p_state <> 'text' THEN
        '"k":{{"T":' || (opened + {_HOUR - 1}) || ',"c":"' || close_in || '","h":"' || high_in
        || '","i":"1h","l":"' || low_in || '","o":"'
        || CASE WHEN p_state = 'zero' THEN 'abc' ELSE CAST(price AS VARCHAR) END
        || '","t":' || opened || ',"v":"' || size || '","x":'
        || CASE WHEN event_id % 3 <> 0 THEN 'true' ELSE 'false' END || '}}' END,
      s_key) || '}}'
    WHEN event_type = 'signup' THEN '{{' || concat_ws(',', e_key, {_side("asks", 1)},
      {_side("bids", -1)}, s_key) || '}}'
    WHEN event_id % 6 = 1 THEN '{{"data":{{"E":' || event_time || ',"s":"' || symbol || '"}}}}'
    WHEN event_id % 6 = 2 THEN '{{"stream":"' || lower(symbol) || '@trade"}}'
    WHEN event_id % 6 = 3 THEN '{{}}'
    WHEN event_id % 6 = 4 THEN '{{"E":null,"p":null,"q":null,"s":null}}'
    WHEN event_id % 6 = 5 THEN '{{"E":' || event_time
      || ',"p":"invalid_price","q":"0.001","s":"' || symbol || '"}}'
    END AS raw_data
  FROM bars_in)"""

ENVELOPE = """env AS (
  SELECT event_id, user_id, received_time, raw_data, price AS price_in, size AS size_in, k,
    close_in, high_in, low_in, opened, p_state,
    CASE event_type WHEN 'click' THEN 'trade' WHEN 'view' THEN '24hrTicker'
         WHEN 'purchase' THEN 'kline' ELSE 'unknown' END AS stream_type,
    CASE WHEN event_type = 'signup' THEN 'depthUpdate' ELSE CASE event_type
         WHEN 'click' THEN 'trade' WHEN 'view' THEN '24hrTicker' WHEN 'purchase' THEN 'kline'
         ELSE 'unknown' END END AS event_kind,
    CASE WHEN event_type = 'error' THEN
           CASE event_id % 6 WHEN 0 THEN 'invalid_json' WHEN 4 THEN 'null_symbol' END
         WHEN event_type IN ('click', 'view') AND p_state IN ('null', 'text')
           THEN 'invalid_number'
         WHEN event_type = 'purchase' AND p_state IN ('null', 'zero') THEN 'invalid_kline'
    END AS reject_reason,
    CASE WHEN event_type = 'error' THEN
           CASE WHEN event_id % 6 IN (3, 4, 5) THEN lower(symbol) || '@trade' END
         WHEN event_id % 2 = 0 THEN lower(symbol) || CASE event_type WHEN 'click' THEN '@trade'
           WHEN 'view' THEN '@ticker' WHEN 'purchase' THEN '@kline_1m'
           ELSE '@depth5@100ms' END
    END AS stream_name,
    CASE WHEN reject_reason IS NOT NULL THEN NULL
         WHEN event_type = 'error' THEN CASE WHEN event_id % 6 = 5 THEN symbol ELSE 'UNKNOWN' END
         WHEN s_key IS NULL THEN 'UNKNOWN' ELSE symbol END AS symbol,
    CASE WHEN reject_reason IS NOT NULL THEN NULL
         WHEN event_type = 'error' THEN
           CASE WHEN event_id % 6 = 5 THEN event_time ELSE received_time END
         WHEN e_key IS NULL THEN received_time ELSE event_time END AS event_time,
    CASE WHEN reject_reason IS NOT NULL THEN 0.0::DOUBLE
         WHEN event_type = 'error' THEN
           CASE WHEN event_id % 6 = 5 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - 0.3::DOUBLE - 0.2::DOUBLE END
         ELSE greatest(0.0::DOUBLE, 1.0::DOUBLE
           - CASE WHEN e_key IS NULL THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END
           - CASE WHEN s_key IS NULL THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END
           - CASE WHEN event_type = 'click' AND event_id % 29 = 0 THEN 0.15::DOUBLE
                  ELSE 0.0::DOUBLE END
           - CASE WHEN event_type = 'click' AND (p_state = 'zero' OR price <= 0) THEN 0.2::DOUBLE
                  ELSE 0.0::DOUBLE END
           - CASE WHEN event_type = 'purchase' AND p_state = 'text' THEN 0.5::DOUBLE
                  ELSE 0.0::DOUBLE END)
    END AS data_quality_score,
    CASE WHEN stream_type = 'trade' AND event_id % 29 <> 0 THEN event_id END AS trade_id,
    CASE WHEN p_state = 'zero' THEN 0.0::DOUBLE ELSE price::DOUBLE END AS p_value
  FROM bodies),
ids AS (
  SELECT *, strftime(make_timestamp(event_time * 1000), '%Y-%m-%d') AS date,
    strftime(make_timestamp(received_time * 1000), '%Y-%m-%d') AS received_date,
    CASE WHEN reject_reason IS NULL THEN
      sha256(symbol || '|' || stream_type || '|' || CASE WHEN trade_id IS NOT NULL
        THEN 't:' || trade_id ELSE 'h:' || sha256(raw_data) END) END AS record_id
  FROM env)"""

_ORDER = {
    "base": [BASE], "trades": [BASE, TRADES], "redelivered": [BASE, TRADES, REDELIVERED],
    "ids": [BASE, BODIES, ENVELOPE],
}


def over(view: str, body: str, *more: str) -> str:
    """``WITH <views leading to view>, <more CTEs> <body>``."""
    return "WITH " + ",\n".join([*_ORDER[view], *more]) + "\n" + body.strip()


def fixed6(expression: str) -> str:
    return f"floor(({expression}) * 1e6 + 0.5) / 1e6"
