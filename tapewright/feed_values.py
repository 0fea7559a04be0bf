"""Fixed values of the feed contract."""

# --- fixed values: topic naming -------------------------------------------------------------
TOPIC_PREFIX = "crypto_raw_"
TOPIC_FAMILY = "crypto_"
FEED_BASE_URL = "wss://stream.binance.com:9443/ws/"

# --- fixed values: event types --------------------------------------------------------------
TRADE = "trade"
TICKER = "24hrTicker"
KLINE = "kline"
DEPTH = "depthUpdate"
EXPECTED_TYPES = (TRADE, TICKER, KLINE, DEPTH)

# --- fixed values: subscribable streams, as (configured name, feed suffix, event type) ------
KNOWN_STREAMS = (
    ("trade", "trade", TRADE),
    ("ticker", "ticker", TICKER),
    ("kline_1m", "kline_1m", KLINE),
    ("depth5", "depth5@100ms", DEPTH),
)
DEFAULT_STREAMS = ("trade", "ticker", "kline_1m")
DEFAULT_PRIORITY = 2
DEVELOPMENT_MAX_PRIORITY = 1
MAX_PRIORITY = 3
FALLBACK_SYMBOLS = (("BTCUSDT", "Bitcoin", 1), ("ETHUSDT", "Ethereum", 1))

# --- fixed values: the shipped symbol table -------------------------------------------------
SYMBOL_TABLE = {
    "BTCUSDT": {"name": "Bitcoin", "priority": 1,
                "streams": ["trade", "ticker", "kline_1m", "depth5"]},
    "ETHUSDT": {"name": "Ethereum", "priority": 1,
                "streams": ["trade", "ticker", "kline_1m", "depth5"]},
    "ADAUSDT": {"name": "Cardano", "priority": 2, "streams": ["trade", "ticker", "kline_1m"]},
    "DOTUSDT": {"name": "Polkadot", "priority": 2, "streams": ["trade", "ticker", "kline_1m"]},
    "LINKUSDT": {"name": "Chainlink", "priority": 2, "streams": ["trade", "ticker"]},
    "SOLUSDT": {"name": "Solana", "priority": 3, "streams": ["trade", "ticker"],
                "enabled": False},
    "AVAXUSDT": {"name": "Avalanche", "priority": 3, "streams": ["trade", "ticker"],
                 "enabled": False},
}

# --- fixed values: quality-score penalties, in the order they are subtracted ----------------
PENALTY_NO_EVENT_TIME = 0.3
PENALTY_NO_SYMBOL = 0.2
PENALTY_TRADE_FIELD = 0.15
PENALTY_TRADE_PRICE = 0.2
PENALTY_TRADE_QUANTITY = 0.1
PENALTY_TRADE_NUMBER = 0.3
PENALTY_TICKER_FIELD = 0.2
PENALTY_KLINE_BODY = 0.5
PENALTY_KLINE_FIELD = 0.1

# --- fixed values: other --------------------------------------------------------------------
RAW_PREVIEW_CHARS = 500
QUALITY_THRESHOLD = 0.8
