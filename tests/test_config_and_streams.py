import json

import pytest

from tapewright.operators import subscriptions
from tapewright.operators.export import flatten
from tapewright.session import fresh_path, shared_folder
from tapewright.sources import symbols
from tapewright.streaming import alerts, ingest, sinks, windows


def names(frame):
    return sorted(r[0] for r in frame.collect())


def test_symbol_file(tmp_path):
    path = tmp_path / "symbols.json"
    path.write_text(json.dumps({"symbols": {"abc": {"name": "Abc"}, "skip": "text", "def": {
        "priority": 1, "enabled": False, "streams": ["trade"]}}}))
    assert symbols.load_entries(str(path)) == [
        ("ABC", "Abc", 2, True, ["trade", "ticker", "kline_1m"]),
        ("DEF", "def", 1, False, ["trade"])]
    assert [e[0] for e in symbols.load_entries(str(tmp_path / "none.yaml"))] == ["BTCUSDT", "ETHUSDT"]


def test_active_symbols(spark):
    dim = symbols.symbol_dim(spark)
    assert names(subscriptions.active(dim)) == ["BTCUSDT", "ETHUSDT"]
    assert names(subscriptions.active(dim, "production")) == [
        "ADAUSDT", "BTCUSDT", "DOTUSDT", "ETHUSDT", "LINKUSDT"]
    assert names(subscriptions.active(dim, override=" xrpusdt ,btcusdt")) == ["BTCUSDT", "XRPUSDT"]
    assert names(subscriptions.active(dim, override="")) == ["BTCUSDT", "ETHUSDT"]
    assert names(subscriptions.active(dim.filter("false"))) == ["BTCUSDT", "ETHUSDT"]


def test_subscription_address(spark):
    dim = symbols.symbol_dim(spark)
    chosen = spark.createDataFrame([("ADAUSDT",), ("LINKUSDT",)], "symbol string")
    broad = subscriptions.plan(chosen, dim)
    assert broad.count() == 6 and subscriptions.plan(chosen, dim, exact=True).count() == 5
    url = subscriptions.stream_url(broad, "wss://x/").first().url
    assert url.startswith("wss://x/adausdt@kline_1m/adausdt@ticker/adausdt@trade/linkusdt@")
    with pytest.raises(Exception, match="no valid streams"):
        subscriptions.stream_url(broad.filter("false")).collect()


class Session:
    """Stands in for a session with the given settings."""

    def __init__(self, folder, master):
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "test"})


def test_shared_folder_is_read_from_the_session():
    assert shared_folder(Session("/shared/", "yarn")) == "/shared"
    assert shared_folder(Session(None, "local[2]")) == shared_folder(Session(None, "local[2]"))
    with pytest.raises(ValueError):
        shared_folder(Session(None, "yarn"))


def test_flatten_nested(spark):
    row = flatten(spark.sql("SELECT named_struct('a', 1, 'b', named_struct('c', array(1, 2))) AS s, "
                            "2 AS d")).first()
    assert row.asDict() == {"s_a": 1, "s_b_c": "[1,2]", "d": 2}


def test_repeated_batch_changes_nothing(spark):
    root = fresh_path(spark, "ingest")
    batch = spark.createDataFrame(
        [('{"e":"trade","E":1,"s":"A","t":1,"p":"1","q":"1"}', 5), ("junk", 6)],
        "message string, received_time bigint")
    write = ingest.bronze_writer(spark, root, ("trade",))
    for _ in range(2):
        write(batch, 0)
    assert spark.read.parquet(f"{root}/trade").count() == 1
    assert sinks.read_batches(spark, f"{root}/dead_letters").count() == 1


def test_anomaly_alert(spark):
    scored = spark.createDataFrame([("A", 1, 4.0, True), ("A", 2, 0.0, False)],
                                   "symbol string, bar_ms bigint, zscore double, is_anomaly boolean")
    assert [(r.rule, r.measure) for r in alerts.from_anomalies(scored).collect()] == [
        ("price_anomaly", 4.0)]


@pytest.mark.parametrize("named", [True, False])
def test_trades_without_an_id_are_not_copies_of_each_other(spark, named):
    schema = "symbol string, trade_id long, event_time long, price double, record_id string"
    rows = [("A", None, 1000, 1.0, "r1"), ("A", None, 1000, 2.0, "r2"), ("A", None, 1000, 2.0, "r2"),
            ("A", 7, 1000, 1.0, "r3"), ("A", 7, 1000, 1.0, "r4")]
    root = fresh_path(spark, "test-dedupe")
    trades = spark.createDataFrame(rows, schema)
    if not named:
        trades = trades.drop("record_id")
    trades.write.parquet(f"{root}/trades")
    stream = spark.readStream.schema(trades.schema).parquet(f"{root}/trades")
    sinks.drain_to_table(windows.deduplicate(stream), f"{root}/out", f"{root}/checkpoint")
    out = spark.read.parquet(f"{root}/out")
    assert out.columns == trades.columns
    assert sorted((r["trade_id"] or 0, r["price"]) for r in out.collect()) == [(0, 1.0), (0, 2.0), (7, 1.0)]
