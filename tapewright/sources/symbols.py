"""The symbol dimension: a configuration file of a few entries, read on the driver."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession

from tapewright import feed_values as fv
from tapewright import schemas


def _parse(path: str) -> dict:
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".json"):
            return json.load(handle)
        import yaml
        return yaml.safe_load(handle)


def load_entries(path: str | None = None) -> list[tuple]:
    """(symbol, name, priority, enabled, streams) rows.

    No path means the shipped table; a path that does not exist means the two fallback symbols;
    entries that are no mapping are skipped.
    """
    if path is None:
        entries = fv.SYMBOL_TABLE
    elif not os.path.exists(path):
        return [(s, name, priority, True, list(fv.DEFAULT_STREAMS))
                for s, name, priority in fv.FALLBACK_SYMBOLS]
    else:
        entries = (_parse(path) or {}).get("symbols", {})
    return [(symbol.upper(), entry.get("name", symbol),
             int(entry.get("priority", fv.DEFAULT_PRIORITY)), bool(entry.get("enabled", True)),
             list(entry.get("streams", fv.DEFAULT_STREAMS)))
            for symbol, entry in entries.items() if isinstance(entry, dict)]


def symbol_dim(spark: SparkSession, path: str | None = None) -> DataFrame:
    return spark.createDataFrame(load_entries(path), schemas.SYMBOLS)
