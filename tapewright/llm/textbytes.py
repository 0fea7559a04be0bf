"""UTF-8 text of whole Arrow batches as numpy arrays: words, lines and their rolling hashes.

Hashes are polynomials modulo 2**64 over a table of random byte values. With prefix sums the hash
of any span is a difference of two sums, so one pass serves words, lines and n-grams alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_tables: dict[str, np.ndarray] = {}


def _powers(name: str, base: np.uint64, size: int) -> np.ndarray:
    table = _tables.get(name)
    if table is None or len(table) < size:
        factors = np.full(max(size, CHUNK_BYTES + 1), base, np.uint64)
        factors[0] = 1
        table = _tables[name] = np.cumprod(factors, dtype=np.uint64)
    return table


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Rolling:
    """Hashes of spans of one value sequence."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers("up", _BASE, len(values) + 1)[:len(values)], out=self.sums[1:])

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        down = _powers("down", _BASE_INVERSE, len(self.sums))
        return mixed((self.sums[end] - self.sums[begin]) * down[begin])


def chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past row, bytes, row offsets) of parts with about CHUNK_BYTES of text; null is ''."""
    text = batch.column(batch.schema.get_field_index(column)).fill_null("").cast(pa.large_string())
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    _, offsets, data = text.buffers()
    if not len(text):
        return
    offsets = np.frombuffer(offsets, np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(text):
        past = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        past = min(len(text), max(past, first + 1))
        yield (first, past, data[offsets[first]:offsets[past]],
               offsets[first:past + 1] - offsets[first])
        first = past


@dataclass
class Words:
    """Word spans of a chunk, each with the row it belongs to, and where each row's words begin."""
    begin: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    space = SPACE[data]
    begins, ends = ~space, ~space
    begins[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    inner = offsets[:-1][np.diff(offsets) > 0]
    begins[inner] = ~space[inner]
    lasts = inner[1:] - 1
    ends[lasts] = ~space[lasts]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(begin, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(begin, end, row, first)


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive values between the borders in ``first``."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]
