"""Byte-level BPE encoding and decoding on padded numpy matrices (operator 2)."""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tapewright.llm import textbytes as tb

NEVER = np.int32(2**31 - 1)
# Encoded pieces a worker remembers; when full it starts anew. It bounds memory and changes no result.
REMEMBERED = 200_000
# Bytes from which on a piece is merged on linked places: compacting its row each round would cost the square.
LONG = 4096
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """A rank file: bytes of every id, and a hash table from a pair of ids to the id they merge to."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
        size = max(ranks.values()) + 1
        spelled: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            spelled[rank] = token
        self.lengths = np.array([len(t) for t in spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, merged = (np.array(x, np.int64) for x in zip(*pairs))
        self._fill((left << 32 | right).astype(np.uint64), merged.astype(np.int32))

    def _fill(self, keys: np.ndarray, merged: np.ndarray) -> None:
        bits = max(4, int(np.ceil(np.log2(4 * len(keys)))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1), np.uint64)
        self.merged = np.full(1 << bits, NEVER, np.int32)
        slot = ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)
        self.probes = 0
        while len(keys):  # place one key a free slot each round; the others try the next slot
            self.probes += 1
            free = self.keys[slot] == np.uint64(2**64 - 1)
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.merged[slot[placed]] = merged[placed]
            keys, merged, slot = keys[~placed], merged[~placed], (slot[~placed] + 1) & self.mask

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id each pair merges to; NEVER where it does not, or where one is padding (-1)."""
        shape, left, right = left.shape, left.ravel().astype(np.int64), right.ravel().astype(np.int64)
        keys = (left << 32 | (right & 0xFFFFFFFF)).astype(np.uint64)
        slot = ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)
        found = np.where(self.keys[slot] == keys, self.merged[slot], NEVER)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != np.uint64(2**64 - 1)))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & self.mask
            at = self.keys[slot[open_]]
            hit = at == keys[open_]
            found[open_[hit]] = self.merged[slot[open_[hit]]]
            open_ = open_[~hit & (at != np.uint64(2**64 - 1))]
        return found.reshape(shape)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in one array, and how many each has."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        data = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        starts = np.cumsum(lengths) - lengths
        counts = lengths.copy()
        results: list[tuple[np.ndarray, np.ndarray]] = []
        bucket = np.ceil(np.log2(np.maximum(lengths, 1))).astype(int)
        for row in np.flatnonzero(lengths >= LONG):
            bucket[row] = -1
            ids = self._merge_linked(data[starts[row]:starts[row] + lengths[row]])
            results.append((np.array([row]), ids[None, :]))
        for size in np.unique(bucket[(lengths > 0) & (bucket >= 0)]):
            rows = np.flatnonzero((bucket == size) & (lengths > 0))
            width = int(lengths[rows].max())
            at = starts[rows, None] + np.arange(width)
            grid = np.where(np.arange(width) < lengths[rows, None], data[np.minimum(at, len(data) - 1)], -1)
            results += self._merge(rows, grid.astype(np.int32))
        flat = np.zeros(len(data), np.int32)
        for rows, grid in results:
            real = grid >= 0
            counts[rows] = real.sum(axis=1)
            where = starts[rows, None] + np.arange(grid.shape[1])
            flat[where[real]] = grid[real]
        return ragged(flat, starts, counts), counts

    def _merge(self, rows: np.ndarray, grid: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each round every row merges its leftmost pair of least rank; rows without one are done."""
        done = []
        ranks = self.pair(grid[:, :-1], grid[:, 1:]) if grid.shape[1] > 1 else np.zeros((len(rows), 0), np.int32)
        while len(rows):
            if not ranks.shape[1]:
                done.append((rows, grid))
                break
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), at]
            live = least < NEVER
            if not live.all():
                done.append((rows[~live], grid[~live]))
                rows, grid, ranks, at, least = rows[live], grid[live], ranks[live], at[live], least[live]
                if not len(rows):
                    break
            own, width = np.arange(len(rows)), grid.shape[1]
            grid[own, at] = least
            stay = np.ones(grid.shape, bool)
            stay[own, at + 1] = False
            grid = grid[stay].reshape(len(rows), width - 1)
            stay = np.ones(ranks.shape, bool)
            stay[own, at] = False
            ranks = ranks[stay].reshape(len(rows), width - 2)
            if width > 2:
                right = at < width - 2
                ranks[own[right], at[right]] = self.pair(grid[own[right], at[right]], grid[own[right], at[right] + 1])
                left = at > 0
                ranks[own[left], at[left] - 1] = self.pair(grid[own[left], at[left] - 1], grid[own[left], at[left]])
        return done

    def _merge_linked(self, ids: np.ndarray) -> np.ndarray:
        """The merges of ``_merge`` for one long piece: leftmost pair of least rank first, off a heap.

        The dead place of a merge is skipped by links instead of being compacted; the ids left are
        compacted once, at the end.
        """
        count = len(ids)
        ranks = np.append(self.pair(ids[:-1], ids[1:]), NEVER).astype(np.int64)
        heap = (ranks << 32 | np.arange(count))[ranks < NEVER].tolist()
        heapq.heapify(heap)
        ids, ranks = ids.tolist(), ranks.tolist()
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        never, seen = int(NEVER), {}

        def pair(left: int, right: int) -> int:
            key = left << 32 | right
            if key not in seen:
                seen[key] = int(self.pair(np.array([left]), np.array([right]))[0])
            return seen[key]

        def rank_again(at: int) -> None:
            ranks[at] = pair(ids[at], ids[after[at]]) if after[at] < count else never
            if ranks[at] < never:
                heapq.heappush(heap, ranks[at] << 32 | at)
        while heap:
            entry = heapq.heappop(heap)
            at, rank = entry & 0xFFFFFFFF, entry >> 32
            if ranks[at] != rank:  # the place died or got another pair
                continue
            gone = after[at]
            ids[at], ids[gone], ranks[gone] = rank, -1, never
            after[at] = after[gone]
            if after[at] < count:
                before[after[at]] = at
            rank_again(at)
            if before[at] >= 0:
                rank_again(before[at])
        left = np.array(ids, np.int32)
        return left[left >= 0]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return ragged(self.bytes, self.starts[ids], self.lengths[ids])


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``flat[s:s + n]`` for all (s, n)."""
    begin = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - begin, lengths) + np.arange(int(lengths.sum()))]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Pieces:
    """Encoded pieces seen so far, by code: each distinct piece is merged once."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.counts = np.zeros(0, np.int64)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.codes) > REMEMBERED:
            self.clear()
        new = [p for p in dict.fromkeys(pieces) if p not in self.codes]
        if new:
            ids, counts = self.vocab.encode([p.encode() for p in new])
            self.codes.update(zip(new, range(len(self.codes), len(self.codes) + len(new))))
            self.ids = np.concatenate([self.ids, ids])
            self.counts = np.concatenate([self.counts, counts])
            self.starts = np.cumsum(self.counts) - self.counts
        if not pieces:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        codes = np.fromiter(map(self.codes.__getitem__, pieces), np.int64, len(pieces))
        return ragged(self.ids, self.starts[codes], self.counts[codes]), self.counts[codes]


def _offsets(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded (binary, made from the ids) of every document.

    ``pattern`` cuts a text into pieces; each piece is merged by the ranks of the file at ``path``,
    which every executor must be able to open. Special tokens do not exist: their spellings are
    ordinary text. Null and empty texts have no ids. Repeated rows each give a row, an empty table
    none. Extra columns are not read. Text is worked on in parts of about 1 MiB; a longer text,
    or a piece without a cut, is merged whole; the time of a piece grows little faster than its length.
    """
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        known, find = Pieces(vocab), regex.compile(pattern).findall
        for batch in rows:
            for first, past, _, _ in tb.chunks(batch, "text"):
                part = batch.slice(first, past - first)
                found = [find(text) if text else [] for text in part.column(1).to_pylist()]
                ids, counts = known.encode([piece for row in found for piece in row])
                per_row = tb.row_sums(counts, _offsets(np.array([len(f) for f in found], np.int64)))
                spelled = tb.row_sums(vocab.lengths[ids], _offsets(per_row))
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.ListArray.from_arrays(pa.array(_offsets(per_row).astype(np.int32)), pa.array(ids)),
                    pa.Array.from_buffers(pa.binary(), len(part), [
                        None, pa.py_buffer(_offsets(spelled).astype(np.int32)),
                        pa.py_buffer(vocab.decode(ids))])], ["doc_id", "ids", "decoded"])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return narrow.mapInArrow(batches, "doc_id long, ids array<int>, decoded binary")
