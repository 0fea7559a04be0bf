"""Quality rules by repetition coverage (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tapewright.llm import textbytes as tb

# Largest share of word characters that may lie inside n-grams found twice or more, by n.
NGRAM_LIMITS = {5: 0.40, 7: 0.35, 10: 0.30}
# Largest share of word characters on lines that repeat an earlier line.
LINE_LIMIT = 0.30
MIN_WORDS = 50
REPEAT_WORDS = 3
REPEAT_PERCENT = 50
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

RESULT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, dup_line_chars long, "
          + ", ".join(f"dup_{n}gram_chars long" for n in NGRAM_LIMITS)
          + ", base_failed boolean, kept boolean")


def _measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    rows = len(offsets) - 1
    words = tb.words(data, offsets)
    roll = tb.Rolling(tb._BYTE_VALUE[data])
    chars_before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars_before[1:])
    word_chars = chars_before[words.end] - chars_before[words.begin]
    n_words = np.diff(words.first)
    out = {"n_words": n_words, "word_chars": tb.row_sums(word_chars, words.first),
           "n_symbols": tb.row_sums(_SYMBOL[data], offsets)}

    # Lines: spans between line feeds, never across rows; only those that hold a word count.
    feeds = np.flatnonzero(data == 10)
    begin = np.union1d(offsets[:-1], feeds + 1)
    begin = begin[begin < len(data)] if len(data) else begin[:0]
    end = np.append(begin[1:], len(data))
    end = end - ((end > begin) & (data[end - 1] == 10)) if len(begin) else end
    first_word = np.searchsorted(words.begin, begin)
    past_word = np.searchsorted(words.begin, end)
    worded = past_word > first_word
    begin, end, first_word, past_word = (x[worded] for x in (begin, end, first_word, past_word))
    line_row = np.searchsorted(offsets, begin, "right") - 1
    keys = tb.mixed(roll.spans(begin, end) + tb.mixed(line_row.astype(np.uint64)) + (end - begin).astype(np.uint64))
    _, firsts = np.unique(keys, return_index=True)
    again = np.ones(len(keys), bool)
    again[firsts] = False
    chars_to = np.zeros(len(word_chars) + 1, np.int64)
    np.cumsum(word_chars, out=chars_to[1:])
    out["n_dup_lines"] = np.bincount(line_row[again], minlength=rows)
    out["dup_line_chars"] = np.bincount(
        line_row[again], (chars_to[past_word] - chars_to[first_word])[again], rows).astype(np.int64)

    hashes = roll.spans(words.begin, words.end)
    grams = tb.Rolling(hashes + (words.end - words.begin).astype(np.uint64))
    for n in (REPEAT_WORDS, *NGRAM_LIMITS):
        at = np.arange(max(0, len(hashes) - n + 1))
        at = at[words.row[at] == words.row[at + n - 1]]
        keys = tb.mixed(grams.spans(at, at + n) + tb.mixed(words.row[at].astype(np.uint64)))
        twice = at[tb.repeated(keys)]
        cover = np.zeros(len(hashes) + 1, np.int32)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + n, -1)
        covered = np.cumsum(cover[:-1]) > 0
        if n == REPEAT_WORDS:
            out["n_repeat_words"] = tb.row_sums(covered, words.first)
        else:
            out[f"dup_{n}gram_chars"] = tb.row_sums(word_chars * covered, words.first)
    return out


def _judge(out: dict[str, np.ndarray]) -> None:
    out["base_failed"] = ((out["n_words"] < MIN_WORDS)
                          | (100 * out["n_repeat_words"] > REPEAT_PERCENT * out["n_words"]))
    kept = ~out["base_failed"] & (out["dup_line_chars"] <= LINE_LIMIT * out["word_chars"])
    for n, limit in NGRAM_LIMITS.items():
        kept &= out[f"dup_{n}gram_chars"] <= limit * out["word_chars"]
    out["kept"] = kept


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in RESULT.split(", ")][1:]
    for batch in batches:
        for first, past, data, offsets in tb.chunks(batch, "text"):
            out = _measure(data, offsets)
            _judge(out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, past - first), *(pa.array(out[n]) for n in names)],
                ["doc_id", *names])


def measure(docs: DataFrame) -> DataFrame:
    """One row a document: counts, characters inside repeats, ``base_failed`` and ``kept``.

    Words, lines and n-grams are hashed for a whole Arrow batch at once; text is worked on in
    parts of about 1 MiB, a longer document as a whole. Nothing is shuffled.
    A null or empty text has no words and fails. Repeated rows and equal ids are judged each for
    itself. An empty table gives an empty table. Columns other than ``doc_id`` and ``text`` are
    not looked at.
    """
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return narrow.mapInArrow(_batches, RESULT)


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, past, data, offsets in tb.chunks(batch, "text"):
            out = _measure(data, offsets)
            _judge(out)
            part = batch.slice(first, past - first)
            yield part.filter(pa.array(out["kept"]))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; the same rules as ``measure``."""
    return docs.mapInArrow(_keep, docs.schema)
