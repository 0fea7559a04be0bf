"""Spelling variants by blocked Gram matrices of letter counts (operator 12).

The distinct words are cut into blocks of one length and one way to spread their letters over a few
classes. One edit moves a word to an adjacent block: a letter more in one class (adjacent length), or
one more here and one less there. The product of two blocks' letter-count matrices gives all squared
distances at once: an inserted letter is at distance 1, a replaced one at 2. The pairs at most two
apart are verified letter by letter.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm.tables import stage

LEAST_LETTERS, LEAST_COUNT = 7, 2
# One run in SLIP loses a letter; a form is FORM_LIFT times as frequent as its variant.
SLIP, FORM_LIFT = 31, 10
# Words, and letters, that one side of a product holds; blocks that meet one block in a call.
PART_WORDS, PART_LETTERS, BLOCKS_A_CALL = 1024, 1 << 21, 16
# Distinct words a worker counts before it hands its counts on.
FLUSH = 200_000
# All that a lower-cased run can hold, most frequent first so that classes are of like weight.
LETTERS = "etaoinshrdlcumwfgypbvkjxqz" + "".join(map(chr, range(0xC0, 0x100)))
_COLUMN = np.zeros(256, np.int64)
_COLUMN[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))


def _slipped(run: str, prefix: int) -> str:
    h = zlib.crc32(run.encode(), prefix)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counted(least: int):
    runs_of = re.compile(f"[a-zÀ-ÿ]{{{least},}}")

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
        for batch in rows:
            for doc, text in zip(batch.column(0), batch.column(1)):
                # bytes.lower changes A-Z only.
                found = Counter(runs_of.findall((text.as_py() or "").encode().lower().decode()))
                prefix = zlib.crc32(f"{'' if doc.as_py() is None else doc.as_py()}:".encode())
                for run, n in found.items():
                    word = _slipped(run, prefix)
                    if len(word) >= least:
                        total[word] += n
                if len(total) >= FLUSH:
                    yield out()
                    total.clear()
        yield out()
    return batches


def _letters(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def _counts(codes: np.ndarray) -> np.ndarray:
    rows, length = codes.shape
    width = len(LETTERS)
    cells = (np.arange(rows)[:, None] * width + _COLUMN[codes]).ravel()
    # Single precision holds every product of two words up to 4,000 letters exactly.
    kind = np.float32 if length < 4000 else np.float64
    return np.bincount(cells, minlength=rows * width).reshape(rows, width).astype(kind)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of ``a`` and ``b`` differ by one edit; ``b`` is as long or one letter longer."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(a == b[:, :length], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= length


def _near(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the near pairs of two letter matrices."""
    ca, cb = _counts(a), _counts(b)
    square = (ca * ca).sum(axis=1)[:, None] + (cb * cb).sum(axis=1)[None, :] - 2 * (ca @ cb.T)
    i, j = np.nonzero((square <= 2) & (square >= 1))
    step = max(1, PART_LETTERS // b.shape[1])
    good = [_one_edit(a[i[k:k + step]], b[j[k:k + step]]) for k in range(0, len(i), step)]
    good = np.concatenate(good) if good else np.zeros(0, bool)
    return i[good], j[good]


class _Best:
    """Near words counted, and the first of them in the order of ``rank``, for each of ``size`` words."""

    def __init__(self, size: int):
        self.count, self.rank = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)

    def add(self, at: np.ndarray, rank: np.ndarray) -> None:
        np.add.at(self.count, at, 1)
        np.minimum.at(self.rank, at, rank)


def _ranked(words: list[str], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's place by falling frequency, then code points; and the words' numbers in that order."""
    order = np.array(sorted(range(len(words)), key=lambda k: (-n[k], words[k])), np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place, order


def _compare(table: pa.Table) -> pa.Table:
    """(word, n_near, best_n, best): one block against up to BLOCKS_A_CALL others, or itself."""
    side = table.column("side").to_numpy()
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    mine = np.flatnonzero(side == 0)
    own, own_n = [words[k] for k in mine], n[mine]
    # Words are dealt to parts by hash, so a part can be empty.
    length = len(own[0]) if own else 0
    a = _letters(own, length)
    place, order = _ranked(own, own_n)
    out: list[tuple[str, int, int, str]] = []

    def tell(best: _Best, names: list[str], of: list[str], of_n: np.ndarray, by: np.ndarray) -> None:
        for k in np.flatnonzero(best.count):
            first = by[best.rank[k]]
            out.append((names[k], int(best.count[k]), int(of_n[first]), of[first]))
    for kind in (1, 2):  # others, itself
        for more in (0, 1) if own else ():
            theirs = [k for k in np.flatnonzero(side == kind) if len(words[k]) == length + more]
            for low in range(0, len(theirs), 2 * PART_WORDS):
                part = theirs[low:low + 2 * PART_WORDS]
                names, part_n = [words[k] for k in part], n[part]
                i, j = _near(a, _letters(names, length + more))
                there, by = _ranked(names, part_n)
                ahead = _Best(len(own))
                ahead.add(i, there[j])
                tell(ahead, own, names, part_n, by)
                if kind == 1:
                    back = _Best(len(names))
                    back.add(j, place[i])
                    tell(back, names, own, own_n, order)
    word, count, best_n, best = zip(*out) if out else ((), (), (), ())
    return pa.table({"word": pa.array(word, pa.string()), "n_near": pa.array(count, pa.int64()),
                     "best_n": pa.array(best_n, pa.int64()), "best": pa.array(best, pa.string())})


def _near_words(words: DataFrame, classes: int) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have near ones, over all blocks that can hold one."""
    members = [LETTERS[k::classes] for k in range(classes)]
    own = words.withColumns({f"c{k}": F.length("word") - F.length(F.translate("word", m, ""))
                             for k, m in enumerate(members)})

    def key(**moved: int):
        return F.concat_ws(",", *[(F.col(f"c{k}") + moved.get(f"c{k}", 0)).cast("string") for k in range(classes)])
    room = F.greatest(F.lit(1), F.least(F.lit(PART_WORDS), F.floor(PART_LETTERS / F.length("word"))))
    own = own.withColumns({"key": key(), "room": room})
    blocks = own.groupBy("key", *[f"c{k}" for k in range(classes)]).agg(
        F.ceil(F.count("*") / F.max("room")).alias("parts"), F.max("room").alias("room"))
    blocks = stage(blocks, "spelling-blocks")
    placed = stage(own.join(blocks.select("key", "parts"), "key").select(
        "key", F.pmod(F.xxhash64("word"), "parts").alias("part"), "word", "n"), "spelling-words")

    # Blocks one edit away, each pair of blocks once: a letter more, or one more here and one less further on.
    away = [key()] + [key(**{f"c{i}": 1}) for i in range(classes)] + [
        key(**{f"c{i}": 1, f"c{j}": -1}) for i in range(classes) for j in range(i + 1, classes)]

    def each(column: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(column) - 1))
    met = (blocks.select(F.col("key").alias("key_a"), F.col("parts").alias("parts_a"), "room", F.explode(F.array(*away)).alias("key"))
           .join(blocks.select("key", "parts"), "key")
           .withColumn("part_a", each("parts_a")).withColumn("part", each("parts"))
           .filter("key <> key_a or part >= part_a"))
    # Blocks of very long words meet one at a time.
    a_call = F.when(F.col("room") < PART_WORDS, 1).otherwise(BLOCKS_A_CALL)
    met = stage(met.select(
        "key_a", "part_a", "key", "part", F.when((F.col("key") == F.col("key_a")) & (F.col("part") == F.col("part_a")), 2)
        .otherwise(1).alias("side"), F.pmod(F.xxhash64("key", "part"), F.greatest(F.lit(1), F.ceil(
            F.count("*").over(Window.partitionBy("key_a", "part_a")) / a_call))).alias("call")), "spelling-meetings")
    call = ["key_a", "part_a", "call"]
    left = met.select(*call).distinct().join(placed.select(
        F.col("key").alias("key_a"), F.col("part").alias("part_a"), "word", "n"), ["key_a", "part_a"]).withColumn("side", F.lit(0))
    right = met.join(placed, ["key", "part"])
    columns = [*call, "side", "word", "n"]
    return left.select(*columns).union(right.select(*columns)).groupBy(*call).applyInArrow(
        _compare, "word string, n_near long, best_n long, best string")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): each word's last form. A chain grows tenfold a step, so doubling ends after few rounds."""
    reached = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(reached.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        reached = moved.select("word", "root")


def variants(docs: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every distinct word of at least ``least`` letters that occurs twice.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF in whole texts, A-Z lower-cased; where 31
    divides the crc32 of ``<doc_id>:<run>`` the run loses one letter (a null id is written as nothing).
    Near words differ by one inserted, deleted or replaced letter. A word's form is its most frequent near word
    (ties: the first in code-point order) if that is ten times as frequent; its root is the last form, itself
    without one. Null and empty texts have no words; repeated rows count like any others. Long texts are
    read in one pass, very long words compared in smaller blocks. An empty table gives none. Extra columns
    are not read.
    """
    narrow = docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"))
    words = stage(narrow.mapInArrow(_counted(least), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
                  .filter(F.col("n") >= LEAST_COUNT), "spelling-counts")
    # More words, finer blocks: a block has about as many words at any size. No result depends on it.
    classes = max(2, math.ceil(math.log10(max(1, words.count()))) - 1)
    near = stage(_near_words(words, classes), "spelling-near").groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("b"))
    told = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("b.less") >= FORM_LIFT * F.col("n"), F.col("b.best")).alias("form"),
        F.when(-F.col("b.less") >= FORM_LIFT * F.col("n"), -F.col("b.less")).alias("form_n")), "spelling-forms")
    roots = _roots(told.filter("form is not null"))
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
