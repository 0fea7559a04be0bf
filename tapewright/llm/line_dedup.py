"""Repeated runs of lines, found by winnowing line hashes (operator 7, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.tables import WORD, stage

MIN_WORDS = 50
_KEY = ["__doc", "__k1", "__k2"]


def _key(docs: DataFrame) -> list[Column]:
    return [docs["doc_id"].alias("__doc"), F.xxhash64(docs["text"]).alias("__k1"),
            F.xxhash64(F.lit(1), docs["text"]).alias("__k2")]


def _lines(text: Column) -> Column:
    """Lines with a word: place (from 0), two hashes, words."""
    lines = F.transform(F.split(text, "\n", -1), lambda line, at: F.struct(
        at.alias("at"), F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"),
        F.regexp_count(line, F.lit(WORD)).alias("n")))
    return F.filter(lines, lambda line: line["n"] > 0)


def _windows(lines: Column, min_words: int) -> Column:
    """Windows of lines with ``min_words`` words: the shortest from each line on, and up to each line.

    Each has its first index (from 1), its length, and its fingerprint: least hash and its index.
    Any run of lines with that many words is the union of the windows inside it, and equal runs
    have equal windows and so equal fingerprints.
    """
    full = min_words * 1000
    index = F.sequence(F.lit(1), F.size(lines))

    def reach(part: Column) -> Column:
        """Lines needed for the words, plus 1000 times the words they have, at most min_words."""
        return F.aggregate(part, F.lit(0), lambda acc, line: F.when(acc >= full, acc).otherwise(
            acc + F.least(line["n"], F.lit(min_words)) * 1000 + 1))

    def window(first: Column, length: Column, complete: Column) -> Column:
        least = F.array_min(F.transform(F.slice(lines, first, length), lambda line, k: F.struct(
            line["a"].alias("a"), (first + k).alias("at"))))
        return F.when(complete, F.struct(first.alias("first"), length.alias("length"), least.alias("least")))

    ahead = F.transform(index, lambda i: reach(F.slice(lines, i, F.lit(min_words))))
    back = F.transform(index, lambda i: reach(F.reverse(F.slice(
        lines, F.greatest(i - min_words + 1, F.lit(1)), F.least(i, F.lit(min_words))))))
    both = F.concat(
        F.transform(ahead, lambda r, i: window(i + 1, r % 1000, r >= full)),
        # A line that is long enough alone has the same window both ways.
        F.transform(back, lambda r, i: window(i + 2 - r % 1000, r % 1000, (r >= full) & (r % 1000 > 1))))
    return F.when(F.size(lines) > 0, F.filter(both, lambda w: w.isNotNull()))


def removals(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(__doc, __k1, __k2, lines): the line numbers (from 0) to delete from each document that has any."""
    docs = stage(docs.select(*_key(docs), _lines(docs["text"]).alias("lines"))
                 .filter(F.aggregate("lines", F.lit(0), lambda acc, line: F.least(
                     acc + F.least(line["n"], F.lit(min_words)), F.lit(min_words))) >= min_words), "lines")
    anchors = docs.select(*_KEY, F.explode(F.array_distinct(F.transform(
        _windows(F.col("lines"), min_words), lambda w: w["least"]))).alias("least")).select(
            *_KEY, F.col("least.a").alias("print"), F.col("least.at").alias("at"))
    # Fingerprints at two places or more; repeated rows of one document are one place.
    place = F.xxhash64(*_KEY, "at")
    shared = (anchors.groupBy("print").agg(F.min(place).alias("low"), F.max(place).alias("high"))
              .filter("low <> high").select("print"))
    hits = stage(anchors.join(shared, "print", "left_semi").groupBy(*_KEY)
                 .agg(F.collect_set("at").alias("hits")), "line-hits")
    # Extend each shared place both ways: every window whose fingerprint it is.
    known = docs.alias("l").join(hits.alias("r"), _same("l", "r")).select(
        *[F.col(f"l.{c}") for c in _KEY], "lines", "hits")
    opened = known.select(*_KEY, "lines", F.explode(F.filter(
        _windows(F.col("lines"), min_words),
        lambda w: F.array_contains(F.col("hits"), w["least"]["at"]))).alias("w"))
    part = F.slice(F.col("lines"), F.col("w.first"), F.col("w.length"))
    runs = stage(opened.select(
        *_KEY, F.col("w.first").alias("first"), F.col("w.length").alias("length"),
        F.xxhash64(F.transform(part, lambda line: line["a"])).alias("run_a"),
        F.xxhash64(F.transform(part, lambda line: line["b"])).alias("run_b"),
        F.transform(part, lambda line: line["at"]).alias("places")), "line-runs")
    firsts = (runs.groupBy("run_a", "run_b")
              .agg(F.min(F.struct(*_KEY, "first")).alias("origin"), F.max(F.struct(*_KEY, "first")).alias("last"))
              .filter(F.col("origin") != F.col("last")).drop("last"))
    later = runs.join(firsts, ["run_a", "run_b"]).withColumn("here", F.struct(*_KEY, "first")).filter(
        F.col("here") != F.col("origin"))
    same_doc = F.lit(True)
    for c in _KEY:
        same_doc = same_doc & F.col(c).eqNullSafe(F.col(f"origin.{c}"))
    # Where a run repeats itself, the lines of its first occurrence stay.
    skip = F.when(same_doc, F.greatest(F.col("origin.first") + F.col("length") - F.col("first"), F.lit(0))).otherwise(0)
    gone = later.select(*_KEY, F.slice("places", F.lit(1) + skip, F.col("length")).alias("places"))
    return gone.groupBy(*_KEY).agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("lines")).filter(
        F.size("lines") > 0)


def _same(left: str, right: str) -> Column:
    out = F.lit(True)
    for c in _KEY:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def _cleaned(docs: DataFrame, min_words: int) -> DataFrame:
    """``docs`` with ``__gone`` (line numbers or null) and ``__text``."""
    found = removals(docs, min_words)
    keyed = docs.select(*[docs[c] for c in docs.columns], *_key(docs))
    joined = keyed.alias("l").join(found.alias("r"), _same("l", "r"), "left").select(
        *[F.col(f"l.`{c}`") for c in docs.columns], F.col("r.lines").alias("__gone"))
    lines = F.split(F.col("text"), "\n", -1)
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone")),
                       lambda at: F.get(lines, at))
    return joined.withColumn("__text", F.when(F.col("__gone").isNull(), F.col("text"))
                             .otherwise(F.array_join(left, "\n")))


def report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, lines, removed (ascending line numbers from 0) and the text that is left.

    Deleted are the lines of every run with ``min_words`` words or more, over one or several
    lines, that equals a run at an earlier place: by doc_id, then hashes of the text, then line.
    The first occurrence stays. Lines without a word are skipped over and never deleted. Rows
    equal in id and text are one document and get the same result. Null texts stay null, with 0
    lines; a null id sorts first. An empty table gives none. Extra columns are not read.
    """
    return _cleaned(docs.select("doc_id", "text"), min_words).select(
        "doc_id", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).alias("lines"),
        F.coalesce(F.array_sort("__gone"), F.array().cast("array<int>")).alias("removed"),
        F.col("__text").alias("text"))


def clean(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs cut from ``text`` and all other columns as they were.

    Documents that lose all their words go. Otherwise as ``report``.
    """
    cleaned = _cleaned(docs, min_words)
    left = cleaned.filter(F.col("__gone").isNull() | F.col("__text").rlike(WORD))
    return left.select(*[F.col("__text").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
