"""Exact duplicates by deterministic block naming (operator 13).

A text is cut into blocks of BLOCK characters. The distinct blocks are sorted and each gets an integer
as its name; then the distinct pairs of adjacent names are sorted and named, and so on, until one name
is left of each document. Two documents get one name exactly when their texts are equal: a name stands
for the value itself, so no hash decides and nothing can collide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.tables import stage

BLOCK = 512
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _name(frame: DataFrame, by: list[str], keep: list[str], label: str) -> DataFrame:
    """``frame``'s ``keep`` columns with the name of its value in ``by``: its place among the sorted distinct values.

    The distinct values are aggregated before they move and sorted by range, so a value that a third
    of all rows hold is one row; the names are written, so a lost executor cannot deal others.
    """
    names = stage(frame.select(*by).distinct().sort(*by).withColumn(
        "name", F.monotonically_increasing_id()), f"{label}-names")
    return stage(frame.join(names, by).select(*keep, "name"), label)


def _identities(texts: DataFrame, block: int) -> DataFrame:
    """(row, depth, name) of each (row, norm): equal texts, and no others, agree in depth and name."""
    # One pass over the text cuts it: substrings by place would read a long text again for each block.
    pieces = F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    pieces = F.when(F.col("norm") == "", F.array(F.lit(""))).otherwise(pieces)
    cut = texts.select("row", pieces.alias("pieces")).select(
        "row", F.size("pieces").alias("left"), F.posexplode("pieces").alias("spot", "value"))
    open_, depth, done = _name(cut, ["value"], ["row", "left", "spot"], "block-names-0"), 0, None
    while True:
        ready = open_.filter("left = 1").select("row", F.lit(depth).alias("depth"), "name")
        done = ready if done is None else done.union(ready)
        rest = open_.filter("left > 1")
        if rest.isEmpty():
            return done
        depth += 1
        pairs = rest.groupBy("row", F.floor(F.col("spot") / 2).alias("spot")).agg(
            F.ceil(F.max("left") / 2).alias("left"),
            F.max(F.when(F.col("spot") % 2 == 0, F.col("name"))).alias("first"),
            F.coalesce(F.max(F.when(F.col("spot") % 2 == 1, F.col("name"))), F.lit(-1)).alias("second"))
        open_ = _name(pairs, ["first", "second"], ["row", "left", "spot"], f"block-names-{depth}")


def _grouped(docs: DataFrame, carried: list[str], block: int) -> DataFrame:
    """``row``, the carried columns, keep_id, group_size, kept and text_sha256 of each document."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    carry = F.struct(*[docs[f"`{c}`"] for c in carried]) if carried else F.lit(None).cast("string")
    narrow = docs.select(carry.alias("carry"), docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))
    long, head = F.octet_length("text").alias("long"), _lowered(F.substring("text", 1, block)).alias("head")
    # The first block is named before the others move: who is alone with it, at its length, has no copy.
    twins = stage(narrow.select(long, head).groupBy("long", "head").agg(F.count("*").alias("n"))
                  .filter("n > 1").select("long", "head", F.lit(True).alias("twin")), "block-names-twins")
    norm = narrow.select("carry", "doc_id", long, head, _lowered(F.col("text")).alias("norm"))
    rows = stage(norm.join(twins, ["long", "head"], "left").select(
        "carry", "doc_id", F.sha2("norm", 256).alias("text_sha256"), F.when(F.col("twin"), F.col("norm")).alias("norm"),
        F.monotonically_increasing_id().alias("row")), "block-names-rows")
    named = _identities(rows.filter("norm is not null").select("row", "norm"), block)
    members = stage(named.join(rows.select("row", "doc_id"), "row"), "block-names-members")
    # Written before it is joined, so that the rows of a hot group are split among tasks.
    groups = stage(members.groupBy("depth", "name").agg(
        F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row")).alias("stays")), "block-names-groups")
    told = members.join(groups, ["depth", "name"]).select(
        "row", F.col("stays.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("stays.row")).alias("kept"))
    shared = rows.filter("norm is not null").drop("norm").join(told, "row")
    alone = rows.filter("norm is null").drop("norm").withColumns(
        {"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    return shared.unionByName(alone)


def groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs``.

    Texts are equal when they are after lower-casing A-Z; a null text is an empty one. Of equal
    texts the row with the largest doc_id stays, a null id only among nulls; of rows that repeat
    id and text any one stays, the others are dropped by ``kept`` under the same keep_id. Long texts are
    cut in one pass and named in rounds, as many as the logarithm of the longest. An empty table
    gives none. Extra columns are not read.
    """
    return _grouped(docs, [], block).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def keep_one(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``docs``, all its columns, without the rows that ``groups`` drops."""
    return _grouped(docs, docs.columns, block).filter("kept").select("carry.*")
