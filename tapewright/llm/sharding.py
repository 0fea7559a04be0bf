"""Shards by a hierarchical weighted hash tree (operator 9, DataFrame functions only)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.tables import running_total, stable_hash, stage

SHARDS = 8


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def topology(shards: int, first: int = SHARDS) -> list[Shard]:
    """The first ``first`` shards in racks of two and regions of four; each later one in a region of its own.

    A region that is added draws rows to itself at the top level and has one shard, so one more
    shard takes rows only into itself and moves none between the others.
    """
    built = [Shard(s // 4, s % 4 // 2, s) for s in range(min(shards, first))]
    return built + [Shard(first + s, 0, s) for s in range(first, shards)]


def _drawn(key: Column, label: str, children: list[tuple[int, float]]) -> Column:
    """The child with the least of -ln(u) / weight, u hashed from the row, the parent and the child."""
    def score(child: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(f"{label}/{child}")), 11)
        uniform = (bits.cast("double") + 0.5) / F.lit(float(1 << 53))
        return F.struct((-F.log(uniform) / weight).alias("wait"), F.lit(child).alias("child"))

    live = [(c, w) for c, w in children if w > 0]
    if len(live) == 1:
        return F.lit(live[0][0])
    return F.array_min(F.array(*(score(c, w) for c, w in live)))["child"]


def descend(key: Column, tree: list[Shard]) -> Column:
    """The shard a key falls to: region, rack and shard are drawn in turn.

    A draw depends on the node's own path and its children's weights alone, so a change of weights
    moves rows only at the levels above the change and inside the subtree that holds it.
    """
    def weight(part: list[Shard]) -> float:
        return sum(s.weight for s in part)

    def pick(chosen: Column, branches: dict[int, Column]) -> Column:
        if len(branches) == 1:
            return next(iter(branches.values()))
        case = None
        for node, inner in branches.items():
            case = F.when(chosen == node, inner) if case is None else case.when(chosen == node, inner)
        return case

    regions: dict[int, list[Shard]] = {}
    for shard in tree:
        regions.setdefault(shard.region, []).append(shard)
    regions = {r: part for r, part in regions.items() if weight(part) > 0}
    inside = {}
    for region, part in regions.items():
        racks: dict[int, list[Shard]] = {}
        for shard in part:
            racks.setdefault(shard.rack, []).append(shard)
        racks = {k: v for k, v in racks.items() if weight(v) > 0}
        leaves = {rack: _drawn(key, f"{region}/{rack}", [(s.shard, s.weight) for s in members])
                  for rack, members in racks.items()}
        inside[region] = pick(_drawn(key, f"{region}", [(k, weight(v)) for k, v in racks.items()]), leaves)
    return pick(_drawn(key, "", [(r, weight(part)) for r, part in regions.items()]), inside).cast("int")


def assign(docs: DataFrame, tree: list[Shard], grown: list[Shard] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (gapless from 0 in each shard) and grown_shard.

    The id alone decides the shard; a null id counts as one more id. A null text has size 1 and
    the checksum of an empty text. Repeated rows get a slot each. An empty table gives none.
    ``grown_shard`` is the shard under ``grown``, null without it. Extra columns are not read.
    Slots follow a hash of the id, the id, checksum and size; equal rows are interchangeable.
    """
    key = F.coalesce(docs["doc_id"].cast("string"), F.lit("null"))
    text = F.coalesce(docs["text"], F.lit(""))
    narrow = stage(docs.select(
        docs["doc_id"].alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), descend(key, tree).alias("shard"),
        (descend(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        stable_hash(docs["doc_id"]).alias("place"), F.lit(1).cast("long").alias("one")), "shards")
    ranked = running_total(narrow, ["shard"], "place",
                           [F.col("doc_id"), F.col("text_crc32"), F.col("size")], "one", narrow.count())
    return ranked.select("doc_id", "size", "text_crc32", "shard",
                         (F.col("total") - 1).alias("slot"), "grown_shard")


def write(docs: DataFrame, tree: list[Shard], path: str) -> None:
    """Write the rows of ``docs`` as Parquet with a folder for each shard."""
    key = F.coalesce(docs["doc_id"].cast("string"), F.lit("null"))
    (docs.withColumn("__shard", descend(key, tree)).hint("rebalance", F.col("__shard"))
     .write.partitionBy("__shard").parquet(path))
