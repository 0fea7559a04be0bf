"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.tables import stage

# Edges that one task should contract before a round. No result depends on it.
TASK_EDGES = 65_536


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges' spanning stars: each node that is not the least of those it is connected with, and the least."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, root = ends[:len(u)], ends[len(u):], np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root = up
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    rest = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[rest], nodes[root[rest]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as spanning stars, at most one edge a node; a large task's edges in pieces."""
    held: list[pa.RecordBatch] = []

    def stars() -> pa.RecordBatch:
        u, v = _forest(*(np.concatenate([x.column(c).to_numpy() for x in held]) for c in (0, 1)))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= 16 * TASK_EDGES:
            yield stars()
    if held:
        yield stars()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie each node's neighbours (the larger ones, or the smaller ones and itself) to the least of them."""
    pairs = edges
    if large:
        pairs = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = pairs.join(least, "u")
    if large:
        out = tied.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v")


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node of an edge; root is the least node of its component.

    Each round is two grouped minima joined back to the edges, written to the shared folder, so
    neither links nor components pass through the driver. Before it, each task replaces its own
    edges by spanning stars, which shortens paths without a shuffle. Neither step ever raises a node's least
    neighbour, and a round that changes none ends in stars. Rounds grow with the logarithm of the
    longest path. Edges may repeat and may be loops; null ends are no edges. No edges, no rows.
    """
    edges = stage(edges.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v"))
                  .filter("u <> v"), "edges")
    seen = None
    while True:
        # Unchanged when no edge came or went: count and an order-free checksum agree.
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if not mark[0] or mark == seen:
            break
        seen = mark
        tasks = math.ceil(mark[0] / TASK_EDGES)
        stars = edges.coalesce(tasks).mapInArrow(_contract, "u long, v long")
        if tasks == 1:  # so few edges that one task saw them all: its stars are the components
            edges = stage(stars, "edges")
            break
        edges = stage(_star(_star(stars, large=True), large=False).distinct(), "edges")
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return ends.union(ends.select("root", "root").distinct())
