"""Near-duplicate vectors by collision counting on sorted projections (operator 8)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.components import components
from tapewright.llm.tables import stage

COSINE = 0.98
PROJECTIONS = 24
RECALL = 0.9995
# Half window around a query on a counted projection, and on a projection that partitions, in
# standard deviations of the difference of two vectors that just reach the cosine.
WINDOW, LEAD_WINDOW = 1.25, 3.5
# Vectors a cell should hold; a label with more adds leading projections for itself. It decides cost.
CELL = 8192
MAX_LEADS = 8
# Vectors of a cell, and queries, that are compared in one call.
PART = 2048


def needed_collisions(count: int = PROJECTIONS, recall: float = RECALL) -> int:
    """The largest number of collisions that a pair at the cosine reaches with the wanted recall."""
    p = math.erf(WINDOW / math.sqrt(2))
    tail = 0.0
    for least in range(count, -1, -1):
        tail += math.comb(count, least) * p ** least * (1 - p) ** (count - least)
        if tail >= recall:
            return least
    return 0


def _directions(dims: int, count: int) -> np.ndarray:
    return np.random.default_rng(7_000_003 + dims).standard_normal((dims, count))


def _unit(vectors) -> np.ndarray:
    """Rows of one length as unit vectors."""
    chunks = vectors.chunks if isinstance(vectors, pa.ChunkedArray) else [vectors]
    x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chunks]).reshape(len(vectors), -1)
    # Scale by the largest component first, so tiny and huge vectors keep their length.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cells(step: float, half: float):
    """Each vector's home cell, and the cells its window touches on its label's leading projections."""
    def batches(rows):
        for batch in rows:
            dims, leads = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
            home, probes = [None] * len(dims), [None] * len(dims)
            for d, n in np.unique(np.stack([dims, leads]), axis=1).T:
                at = np.flatnonzero((dims == d) & (leads == n))
                p = _unit(batch.column(1).take(pa.array(at))) @ _directions(d, PROJECTIONS + MAX_LEADS)[:, PROJECTIONS:PROJECTIONS + n]
                mid, low, high = (np.floor(x / step).astype(int) for x in (p, p - half, p + half))
                for k, i in enumerate(at):
                    cells = [""]
                    for a, b in zip(low[k], high[k]):
                        cells = [f"{c}{v}," for c in cells for v in range(a, b + 1)]
                    home[i], probes[i] = "".join(f"{v}," for v in mid[k]), cells
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(home, pa.string()), pa.array(probes, pa.list_(pa.string()))],
                ["node", "home", "probes"])
    return batches


def _compare(least: float, half: float):
    sigma = math.sqrt(2 * (1 - least))
    needed = needed_collisions()

    def links(queries: pa.Table, homes: pa.Table) -> pa.Table:
        out = {"node": [], "links": [], "other": []}
        if queries.num_rows and homes.num_rows:
            a, b = _unit(queries.column("asked")), _unit(homes.column("held"))
            ids, own = homes.column("hid").to_numpy(), queries.column("qid").to_numpy()
            weight = homes.column("weight").to_numpy()
            leads = homes.column("leads")[0].as_py()
            every = _directions(a.shape[1], PROJECTIONS + MAX_LEADS)[:, :PROJECTIONS + leads]
            lines = every[:, :PROJECTIONS]
            pa_, pb = a @ lines, b @ lines
            count = np.zeros((len(a), len(b)), np.int8)
            for k in range(PROJECTIONS):  # collisions: the stretch of the sorted projection around each query
                order = np.argsort(pb[:, k])
                low = np.searchsorted(pb[order, k], pa_[:, k] - WINDOW * sigma, "left")
                high = np.searchsorted(pb[order, k], pa_[:, k] + WINDOW * sigma, "right")
                place = np.empty(len(b), np.int64)
                place[order] = np.arange(len(b))
                count += (place >= low[:, None]) & (place < high[:, None])
            q, h = np.nonzero(count >= needed)
            # A probed cell reaches further than the window. Only pairs within it count, so that both ends find each other.
            lead = every[:, PROJECTIONS:]
            near = (np.abs((a @ lead)[q] - (b @ lead)[h]) <= half).all(axis=1)
            q, h = q[near], h[near]
            close = np.einsum("ij,ij->i", a[q], b[h]) >= least
            q, h = q[close], h[close]
            other = ids[h] != own[q]
            q, h = q[other], h[other]
            group = np.full(len(b), -1)
            for i in np.unique(q):
                mine = h[q == i]
                out["node"].append(int(own[i]))
                out["links"].append(int(weight[mine].sum()))
                # One edge to each group of this part that the query is the first to touch or join.
                fresh = mine[group[mine] < 0]
                merged, first = np.unique(group[mine][group[mine] >= 0], return_index=True)
                ends = [*ids[fresh], *ids[mine[group[mine] >= 0][first]]]
                group[np.isin(group, merged) & (group >= 0)] = i
                group[fresh] = i
                out["other"].append([int(e) for e in ends])
        return pa.table({"node": pa.array(out["node"], pa.int64()), "links": pa.array(out["links"], pa.int64()),
                         "other": pa.array(out["other"], pa.list_(pa.int64()))})
    return links


def link(vectors: DataFrame, least: float = COSINE) -> DataFrame:
    """vec_id, n_links (other vectors linked directly) and component_id of every vector.

    Two vectors of one label and one length link when their cosine in double precision is
    ``least`` or more. Vectors that are null, empty, zero, or hold null or non-finite components,
    and those without a label, link with nothing. Equal vectors are one class, compared once.
    A class is compared with the others of its cell; a pair is checked when it collides on as many
    projections as pairs at the cosine do with probability RECALL, from either end, so about that share of the
    links is found and no false one. A component has its least id; null ids stand aside.
    Repeated rows are copies like any other. An empty table gives none. Extra columns are not read.
    """
    narrow = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].cast("string").alias("label"),
        vectors["embedding"].cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
                        & F.exists("embedding", lambda x: x != 0), F.lit(False))
    keyed = narrow.withColumn("usable", usable).withColumn(
        "node", F.when(F.col("usable"), F.xxhash64("label", "embedding")))
    classes = stage(keyed.filter("usable").groupBy("node").agg(
        F.count("*").alias("weight"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
        .withColumn("dims", F.size("embedding").cast("long")), "vector-classes")
    half = LEAD_WINDOW * math.sqrt(2 * (1 - least))
    sizes = classes.groupBy("label", "dims").agg(F.greatest(F.lit(0), F.least(
        F.lit(MAX_LEADS), F.ceil(F.log2(F.count("*") / CELL)))).cast("long").alias("leads"))
    led = classes.join(sizes, ["label", "dims"])
    placed = stage(led.join(led.select("node", "embedding", "dims", "leads").mapInArrow(
        _cells(2 * half, half), "node long, home string, probes array<string>"), "node"), "vector-cells")

    asked = placed.select("node", "label", "dims", "embedding", F.explode("probes").alias("cell"))
    held = placed.withColumnRenamed("home", "cell")
    cell = ["label", "dims", "cell"]
    cuts = (held.groupBy(*cell).agg(F.ceil(F.count("*") / PART).alias("parts")).join(
        asked.groupBy(*cell).agg(F.ceil(F.count("*") / PART).alias("salts")), cell))

    def to(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    hashed = F.xxhash64("node", F.lit("part"))
    keys = [*cell, "part", "salt"]
    queries = (asked.join(cuts, cell).withColumn("salt", F.pmod(hashed, "salts")).withColumn("part", to("parts"))
               .select(*[F.col(c).alias(f"q_{c}") for c in keys], F.col("node").alias("qid"), F.col("embedding").alias("asked")))
    homes = (held.join(cuts, cell).withColumn("part", F.pmod(hashed, "parts")).withColumn("salt", to("salts"))
             .select(*[F.col(c).alias(f"h_{c}") for c in keys], F.col("node").alias("hid"), "weight", "leads", F.col("embedding").alias("held")))
    found = stage(queries.groupBy(*[f"q_{c}" for c in keys]).cogroup(homes.groupBy(*[f"h_{c}" for c in keys])).applyInArrow(
        _compare(least, half), "node long, links long, other array<long>"), "vector-links")
    roots = components(found.select("node", F.explode("other").alias("other")), "node", "other")
    totals = found.groupBy("node").agg(F.sum("links").alias("links"))
    info = classes.select("node", "weight").join(totals, "node", "left").join(roots, "node", "left").select(
        "node", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"))
    rooted = stage(keyed.select("vec_id", "node").join(info, "node", "left"), "vector-roots")
    smallest = rooted.filter("root is not null").groupBy("root").agg(F.min("vec_id").alias("least"))
    return rooted.join(smallest, "root", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id"))
