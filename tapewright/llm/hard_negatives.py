"""Hard negatives from blocks in Hilbert order with zone maps (operator 11).

Candidates are sorted by label and Hilbert curve and written as Parquet blocks of one label, each with
the least and greatest value of every dimension. For an anchor, interval arithmetic over a block's zone
map bounds every score in it from both sides. A block is read for the positives when its upper bound
reaches the anchor's fifth score so far, for the negatives when its bounds meet the window of a positive and
the upper one reaches the fifth score found there so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm.tables import stage

SCALE, ANCHOR_STEP, RELABEL_STEP, LABELS = 256, 100, 7, 10
POSITIVES, NEGATIVES = 5, 5
# A negative's score lies between this many percent of the positive's score and all of it.
LOW_PERCENT = 80
# Rows of a block, and anchors that meet one in a call; zone maps that anchors meet in a call.
BLOCK, PART, ZONES = 1 << 10, 1024, 1024
# Blocks of an anchor that are read first, those of the highest bound, to learn what the others must reach.
PROBES = 4
# The Hilbert key: bits a coordinate, and coordinates.
_BITS, _AXES = 4, 15
_NONE = np.iinfo(np.int64).min


def _curve(x: np.ndarray) -> np.ndarray:
    """Place on the Hilbert curve of each row of coordinates of _BITS bits."""
    x, (rows, axes) = x.copy(), x.shape
    # Coordinates to the curve's transposed index: undo the turns bit by bit, then Gray-code.
    for bit in range(_BITS - 1, 0, -1):
        low = (1 << bit) - 1
        for k in range(axes):
            upper = (x[:, k] >> bit) & 1 == 1
            swap = np.where(upper, 0, (x[:, 0] ^ x[:, k]) & low)
            x[:, 0] ^= np.where(upper, low, swap)
            x[:, k] ^= swap
    for k in range(1, axes):
        x[:, k] ^= x[:, k - 1]
    turn = np.zeros(rows, np.int64)
    for bit in range(_BITS - 1, 0, -1):
        turn ^= np.where((x[:, axes - 1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(rows, np.int64)
    for bit in range(_BITS - 1, -1, -1):
        for k in range(axes):
            key = key << 1 | (x[:, k] >> bit) & 1
    return key


def _hilbert(vectors: np.ndarray) -> np.ndarray:
    """Place of each vector on the curve, over evenly spread coordinates scaled by the vector's length."""
    rows, dims = vectors.shape
    if not rows or not dims:
        return np.zeros(rows, np.int64)
    x = vectors[:, np.linspace(0, dims - 1, min(dims, _AXES)).astype(int)].astype(np.float64)
    length = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1, keepdims=True) / dims)
    top = 1 << _BITS
    return _curve(np.clip(np.floor((x / np.where(length == 0, 1, length) + 2) * (top / 4)), 0, top - 1).astype(np.int64))


def _matrix(packed: list[bytes], dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.int64).reshape(-1, dims) if dims else np.zeros((len(packed), 0), np.int64)


def _lists(column: pa.Array) -> np.ndarray:
    """A column of equally long lists of int64 as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _keyed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, label, dims, key and the vector's bytes; a batch may hold several lengths."""
    for batch in rows:
        dims = batch.column(3).to_numpy()
        for d in np.unique(dims):
            part = batch.filter(pa.array(dims == d))
            q = _lists(part.column(2)) if d else np.zeros((part.num_rows, 0), np.int64)
            packed = [v.tobytes() for v in q]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(3), pa.array(_hilbert(q)), pa.array(packed, pa.binary())],
                ["vec_id", "label", "dims", "key", "q"])


def _packed(block_rows: int):
    """Sorted rows to blocks (block, label, dims, ids, rows, low, high); a row that repeats the one before is left out."""
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "label", "dims", "ids", "rows", "low", "high"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        base, number = TaskContext.get().partitionId() << 24, 0
        held: list[tuple[int, bytes]] = []
        of = last = None

        def out() -> pa.RecordBatch:
            nonlocal number
            q = _matrix([v for _, v in held], of[1])
            row = [base + number, *of, np.array([i for i, _ in held], np.int64).tobytes(), q.tobytes(),
                   q.min(axis=0).tobytes(), q.max(axis=0).tobytes()]
            number += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)
        for batch in rows:
            for vec_id, label, dims, q in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4))):
                if (vec_id, label, dims, q) == last:
                    continue
                last = (vec_id, label, dims, q)
                if held and (of != (label, dims) or len(held) == block_rows):
                    yield out()
                of = (label, dims)
                held.append((vec_id, q))
        if held:
            yield out()
    return batches


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, exact: by floating point while every sum is below 2**53, else by integers."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of the score of each anchor with any row of each block."""
    up, down = np.maximum(a, 0).astype(np.float64), np.minimum(a, 0).astype(np.float64)
    low, high = low.astype(np.float64), high.astype(np.float64)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    # Beyond 2**53 sums round; the bounds give way by more than that, and stay within a long.
    reach = np.abs(a.astype(np.float64)) @ np.maximum(np.abs(low), np.abs(high)).T
    slack = np.where(reach < 2 ** 53, 0, reach * 1e-9)
    edge = 2.0 ** 62
    return (np.clip(np.floor(least - slack), -edge, edge).astype(np.int64),
            np.clip(np.ceil(most + slack), -edge, edge).astype(np.int64))


def _best(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Columns of each row by falling score, ties by id and then by place."""
    by_id = np.argsort(ids, kind="stable")
    return by_id[np.argsort(-scores[:, by_id], axis=1, kind="stable")]


def _anchors(block_rows: int, step: int, wanted: int):
    """(anchor_no, anchor_id, label, dims, q, floor): anchors and the fifth positive score inside their own block."""
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for block, label, dims, ids, packed in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(ids, np.int64)
                at = np.flatnonzero(ids % step == 0)
                if not len(at):
                    continue
                q = _matrix([packed], dims) if dims else np.zeros((len(ids), 0), np.int64)
                scores = _products(q[at], q)
                scores[np.arange(len(at)), at] = _NONE
                floor = np.sort(scores, axis=1)[:, -wanted] if len(ids) > wanted else np.full(len(at), _NONE)
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block * block_rows + at), pa.array(ids[at]), pa.array([label] * n, pa.int64()),
                     pa.array([dims] * n, pa.int64()), pa.array([v.tobytes() for v in q[at]], pa.binary()), pa.array(floor)],
                    ["anchor_no", "anchor_id", "label", "dims", "q", "floor"])
    return batches


def _choose(same: bool):
    """(anchor_no, block, least, most): blocks whose bounds let an anchor find what it looks for."""
    def chosen(anchors: pa.Table, zones: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        if anchors.num_rows and zones.num_rows:
            dims = anchors.column("dims")[0].as_py()
            a = _matrix(anchors.column("q").to_pylist(), dims)
            least, most = _bounds(a, *(_matrix(zones.column(c).to_pylist(), dims) for c in ("low", "high")))
            number, block = anchors.column("anchor_no").to_numpy(), zones.column("block").to_numpy()
            if same:
                good = most >= anchors.column("floor").to_numpy()[:, None]
            else:
                good = anchors.column("label").to_numpy()[:, None] != zones.column("zone_label").to_numpy()[None, :]
                near = np.zeros_like(good)
                windows = _windows(anchors.column("scores").to_pylist())
                for w in windows.T:
                    near |= (w[:, None] >= 0) & (most >= _lowest(w)[:, None]) & (least <= w[:, None])
                good &= near
            i, j = np.nonzero(good)
            for held, values in zip(out, (number[i], block[j], least[i, j], most[i, j])):
                held.append(values)
        return pa.table({c: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64())
                         for c, v in zip(("anchor_no", "block", "least", "most"), out)})
    return chosen


def _windows(scores: list[list[int]]) -> np.ndarray:
    """The distinct positive scores of each anchor, filled up with -1, whose window is empty."""
    width = max(map(len, scores), default=0)
    return np.array([list(s) + [-1] * (width - len(s)) for s in scores], np.int64).reshape(len(scores), width)


def _lowest(score: np.ndarray) -> np.ndarray:
    """The least negative score in the window of a positive score of 0 or more: LOW_PERCENT of it, rounded up."""
    return score - score // 100 * (100 - LOW_PERCENT) - score % 100 * (100 - LOW_PERCENT) // 100


def _opened(keys: list[str], block_rows: int, find):
    """Scores of a block's rows with the anchors that opened it, in the hands of ``find``."""
    def found(anchors: pa.Table, blocks: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int, int]] = []
        if anchors.num_rows and blocks.num_rows:
            dims = blocks.column("b_dims")[0].as_py()
            ids = np.frombuffer(blocks.column("ids")[0].as_py(), np.int64)
            rows = _matrix(blocks.column("rows").to_pylist(), dims) if dims else np.zeros((len(ids), 0), np.int64)
            first = blocks.column("b_block")[0].as_py() * block_rows
            scores = _products(_matrix(anchors.column("q").to_pylist(), dims), rows)
            out = find(anchors, ids, first, scores)
        columns = list(zip(*out)) if out else [()] * 5
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(keys, columns)})
    return found


def _find_positives(wanted: int):
    def find(anchors, ids, first, scores):
        floor, number = anchors.column("floor").to_numpy(), anchors.column("anchor_no").to_numpy()
        best = _best(scores, ids)[:, :wanted + 1]
        out = []
        for k, row in enumerate(best):
            mine = [c for c in row if first + c != number[k] and scores[k, c] >= floor[k]][:wanted]
            out += [(int(number[k]), int(ids[c]), int(first + c), int(scores[k, c]), 0) for c in mine]
        return out
    return find


def _find_negatives(wanted: int):
    def find(anchors, ids, first, scores):
        number = anchors.column("anchor_no").to_numpy()
        windows, floors = _windows(anchors.column("scores").to_pylist()), anchors.column("floors").to_pylist()
        best = _best(scores, ids)
        falling = -np.take_along_axis(scores, best, axis=1)
        out = []
        for k in range(len(number)):
            for at, top in enumerate(windows[k]):
                if top < 0:
                    continue
                low = max(int(_lowest(top)), floors[k][at])
                begin = np.searchsorted(falling[k], -top, "left")
                for c in best[k, begin:begin + wanted]:
                    if scores[k, c] < low:
                        break
                    out.append((int(number[k]), int(ids[c]), int(first + c), int(scores[k, c]), int(top)))
        return out
    return find


_FOUND = ["anchor_no", "other_id", "other_no", "score", "top"]


def _compared(pairs: DataFrame, anchors: DataFrame, blocks: DataFrame, extra: list[str], find) -> DataFrame:
    """What ``find`` finds in each opened (anchor_no, block); the anchors of a block meet it in parts."""
    parts = pairs.groupBy("block").agg(F.ceil(F.count("*") / PART).alias("parts"))
    asked = (pairs.select("anchor_no", "block").join(parts, "block")
             .withColumn("part", F.pmod(F.xxhash64("anchor_no"), "parts"))
             .join(anchors.select("anchor_no", "q", *extra), "anchor_no"))
    held = blocks.select("block", "dims", "ids", "rows").join(parts, "block").select(
        F.col("block").alias("b_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("b_part"),
        F.col("dims").alias("b_dims"), "ids", "rows")
    return asked.groupBy("block", "part").cogroup(held.groupBy("b_block", "b_part")).applyInArrow(
        _opened(_FOUND, BLOCK, find), ", ".join(f"{c} long" for c in _FOUND))


def _first(found: DataFrame, by: list[str], wanted: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "other_id", "other_no")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)


def _pairs(anchors: DataFrame, blocks: DataFrame, by: list[str], columns: list[str], same: bool) -> DataFrame:
    """Blocks each anchor must look at; parts of the anchors meet parts of the zone maps, by ``by``."""
    zones = blocks.select("block", "label", "dims", "low", "high")
    parts = (anchors.groupBy(*by).agg(F.ceil(F.count("*") / PART).alias("a_parts")).join(
        zones.groupBy(*by).agg(F.ceil(F.count("*") / ZONES).alias("z_parts")), by))

    def every(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    asked = anchors.select("anchor_no", "label", "dims", "q", *columns).join(parts, by).withColumn(
        "a_part", F.pmod(F.xxhash64("anchor_no"), "a_parts")).withColumn("z_part", every("z_parts"))
    held = zones.join(parts, by).withColumn("z_part", F.pmod(F.xxhash64("block"), "z_parts")).withColumn(
        "a_part", every("a_parts"))
    keys = [*by, "a_part", "z_part"]
    held = held.select(*[F.col(k).alias(f"z_{k}") for k in keys], F.col("label").alias("zone_label"), "block", "low", "high")
    return asked.groupBy(*keys).cogroup(held.groupBy(*[f"z_{k}" for k in keys])).applyInArrow(
        _choose(same), "anchor_no long, block long, least long, most long")


def candidate_blocks(vectors: DataFrame) -> DataFrame:
    """The block table: block, label, dims, ids, rows (vectors as bytes), low and high, one row a block, as Parquet."""
    scaled = F.transform(F.col("embedding"), lambda x: F.floor(x * SCALE))
    narrow = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].cast("long").alias("label"),
        vectors["embedding"].cast("array<double>").alias("embedding"))
    # Squares that sum to less than 2**62 keep every score within a long.
    weight = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + (x * SCALE) * (x * SCALE))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
              & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)) & (weight < 2.0 ** 62))
    moved = F.when(F.col("vec_id") % RELABEL_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = narrow.filter(usable).select(
        "vec_id", moved.alias("label"), scaled.alias("q"), F.size("embedding").cast("long").alias("dims"))
    keyed = rows.mapInArrow(_keyed, "vec_id long, label long, dims long, key long, q binary")
    order = ["dims", "label", "key", "vec_id", "q"]
    return stage(keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _packed(BLOCK), "block long, label long, dims long, ids binary, rows binary, low binary, high binary"), "negative-blocks")


def mine(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of each anchor's hard negatives.

    Anchors are the rows whose vec_id is divisible by 100. Rows with a null id, label or vector, or with a null
    or non-finite component, take no part, nor do those whose scores could leave a long. Where 7 divides
    the id the label moves on by one. Scores are inner products of floor(256 x); only vectors of one
    length are compared (two empty ones score 0). Ties go to the smaller id. A positive without a
    negative in its window, and an anchor without positives, give no row. Rows equal in id, label and vector
    are one row; unlike rows under one id each take part. An empty table gives none. Extra columns are not read.
    """
    blocks = candidate_blocks(vectors)
    anchors = stage(blocks.select("block", "label", "dims", "ids", "rows").mapInArrow(
        _anchors(BLOCK, ANCHOR_STEP, positives),
        "anchor_no long, anchor_id long, label long, dims long, q binary, floor long"), "negative-anchors")
    pairs = stage(_pairs(anchors, blocks, ["dims", "label"], ["floor"], same=True), "negative-positive-pairs")
    close = stage(_first(_compared(pairs, anchors, blocks, ["floor"], _find_positives(positives)),
                         ["anchor_no"], positives), "negative-positives")

    # Each distinct positive score opens a window; positives of one score share it.
    windows = close.filter("score >= 0").groupBy("anchor_no").agg(F.sort_array(F.collect_set("score")).alias("scores"))
    asking = stage(anchors.join(windows, "anchor_no"), "negative-windows")
    pairs = stage(_pairs(asking, blocks, ["dims"], ["scores"], same=False).withColumn("place", F.row_number().over(
        Window.partitionBy("anchor_no").orderBy(F.desc("most"), "block"))), "negative-pairs")
    nothing = F.transform("scores", lambda s: F.lit(int(_NONE)))
    first = stage(_first(_compared(pairs.filter(F.col("place") <= PROBES), asking.withColumn("floors", nothing), blocks,
                                   ["scores", "floors"], _find_negatives(negatives)), ["anchor_no", "top"], negatives), "negative-probes")
    # A window that is full already asks for its last score at least.
    known = first.filter(F.col("rank") == negatives).groupBy("anchor_no").agg(
        F.map_from_entries(F.collect_list(F.struct("top", "score"))).alias("full"))
    sharp = stage(asking.join(known, "anchor_no", "left").withColumn("floors", F.transform(
        "scores", lambda s: F.coalesce(F.try_element_at("full", s), F.lit(int(_NONE))))).drop("full"), "negative-floors")
    meets = F.exists(F.arrays_zip("scores", "floors"), lambda w: (F.col("most") >= w["floors"]) & (
        F.col("least") <= w["scores"]) & (F.col("most") + F.abs("most") * 1e-9 + 1 >= w["scores"] * (LOW_PERCENT / 100)))
    rest = pairs.filter(F.col("place") > PROBES).join(sharp.select("anchor_no", "scores", "floors"), "anchor_no").filter(meets)
    more = _compared(rest, sharp, blocks, ["scores", "floors"], _find_negatives(negatives))
    found = _first(first.select(*_FOUND).union(more), ["anchor_no", "top"], negatives)
    return (close.select("anchor_no", F.col("other_id").alias("positive_id"), F.col("score").alias("top"))
            .join(found, ["anchor_no", "top"]).join(anchors.select("anchor_no", "anchor_id"), "anchor_no")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
                    F.col("top").alias("positive_score"), F.col("score").alias("negative_score")))
