"""Documents linked by the Jaccard similarity of their shingles, by a token-group matrix (operator 3).

Every distinct shingle set (copies have one) posts its least tokens by hash. Sets that can have a
partner are first partitioned into groups around pivots, each link checked. The matrix then holds
which group has which posted token; a query's overlap with a group's token union bounds its overlap
with any member, and only groups whose bound reaches what a link needs are opened and checked.

Let n be a set's size and m = n/10. Linked sets share 4/5 of the larger; among the n/5 + 1 + m least of
both at least m + 1 are shared (prefix filtering). Tokens in very many groups are not counted but
added to the bound; sets that mostly post such tokens are compared among themselves by their
rarest tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm import textbytes as tb
from tapewright.llm.components import components
from tapewright.llm.tables import stage

SHINGLE = 5
# Tokens in more groups than this are bounded instead of counted. No result depends on it.
COMMON_GROUPS = 20
# Sets of one map batch that post a token before it goes around the token's own task.
COMMON_HERE = 64
# Members of a group, and queries, that are compared in one call.
PART = 256
# Tokens of sets in one block, and of blocks in one token range, that are counted in one call.
BLOCK_TOKENS = 65_536
# Documents whose postings one token range should hold.
RANGE_DOCS = 32768
_ROW_BITS, _TOKEN_BITS = 10, 54


def _spare(n):
    return n // 10 + 1


def _posted(n):
    return n - (4 * n + 4) // 5 + 1 + _spare(n)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past row, tokens, borders): sorted distinct tokens of each row, 54 bits each."""
    for first, past, data, offsets in tb.chunks(batch, "text"):
        for low in range(0, past - first, 1 << _ROW_BITS):
            high = min(low + (1 << _ROW_BITS), past - first)
            part = offsets[low:high + 1]
            keys = _keys(tb.LOWER[data[part[0]:part[-1]]], part - part[0], size)
            borders = np.searchsorted(keys >> np.uint64(_TOKEN_BITS), np.arange(high - low + 1))
            yield first + low, first + high, keys & np.uint64((1 << _TOKEN_BITS) - 1), borders


def _keys(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    words = tb.words(data, offsets)
    hashes = tb.Rolling(tb._BYTE_VALUE[data]).spans(words.begin, words.end)
    grams = tb.Rolling(hashes + (words.end - words.begin).astype(np.uint64))
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    at = np.arange(max(0, len(hashes) - size + 1))
    at = at[words.row[at] == words.row[at + size - 1]] if len(at) else at
    begin = np.concatenate([at, words.first[short]])
    end = np.concatenate([at + size, words.first[short] + counts[short]])
    tokens = tb.mixed(grams.spans(begin, end) + (end - begin).astype(np.uint64))
    keys = np.sort(words.row[begin].astype(np.uint64) << np.uint64(_TOKEN_BITS)
                   | tokens >> np.uint64(64 - _TOKEN_BITS))
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def _signature(tokens: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """One number for each set, equal for equal sets."""
    sums = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(tb.mixed(tokens + np.uint64(1)), out=sums[1:])
    return tb.mixed(sums[borders[1:]] - sums[borders[:-1]] + np.diff(borders).astype(np.uint64)).view(np.int64)


def _describe(size: int):
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for first, past, tokens, borders in _sets(batch, size):
                part = batch.slice(first, past - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(borders)),
                     pa.array(_signature(tokens, borders))], ["doc_id", "text_key", "n", "sig"])
    return batches


def _post(size: int, ranges: int):
    """Rows (range, entries, sigs): entries are token << 10 | row of the token range, sigs (sig, n) by row.

    A token that very many sets of this batch post goes to a range of negative number, where all
    is passed on; two of its entries still go to its own range, so others that post it are seen.
    """
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for first, _, tokens, borders in _sets(batch, size):
                n = np.diff(borders)
                sig = _signature(tokens, borders)
                _, once = np.unique(sig, return_index=True)
                once = once[n[once] > 0]
                if not len(once):
                    continue
                count = np.minimum(_posted(n[once]), n[once])
                begin = np.cumsum(count) - count
                picked = tokens[np.repeat(borders[once] - begin, count) + np.arange(count.sum())]
                entries = np.sort(picked << np.uint64(_ROW_BITS) | np.repeat(
                    np.arange(len(once)), count).astype(np.uint64))
                token = entries >> np.uint64(_ROW_BITS)
                run = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
                long = np.diff(np.append(run, len(token)))
                place = np.arange(len(token)) - np.repeat(run, long)
                common = np.repeat(long > COMMON_HERE, long)
                known = np.empty((len(once), 2), np.int64)
                known[:, 0], known[:, 1] = sig[once], n[once]
                out: list[tuple[int, bytes, bytes]] = []
                if common.any():
                    salt = -1 - int(sig[once[0]] % ranges)
                    out.append((salt, entries[common].tobytes(), known.tobytes()))
                kept = entries[~common | (place < 2)]
                number = ((kept >> np.uint64(_ROW_BITS)).astype(np.float64)
                          * (ranges / float(1 << _TOKEN_BITS))).astype(np.int64)
                for low, high in zip(cuts := np.flatnonzero(np.append(True, number[1:] != number[:-1])),
                                     np.append(cuts[1:], len(kept))):
                    mine = kept[low:high]
                    used, row = np.unique(mine & np.uint64((1 << _ROW_BITS) - 1), return_inverse=True)
                    mine = (mine >> np.uint64(_ROW_BITS) << np.uint64(_ROW_BITS)) | row.astype(np.uint64)
                    out.append((int(number[low]), mine.tobytes(), known[used.astype(np.int64)].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary()),
                     pa.array([o[2] for o in out], pa.binary())], ["range", "entries", "sigs"])
    return batches


def _shared(table: pa.Table) -> pa.Table:
    """(token, sig, n) of the tokens of one range that two sets or more post."""
    token, sig, n = [], [], []
    for entries, sigs in zip(table.column("entries").to_pylist(), table.column("sigs").to_pylist()):
        entries, known = np.frombuffer(entries, np.uint64), np.frombuffer(sigs, np.int64).reshape(-1, 2)
        row = (entries & np.uint64((1 << _ROW_BITS) - 1)).astype(np.int64)
        token.append(entries >> np.uint64(_ROW_BITS))
        sig.append(known[row, 0])
        n.append(known[row, 1])
    token, sig, n = np.concatenate(token), np.concatenate(sig), np.concatenate(n)
    if table.column("range")[0].as_py() >= 0:
        twice = tb.repeated(token)
        token, sig, n = token[twice], sig[twice], n[twice]
        order = np.lexsort((sig, token))
        token, sig, n = token[order], sig[order], n[order]
        new = np.append(True, (token[1:] != token[:-1]) | (sig[1:] != sig[:-1])) if len(token) else np.zeros(0, bool)
        token, sig, n = token[new], sig[new], n[new]
        several = tb.repeated(token)
        token, sig, n = token[several], sig[several], n[several]
    return pa.table({"token": token.astype(np.int64), "sig": sig, "n": n})


def _need(n: Column) -> Column:
    """Posted tokens that a set of this size shares with any partner: the spare of the smaller, plus one."""
    return F.floor(F.floor((4 * n + 4) / 5) / 10) + 2


def _fetch(size: int):
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for first, past, tokens, borders in _sets(batch, size):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, past - first),
                     pa.array([tokens[a:b].tobytes() for a, b in zip(borders[:-1], borders[1:])], pa.binary())],
                    ["sig", "tokens"])
    return batches


def _check(percent: int):
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            hit = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = np.sort(np.concatenate([a, b]))
                inter = int((both[1:] == both[:-1]).sum())
                hit.append(100 * inter >= percent * (len(a) + len(b) - inter))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(hit, pa.bool_()))
    return batches


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity."""
    left = sets.select(F.col("sig").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("sig").alias("b"), F.col("tokens").alias("tb"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
            .mapInArrow(_check(percent), "a long, b long"))


def link(docs: DataFrame, size: int = SHINGLE, percent: int = 80) -> DataFrame:
    """doc_id, text_key (hash of the text), n_shingles, component_id and root of every document.

    Words are lower-cased in A-Z; a text with fewer than ``size`` words is one shingle. Texts
    without words and null texts have no shingle and are linked with nothing: their component is
    their own id. Repeated rows are copies like any other. The component is the least id in it,
    null ids left aside: null where all are, and not unique where unlike documents share an id. The
    root (signature of a set) tells components apart whatever the ids are; texts without shingle
    have one root and are no component. An empty table gives none. Extra columns are not read.
    ``percent`` must be 80 or more, the similarity the postings are long enough for.
    """
    if percent < 80:
        raise ValueError("postings cover similarities of 80 percent and more")
    spark = docs.sparkSession
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                         F.xxhash64(docs["text"]).alias("text_key"), docs["text"].alias("text"))
    described = stage(narrow.mapInArrow(_describe(size), "doc_id long, text_key long, n long, sig long"),
                      "jaccard-sets")
    ranges = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), described.count() // RANGE_DOCS)
    shared = stage(
        narrow.select("text").mapInArrow(_post(size, ranges), "range long, entries binary, sigs binary")
        .groupBy("range").applyInArrow(_shared, "token long, sig long, n long"), "jaccard-shared")
    # Sets that share too few posted tokens with all others together have no partner.
    of_set = Window.partitionBy("sig")
    postings = stage(shared.withColumn("c", F.count("*").over(of_set))
                     .filter(F.col("c") >= _need(F.col("n"))).drop("c"), "jaccard-postings")
    reps = (described.join(postings.select("sig").distinct(), "sig", "left_semi").groupBy("sig")
            .agg(F.min(F.struct("doc_id", "text_key")).alias("rep")).select("sig", "rep.*"))
    # A repeated row meets its representative once for each copy; a set is taken once.
    sets = stage(
        narrow.alias("d").join(reps.alias("r"), F.col("d.doc_id").eqNullSafe(F.col("r.doc_id"))
                               & (F.col("d.text_key") == F.col("r.text_key")))
        .select("r.sig", "d.text").dropDuplicates(["sig"]).mapInArrow(_fetch(size), "sig long, tokens binary"), "jaccard-tokens")

    # Groups: every set against the pivot it shares most tokens with. A token's pivot is the set whose
    # own tokens are the most widespread for its size: the original rather than one of its edits.
    spread = postings.groupBy("token").agg(F.count("*").alias("f"))
    counted = postings.join(spread, "token")
    heavy = stage(counted.withColumn("w", F.sum("f").over(of_set) / F.col("n")).drop("f"), "jaccard-weights")
    pivots = heavy.groupBy("token").agg(F.max(F.struct("w", "sig")).alias("p")).select("token", F.col("p.sig").alias("pivot"))
    best = (heavy.join(pivots, "token").filter("sig <> pivot").groupBy("sig", "pivot")
            .agg(F.count("*").alias("c")).groupBy("sig").agg(F.max(F.struct("c", "pivot")).alias("best"))
            .select("sig", "best.*"))
    best = stage(best, "jaccard-pivots")
    close = stage(_verify(best.select(F.col("sig").alias("a"), F.col("pivot").alias("b")), sets, percent),
                  "jaccard-links")
    linked = components(close, "a", "b").select(F.col("node").alias("sig"), F.col("root").alias("part"))
    # A group is a pivot with the sets that share about half of their posted tokens with it, linked or not.
    members = (postings.select("sig", "n").distinct().join(best, "sig", "left").join(linked, "sig", "left")
               .select("sig", "n", F.coalesce("part", "sig").alias("part"),
                       F.when(20 * F.col("c") >= 3 * F.col("n"), F.col("pivot")).otherwise(F.col("sig")).alias("root")))
    sizes = members.groupBy("root").agg(
        F.count("*").alias("members"), F.min("n").alias("least_n"), F.max("n").alias("most_n"),
        F.max(F.when(F.col("sig") == F.col("root"), F.col("part"))).alias("main"))
    members = stage(members.join(sizes, "root"), "jaccard-groups")

    # The matrix: distinct (token, group), without tokens of one group.
    rows = postings.join(members.select("sig", "root", "members", "least_n", "most_n"), "sig")
    spread = rows.select("token", "root").distinct().groupBy("token").agg(F.count("*").alias("groups")).filter("groups > 1")
    rows = rows.join(spread, "token").withColumn("common", F.col("groups") > COMMON_GROUPS)
    uncounted = F.sum(F.col("common").cast("int")).over(of_set)
    rows = stage(rows.withColumn("must", _need(F.col("n")) - uncounted), "jaccard-matrix")
    by_count = _bounded(rows.filter("not common"))
    crowded = rows.filter("must <= 0").select("sig", "n", "root").distinct()
    # In its own group, what is not already one with the pivot is compared with all.
    apart = members.filter("members > 1 and not (part <=> main)").select("sig", "n", "root")
    few, hubs, at_hubs = _rarest(crowded, sets)
    opened = by_count.union(few).union(apart).union(at_hubs).distinct()
    far = _open(stage(opened, "jaccard-opened"), members.select(*hubs.columns).union(hubs), sets, percent)
    final = components(close.union(far), "a", "b").withColumnRenamed("node", "sig")
    rooted = described.join(final, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    rooted = stage(rooted.select("doc_id", "text_key", "n", "root"), "jaccard-rooted")
    least = rooted.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return rooted.join(least, "root", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), "root")


def _bounded(rows: DataFrame) -> DataFrame:
    """Queries and the groups their bound lets open: (sig, n, root).

    Of two groups the smaller sends its members as queries to the larger one. Groups without a
    member of fitting size are no candidates.
    """
    query = rows.select("token", "sig", "n", "must", F.col("members").alias("mine"), F.col("root").alias("own"))
    group = rows.select("token", "root", "members", "least_n", "most_n").distinct()
    return (query.join(group, "token")
            .filter("(members > mine or members = mine and root > own) "
                    "and 5 * most_n >= 4 * n and 4 * least_n <= 5 * n")
            .groupBy("sig", "root").agg(F.count("*").alias("overlap"), F.max("n").alias("n"), F.max("must").alias("must"))
            .filter(F.col("overlap") >= F.greatest("must", F.lit(1))).select("sig", "n", "root"))


def _held(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all sets of a block, and the row of each."""
    packed = table.column("tokens").to_pylist()
    return (np.frombuffer(b"".join(packed), np.int64),
            np.repeat(np.arange(len(packed)), np.array([len(p) // 8 for p in packed], np.int64)))


def _count(ranges: int):
    """Rows (range, block, counts) of one block; counts are (token, its sets here, least root, greatest root)."""
    def counts(table: pa.Table) -> pa.Table:
        token, row = _held(table)
        root = table.column("root").to_numpy()[row]
        order = np.lexsort((root, token))
        token, root = token[order], root[order]
        first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        past = np.append(first[1:], len(token))
        known = np.stack([token[first], past - first, root[first], root[past - 1]], axis=1)
        number = (known[:, 0].astype(np.float64) * (ranges / float(1 << _TOKEN_BITS))).astype(np.int64)
        cuts = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
        return pa.table({
            "range": number[cuts], "block": np.full(len(cuts), table.column("block")[0].as_py()),
            "counts": pa.array([part.tobytes() for part in np.split(known, cuts[1:])], pa.binary())})
    return counts


def _spread(table: pa.Table) -> pa.Table:
    """Rows (block, known): (token, its sets) of a block's tokens in this range that two groups or more have."""
    parts = [np.frombuffer(c, np.int64).reshape(-1, 4) for c in table.column("counts").to_pylist()]
    rows = np.concatenate(parts)
    token, at = np.unique(rows[:, 0], return_inverse=True)
    f, low, high = np.zeros(len(token), np.int64), rows[:, 2].max() + 0 * token, rows[:, 3].min() + 0 * token
    np.add.at(f, at, rows[:, 1])
    np.minimum.at(low, at, rows[:, 2])
    np.maximum.at(high, at, rows[:, 3])
    known = np.stack([rows[:, 0], f[at]], axis=1)
    shared = (low < high)[at]
    past = np.cumsum([len(p) for p in parts])
    out = [known[a:b][shared[a:b]].tobytes() for a, b in zip(np.append(0, past[:-1]), past)]
    return pa.table({"block": table.column("block"), "known": pa.array(out, pa.binary())})


def _prefix(sets: pa.Table, spread: pa.Table) -> pa.Table:
    """(token, sig, n, root, f): of a block's sets the shared tokens among their n/5 + 1 rarest.

    Tokens of one group come before the shared ones; those are ordered by how many sets have them.
    """
    known = np.frombuffer(b"".join(spread.column("known").to_pylist()), np.int64).reshape(-1, 2)
    known = known[np.argsort(known[:, 0])]
    token, row = _held(sets)
    shared = np.isin(token, known[:, 0])
    token, row = token[shared], row[shared]
    f = known[np.searchsorted(known[:, 0], token), 1]
    order = np.lexsort((token, f, row))
    token, row, f = token[order], row[order], f[order]
    n = sets.column("n").to_numpy()
    count = np.bincount(row, minlength=len(n))
    place = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    least = (place + (n - count)[row]) < (n - (4 * n + 4) // 5 + 1)[row]
    token, row, f = token[least], row[least], f[least]
    return pa.table({"token": token, "sig": sets.column("sig").to_numpy()[row], "n": n[row],
                     "root": sets.column("root").to_numpy()[row], "f": f})


def _compare(percent: int):
    """Links between the queries and the members of one part of a group: as many as tie together what all would."""
    def links(queries: pa.Table, members: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and members.num_rows:
            names = members.column("b").to_pylist()
            own = [np.frombuffer(t, np.int64) for t in members.column("held").to_pylist()]
            sizes = np.array([len(t) for t in own])
            flat = np.concatenate(own)
            tied = np.full(len(own), -1)
            order = np.argsort(flat, kind="stable")
            token, row = flat[order], np.repeat(np.arange(len(own)), sizes)[order]
            for k, (a, packed) in enumerate(zip(queries.column("a").to_pylist(), queries.column("asked").to_pylist())):
                tokens = np.frombuffer(packed, np.int64)
                low = np.searchsorted(token, tokens, "left")
                count = np.searchsorted(token, tokens, "right") - low
                at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
                inter = np.bincount(row[at], minlength=len(own))
                hit = np.flatnonzero(100 * inter >= percent * (len(tokens) + sizes - inter))
                if len(hit):
                    # One link to each member nobody is tied to yet, and to each set of tied members.
                    fresh, old = hit[tied[hit] < 0], hit[tied[hit] >= 0]
                    merged, at = np.unique(tied[old], return_index=True)
                    out += [(a, names[j]) for j in [*fresh, *old[at]]]
                    tied[np.isin(tied, merged) & (tied >= 0)] = k
                    tied[fresh] = k
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()),
                         "b": pa.array([y for _, y in out], pa.int64())})
    return links


def _open(opened: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Compare each query with all members of the groups it opens, in parts of bounded size.

    A group is cut into parts of about PART members, and the queries of a group into parts of
    about PART as well, so neither a large group nor one that all open meets in one task.
    """
    keys = ["root", "part", "salt"]
    asked = opened.groupBy("root").agg(F.count("*").alias("queries"))
    cuts = (members.select("root", "members").distinct().join(asked, "root")
            .select("root", F.ceil(F.col("members") / PART).alias("parts"), F.ceil(F.col("queries") / PART).alias("salts")))
    part = F.pmod(F.xxhash64("sig"), F.col("parts")).alias("part")
    salt = F.pmod(F.xxhash64("sig"), F.col("salts")).alias("salt")
    queries = (opened.join(cuts, "root").select("sig", "root", salt, F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        .join(sets, "sig").select(*[F.col(c).alias(f"q_{c}") for c in keys], F.col("sig").alias("a"),
                                  F.col("tokens").alias("asked")))
    inside = (members.select("sig", "root").join(cuts, "root").select("sig", "root", part, F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
        .join(sets, "sig").select(*[F.col(c).alias(f"m_{c}") for c in keys], F.col("sig").alias("b"),
                                  F.col("tokens").alias("held")))
    return queries.groupBy(*[f"q_{c}" for c in keys]).cogroup(
        inside.groupBy(*[f"m_{c}" for c in keys])).applyInArrow(_compare(percent), "a long, b long")


def _rarest(crowded: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For sets whose posted tokens are common: queries and groups (sig, n, root), groups of their own
    (sig, root, members), and queries to those.

    All their tokens are ordered by how many of these sets have them. Linked sets share one among
    the n/5 + 1 rarest of both, so a passage that many share is not looked at where a set has
    enough of its own. Sets are counted a block at a time, so a token that many have meets those of
    other blocks once a block, and only the prefixes become rows. A token of few sets names the
    groups to open. Sets that come down to common ones, a family of near misses, would meet pair by
    pair through them. They are grouped anew, each by the most common token of its prefix, its hub.
    Most of a family has one of few hubs, so the rows stay few: a query for each set and hub whose
    members have a token of its prefix in theirs.
    """
    held = stage(crowded.join(sets, "sig").select("sig", "n", "root", "tokens"), "jaccard-crowded")
    blocks = (held.agg(F.sum("n")).first()[0] or 0) // BLOCK_TOKENS + 1
    held = held.withColumn("block", F.pmod(F.xxhash64("sig"), F.lit(blocks)))
    spread = (held.groupBy("block").applyInArrow(_count(blocks), "range long, block long, counts binary")
              .groupBy("range").applyInArrow(_spread, "block long, known binary"))
    prefix = stage(held.groupBy("block").cogroup(spread.groupBy("block")).applyInArrow(
        _prefix, "token long, sig long, n long, root long, f long"), "jaccard-prefix")
    rare = prefix.filter(F.col("f") <= COMMON_GROUPS)
    group = rare.select("token", F.col("root").alias("other")).distinct()
    few = (rare.join(group, "token").filter("other < root")
           .select("sig", "n", F.col("other").alias("root")).distinct())
    common = prefix.filter(F.col("f") > COMMON_GROUPS)
    hub = common.groupBy("sig", "n").agg(F.max(F.struct("f", "token")).alias("hub")).select(
        "sig", "n", F.xxhash64("hub.token", F.lit("hub")).alias("root"))
    hub = stage(hub, "jaccard-hubs")
    sizes = hub.groupBy("root").agg(F.count("*").alias("members"), F.min("n").alias("least_n"), F.max("n").alias("most_n"))
    held = common.select("token", "sig").join(hub, "sig")
    theirs = held.select("token", F.col("root").alias("other")).distinct().join(
        sizes.select(F.col("root").alias("other"), "least_n", "most_n"), "other")
    asked = (held.join(theirs, "token").filter("other <= root and 5 * most_n >= 4 * n and 4 * least_n <= 5 * n")
             .select("sig", "n", F.col("other").alias("root")).distinct())
    return few, hub.join(sizes, "root").select("sig", "root", "members"), asked


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, the one of least id (least text hash among equal ids).

    Null ids come last. Components are told apart by their root, so documents that share an id, or
    have none, stay unless they are near copies. Rows equal in id and text are one document; any
    one of them stays.
    """
    rows = link(docs, size, percent).groupBy("root", "doc_id", "text_key").agg(
        F.count("*").alias("__rows"), F.max("n_shingles").alias("n"))
    first = rows.filter("n > 0").groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "__rows")).alias("first"))
    stay = first.select("first.doc_id", "first.text_key", "first.__rows").union(
        rows.filter("n = 0").select("doc_id", "text_key", "__rows"))
    keyed = docs.withColumn("__jaccard_key", F.coalesce(F.xxhash64(docs["text"]), F.lit(0)))
    joined = keyed.alias("l").join(
        stay.alias("r"), F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
        & (F.col("l.__jaccard_key") == F.col("r.text_key"))).select("l.*", "__rows")
    again = joined.filter("__rows > 1").dropDuplicates(["doc_id", "__jaccard_key"])
    return joined.filter("__rows = 1").unionByName(again).select(*docs.columns)
