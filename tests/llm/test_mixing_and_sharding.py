import re
import zlib

from tapewright.llm import mixing, sharding

WORD = re.compile("[^\x20\x09-\x0d]+")


def expected_targets(sizes):
    """Share by weight, freeze what is above its cap, reshare, until none is above."""
    names = sorted((n for n in sizes if n is not None)) + [None] * (None in sizes)
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, open_, left = {}, list(names), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[n] for n in open_)
        over = [n for n in open_ if left * weight[n] / total > 2 * sizes[n]]
        if not over:
            target.update({n: left * weight[n] / total for n in open_})
            break
        for n in over:
            target[n] = 2.0 * sizes[n]
        left -= sum(2.0 * sizes[n] for n in over)
        open_ = [n for n in open_ if n not in over]
    return target


def check(rows, docs):
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    target, taken = expected_targets(sizes), dict.fromkeys(sizes, 0)
    longest = max((r["size"] for r in rows), default=0)
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - target[r["source"]]) < 1e-6 * max(1, target[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 2 * longest
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())


def test_mix(frame, corpus, monkeypatch):
    docs = [(i, t, None if i % 11 == 0 else f"s{'0' if i % 3 else i % 7}") for i, t in enumerate(corpus)]
    docs += [(3, corpus[3], docs[3][2])] * 2 + [(None, "a b c", "s0")]
    rows = mixing.plan(frame(docs)).collect()
    assert len(rows) == len(docs)
    check(rows, docs)
    monkeypatch.setattr("tapewright.llm.tables.SLICE_ROWS", 8)
    again = mixing.plan(frame(docs).repartition(3)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    mixed = mixing.mix(frame(docs)).collect()
    count = {}
    for r in mixed:
        count[r["doc_id"], r["text"]] = count.get((r["doc_id"], r["text"]), 0) + 1
    assert sum(len(WORD.findall(t or "")) * n for (_, t), n in count.items()) == sum(r["taken"] for r in rows)


def test_mix_of_nothing_and_clashing_columns(spark, frame):
    assert mixing.plan(frame([])).count() == 0 and mixing.mix(frame([])).count() == 0
    assert [r["taken"] for r in mixing.plan(frame(["", None])).collect()] == [0, 0]
    docs = spark.createDataFrame([(1, "a b", "x", 9, "q"), (2, "c", "y", 8, "r")],
                                 "doc_id long, text string, source string, size int, target string")
    assert {r["size"] for r in mixing.plan(docs).collect()} == {2, 1}
    assert mixing.mix(docs).columns == docs.columns


def test_shards(frame, corpus, monkeypatch):
    monkeypatch.setattr("tapewright.llm.tables.SLICE_ROWS", 16)
    docs = [(i % 3000, corpus[i % 60], "s") for i in range(3005)] + [(None, None, None)] * 2
    rows = sharding.assign(frame(docs), sharding.topology(8), sharding.topology(9)).collect()
    assert len(rows) == len(docs)
    by_id = {}
    for r in rows:
        assert by_id.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
        assert r["grown_shard"] in (r["shard"], 8)
    digests = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in docs]
    assert sorted(map(repr, digests)) == sorted(repr((r["doc_id"], r["size"], r["text_crc32"])) for r in rows)
    for shard in range(8):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots))) and 250 < len(slots) < 500
    moved = sum(r["grown_shard"] != r["shard"] for r in rows)
    assert 0.07 < moved / len(rows) < 0.16
    assert sharding.assign(frame([]), sharding.topology(8)).count() == 0


def test_weights_move_rows_only_where_they_change(frame):
    docs = frame([f"t{i}" for i in range(4000)])
    tree = sharding.topology(8)
    heavier = [sharding.Shard(s.region, s.rack, s.shard, 3.0 if s.shard == 1 else 1.0) for s in tree]
    lighter = [sharding.Shard(s.region, s.rack, s.shard, 0.0 if s.shard == 1 else 1.0) for s in tree]
    rows = sharding.assign(docs, tree, heavier).collect()
    for r in rows:  # the other region loses rows but moves none inside itself
        if r["shard"] >= 4 and r["grown_shard"] >= 4:
            assert r["shard"] == r["grown_shard"]
        if r["shard"] < 4:
            assert r["grown_shard"] < 4
    assert 1 not in {r["grown_shard"] for r in sharding.assign(docs, tree, lighter).collect()}


def test_shards_are_written_whole(spark, frame, corpus, tmp_path):
    sharding.write(frame(corpus), sharding.topology(8), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(corpus)
