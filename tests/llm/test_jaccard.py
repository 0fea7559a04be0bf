import random
import re

import pytest

from tapewright.llm import jaccard, line_dedup

WORD = re.compile("[^\x20\x09-\x0d]+")


def prose(rng, n, vocabulary):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * (inter := len(a & b)) >= 80 * (len(a) + len(b) - inter):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def test_matches_brute_force(frame, corpus):
    rows = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(frame(corpus)).collect()}
    assert rows == brute(corpus)


def test_common_tokens_lose_no_link(frame, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON_GROUPS", 1)
    rows = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(frame(corpus)).collect()}
    assert rows == brute(corpus)


def test_keep_one(spark, frame, corpus):
    kept = jaccard.keep_one(frame(corpus))
    expected = {i for i, (n, c) in brute(corpus).items() if c == i}
    assert {r["doc_id"] for r in kept.collect()} == expected
    text = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(None, text, 1), (5, text, 2), (5, text, 3), (None, None, 4), (7, "", 5)],
                                 "doc_id long, text string, n int")
    assert {r["n"] for r in jaccard.keep_one(docs).collect()} & {4, 5} == {4, 5}
    assert jaccard.keep_one(docs).count() == 3
    assert jaccard.link(docs.filter("n > 9")).count() == 0


def test_keep_one_tells_components_apart_by_more_than_ids(spark):
    def text(seed):
        return " ".join(f"{seed}{i}" for i in range(60))
    rows = [(None, text("a"), 1), (None, text("b"), 2), (5, text("c"), 3), (5, text("d"), 4),
            (None, text("e") + " x", 5), (9, text("e"), 6), (8, text("e") + " y", 7), (5, text("c") + " z", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    kept = {r["n"] for r in jaccard.keep_one(docs).collect()}
    assert kept - {3, 8} == {1, 2, 4, 7} and len(kept & {3, 8}) == 1
    linked = jaccard.link(docs).collect()
    assert len({r["root"] for r in linked}) == 5 and {r["component_id"] for r in linked} == {None, 5, 8}


def test_repeated_rows_are_one_set(spark, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON_GROUPS", 1)
    rarest, seen = jaccard._rarest, []

    def watched(crowded, sets):
        seen.append((crowded.count(), sets.count(), sets.select("sig").distinct().count()))
        return rarest(crowded, sets)
    monkeypatch.setattr(jaccard, "_rarest", watched)
    texts = [(i, t) for i, t in enumerate(corpus) if len(t or "") < 5000]
    docs = spark.createDataFrame(texts + texts[::2] * 5 + [texts[0]] * 40, "doc_id long, text string").repartition(5)
    rows = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(docs).collect()}
    place = {k: i for k, (i, _) in enumerate(texts)}
    assert rows == {place[k]: (n, place[c]) for k, (n, c) in brute([t for _, t in texts]).items()}
    assert seen[0][0] > 0 and seen[0][1] == seen[0][2]


@pytest.mark.parametrize("seed, line", [(1, 10), (3, 25)])
def test_families_of_near_misses_open_few_groups(spark, monkeypatch, seed, line):
    """Texts that lost their shared runs but still have most of their shingles in common, without a link."""
    rng = random.Random(seed)
    rows, stage = {}, jaccard.stage

    def counted(frame, label):
        out = stage(frame, label)
        rows[label] = out.count()
        return out
    monkeypatch.setattr(jaccard, "stage", counted)
    opened = {}
    for n in (500, 2000):
        base, docs = prose(rng, 200, 5000), []
        for i in range(n):
            words = list(base)
            for k in rng.sample(range(200), 6):
                words[k] = f"e{rng.randrange(10 ** 7)}"
            docs.append((i, "\n".join(" ".join(words[k:k + line]) for k in range(0, 200, line))))
        cleaned = stage(line_dedup.clean(spark.createDataFrame(docs, "doc_id long, text string").repartition(8)), "cleaned")
        found = jaccard.link(cleaned).collect()
        opened[n] = rows["jaccard-opened"]
        if n == 500:
            texts = [r["text"] for r in cleaned.orderBy("doc_id").collect()]
            assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(texts)
    # About five a text at any size (1,000 to 8,000 measured); the square of a family would be far beyond.
    assert all(pairs < 8 * n for n, pairs in opened.items())


def test_crowded_sets_are_counted_in_blocks_of_any_size(spark, frame, corpus, monkeypatch):
    """Sets that share a passage stay one row each until their rarest tokens are known."""
    rng, stage, rows = random.Random(5), jaccard.stage, {}

    def counted(frame, label):
        out = stage(frame, label)
        rows[label] = out.count()
        return out
    monkeypatch.setattr(jaccard, "stage", counted)
    monkeypatch.setattr(jaccard, "COMMON_GROUPS", 2)
    passage = prose(rng, 80, 4000)
    texts = [t for t in corpus if len(t or "") < 5000]
    texts += [" ".join(passage + prose(rng, 120 + k % 7, 10 ** 6)) for k in range(120)]
    expected = brute(texts)
    for tokens in (None, 1024):
        if tokens:
            monkeypatch.setattr(jaccard, "BLOCK_TOKENS", tokens)
        found = jaccard.link(frame(texts)).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
        assert 100 < rows["jaccard-crowded"] <= len(texts)


def test_no_crowded_sets(spark):
    schema = "sig long, n long, root long"
    few, hubs, asked = jaccard._rarest(spark.createDataFrame([], schema), spark.createDataFrame([], "sig long, tokens binary"))
    assert few.count() == hubs.count() == asked.count() == 0
    lone = spark.createDataFrame([(1, 2, 1)], schema)
    held = spark.createDataFrame([(1, bytes(range(16)))], "sig long, tokens binary")
    assert all(f.count() == 0 for f in jaccard._rarest(lone, held))
