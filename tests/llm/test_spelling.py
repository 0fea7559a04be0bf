"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tapewright.llm import spelling


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def expected(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[a-zà-ÿÀ-ß÷×]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    n = {w: c for w, c in n.items() if c > 1}
    form, count = {}, {}
    for w in n:
        others = [o for o in n if near(w, o)]
        count[w] = len(others)
        best = min(others, key=lambda o: (-n[o], o), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], count[w], n.get(form.get(w))))
    return sorted(out, key=repr)


def check(docs, rows):
    want = expected(rows)
    assert sorted(map(tuple, spelling.variants(docs).collect()), key=repr) == want
    return want


def words_of(rng, alphabet, n):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(6, 10))) for _ in range(n)]


@pytest.mark.parametrize("part", [1024, 3])
def test_brute_force(frame, monkeypatch, part):
    monkeypatch.setattr(spelling, "PART_WORDS", part)
    monkeypatch.setattr(spelling, "BLOCKS_A_CALL", 2 if part == 3 else 16)
    rng = random.Random(5)
    vocabulary = words_of(rng, "abÉé×", 300)
    for w in list(vocabulary[:80]):  # frequent words, edits of them, and edits of the edits
        vocabulary += [w] * rng.choice([1, 12, 150])
        k = rng.randrange(len(w))
        once = rng.choice([w[:k] + "ÿ" + w[k:], w[:k] + w[k + 1:], w[:k] + "Z" + w[k + 1:]])
        vocabulary += [once] * rng.choice([1, 12]) + [once + "q"]
    rng.shuffle(vocabulary)
    rows = [(i, rng.choice([" ", ", ", "\n", "1"]).join(vocabulary[i * 40:(i + 1) * 40]), "s")
            for i in range(len(vocabulary) // 40 + 1)] * 2
    want = check(frame(rows), [(i, t) for i, t, _ in rows])
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] != r[2] and r[1] for r in want)


def test_nulls_long_words_and_repeats(frame):
    long = "abcdefgh" * 8000
    rows = [(None, "Wordlike wordlike wordlikes", "s"), (1, None, None), (2, "", "s"), (3, " \n12", "s"),
            (4, f"{long} {long} {long}x {long}x {long[:500]}Y{long[501:]}", "s"), (4, f"{long[:500]}y{long[501:]}", "s"),
            (5, "wordlike " * 300 + "wordlikes wordlikess", "s"), (5, "wordlikes wordlikess", "s")] + [(6, "wordlije", "s")] * 4
    check(frame(rows), [(i, t) for i, t, _ in rows])


def test_no_words_and_clashing_names(spark, frame):
    assert spelling.variants(frame([])).collect() == []
    docs = spark.createDataFrame([(1, "letters letters", "x", 3)], "doc_id int, text string, word string, n int")
    assert [tuple(r) for r in spelling.variants(docs).collect()] == [("letters", None, "letters", 2, 0, None)]


def test_all_single_edits_are_near():
    rng = random.Random(9)
    words = sorted(set(words_of(rng, "abc", 400)) | {"aaaaaaa", "aaaaaaaa"})
    by_length = {n: [w for w in words if len(w) == n] for n in range(6, 10)}
    for n in range(6, 10):
        for m in (n, n + 1):
            if not by_length.get(m):
                continue
            a, b = spelling._letters(by_length[n], n), spelling._letters(by_length[m], m)
            got = {(by_length[n][i], by_length[m][j]) for i, j in zip(*spelling._near(a, b))}
            assert got == {(x, y) for x in by_length[n] for y in by_length[m] if near(x, y)}
    assert spelling._near(np.zeros((0, 7), np.uint8), spelling._letters(["abcdefg"], 7))[0].size == 0
