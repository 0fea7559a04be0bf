"""Exact duplicates against a dictionary of normalised texts."""

import hashlib
from collections import defaultdict

import pytest

from tapewright.llm import block_names

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def expected(rows):
    same = defaultdict(list)
    for i, t in rows:
        same[(t or "").translate(UPPER)].append(i)
    out = []
    for text, ids in same.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        for i in ids:
            out.append((i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(docs, rows, block):
    got = block_names.groups(docs, block).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == expected(rows)
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)
    return got


@pytest.mark.parametrize("block", [7, 512])
def test_corpus(frame, corpus, block):
    check(frame(corpus), list(enumerate(corpus)), block)


def test_equal_heads_and_lengths(frame):
    head = "h" * 40
    texts = [head + tail for tail in ("abcd", "abdc", "ABCD", "abce", "xbcd", "abcd" * 9, "abcd" * 8 + "abdc", "")]
    texts += ["a\nb" * 5, "A\nb" * 5, "a\nB" * 5, "É" * 6, "é" * 6, "😀a" * 9, "😀A" * 9, "ı", "I", "i"]
    check(frame(texts), list(enumerate(texts)), 4)


def test_nulls_repeats_and_hot_group(frame):
    rows = [(None, "t", "s"), (None, "T", "s"), (3, "t", "s"), (3, "t", "s"), (3, "u", "s"), (1, None, None), (2, "", "s"),
            (None, "alone", "s"), (None, "both null", "s"), (None, "Both null", "s")]
    rows += [(i, "Copied text of many rows. " * 30, "hot") for i in range(100, 400)]
    check(frame(rows), [(i, t) for i, t, _ in rows], 16)


def test_long_text(frame):
    long = "0123456789abcdef" * 80_000
    texts = [long, long.upper(), long[:-1] + "!", long + "x"]
    got = check(frame(texts), list(enumerate(texts)), 512)
    assert {r.doc_id: r.keep_id for r in got} == {0: 1, 1: 1, 2: 2, 3: 3}


def test_keeps_columns_and_clashing_names(spark):
    rows = [(1, "A", 5, {"k": 1}, "x"), (2, "a", 6, None, "y"), (3, None, 7, {}, "z")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, row int, carry map<string,int>, `norm.x` string")
    kept = block_names.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    assert sorted(r[0] for r in kept.collect()) == [2, 3]


def test_empty_table(frame):
    docs = frame([])
    assert block_names.groups(docs).collect() == [] and block_names.keep_one(docs).collect() == []
