import base64
import collections
import hashlib
import random
import re
import time

import numpy as np
import public_tokenizers
import tiktoken

from tapewright.llm import byte_bpe, quality
from tapewright.llm.queries import tokenizer

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_quality(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]

    def covered(n):
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        count = collections.Counter(grams)
        return {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + n)}

    seen, dup_chars = set(), 0
    for line in lines:
        dup_chars += sum(map(len, WORD.findall(line))) if line in seen else 0
        seen.add(line)
    chars, repeat = sum(map(len, words)), len(covered(3))
    grams = {n: sum(len(words[j]) for j in covered(n)) for n in quality.NGRAM_LIMITS}
    failed = len(words) < 50 or 100 * repeat > 50 * len(words)
    kept = not failed and dup_chars <= quality.LINE_LIMIT * chars and all(
        grams[n] <= limit * chars for n, limit in quality.NGRAM_LIMITS.items())
    return (len(words), chars, len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeat,
            dup_chars, *grams.values(), failed, kept)


def test_quality_matches_brute_force(frame, corpus):
    rows = {r[0]: tuple(r[1:]) for r in quality.measure(frame(corpus)).collect()}
    assert rows == {i: brute_quality(t) for i, t in enumerate(corpus)}
    kept = {r["doc_id"] for r in quality.keep(frame(corpus)).collect()}
    assert kept == {i for i, row in rows.items() if row[-1]} and 20 < len(kept) < len(corpus)


def test_quality_extra_columns_and_empty_table(spark, frame):
    docs = spark.createDataFrame([(1, "a b", 5, None), (1, "a b", 6, True), (None, None, 7, None)],
                                 "doc_id long, text string, n_words int, kept boolean")
    assert sorted(r["n_words"] for r in quality.measure(docs).collect()) == [0, 2, 2]
    assert quality.keep(docs).columns == docs.columns and quality.measure(frame([])).count() == 0


def test_bpe_matches_the_library(frame, corpus):
    path, pattern = tokenizer()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*corpus, "<|endoftext|> don't 123 \u4f60\u597d \U0001f600\u00a0 x", "a" * 3000, "\r\n \t  end", "ab" * 999]
    rows = {r["doc_id"]: r for r in byte_bpe.round_trip(frame(texts), path, pattern).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        assert rows[i]["ids"] == library.encode_ordinary(text or ""), i
        assert bytes(rows[i]["decoded"]).decode() == (text or "")
    assert byte_bpe.round_trip(frame([]), path, pattern).count() == 0


def test_bpe_forgets_without_changing_results(frame, corpus, monkeypatch):
    path, pattern = tokenizer()
    vocab = byte_bpe.vocabulary(path)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    pieces, again = byte_bpe.Pieces(vocab), byte_bpe.Pieces(vocab)
    for words in (["one", " two", " three", "four"], [" two", "x"], [], ["four", " two"]):
        ids, counts = pieces.encode(words)
        alone = [again.encode([w])[0].tolist() for w in words]
        assert ids.tolist() == [i for a in alone for i in a] and counts.tolist() == [len(a) for a in alone]
    assert hashlib.sha256(vocab.decode(pieces.encode(["four"])[0]).tobytes()).hexdigest() == hashlib.sha256(b"four").hexdigest()


def test_long_pieces_merge_alike_and_in_time():
    path, _ = tokenizer()
    vocab = byte_bpe.vocabulary(path)
    rng = random.Random(3)
    pieces = ["".join(rng.choices("etaoinshr", k=byte_bpe.LONG + 500)), "a" * 5001, "\u00e9\u4f60" * 1500, "the" * 2000]
    raw = [p.encode() for p in pieces]
    ids, counts = vocab.encode([*raw, b"short", b"", *raw[:1]])
    rows, ends = [], np.cumsum(counts)
    for end, n in zip(ends, counts):
        rows.append(ids[end - n:end].tolist())
    for row, text in zip(rows, raw):
        grid = vocab.byte_ids[np.frombuffer(text, np.uint8)][None, :].astype(np.int32)
        assert row == vocab._merge(np.array([0]), grid)[0][1][0].tolist()
        assert bytes(vocab.decode(np.array(row))) == text
    assert rows[6] == rows[0] and rows[5] == []
    start = time.perf_counter()
    vocab.encode(["".join(rng.choices("etaoinshr", k=400_000)).encode()])
    assert time.perf_counter() - start < 30
