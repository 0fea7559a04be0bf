"""The stages of the pipeline one after the other on a small corpus, each against what it must give."""

from collections import Counter

import pytest
import tiktoken
from pyspark.sql import functions as F
from tiktoken.load import load_tiktoken_bpe

import corpus_pipeline
from tapewright.llm import line_dedup, mixing, quality
from tapewright.llm.queries import tokenizer

from test_jaccard import brute


@pytest.fixture(scope="module")
def stages(spark, frame, corpus):
    clash = frame(corpus).withColumn("root", F.lit("clash")).withColumn("total", F.lit(7))
    out = [clash]
    for _, step in corpus_pipeline.STAGES:
        out.append(step(spark, out[-1], None).cache())
    return out


def rows(frame):
    return frame.orderBy("doc_id").collect()


def test_all_but_the_last_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert stages[-1].columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]


def test_quality_keeps_what_its_measure_keeps(stages):
    kept = {r["doc_id"] for r in quality.measure(stages[0]).filter("kept").collect()}
    assert kept and {r["doc_id"]: r["text"] for r in rows(stages[1])} == {
        r["doc_id"]: r["text"] for r in rows(stages[0]) if r["doc_id"] in kept}


def test_line_dedup_cuts_lines_only(stages):
    before = {r["doc_id"]: r["text"].split("\n") for r in rows(stages[1])}
    after = rows(stages[2])
    want = {r["doc_id"]: r["text"] for r in line_dedup.clean(stages[1]).collect()}
    assert {r["doc_id"]: r["text"] for r in after} == want
    for r in after:
        lines = iter(before[r["doc_id"]])
        assert all(line in lines for line in r["text"].split("\n")) or r["text"] == ""
        assert r["n_chars"] == len(r["text"])


def test_one_of_each_group_stays(stages):
    before = rows(stages[2])
    want = {before[i]["doc_id"] for i, (n, least) in brute([r["text"] for r in before]).items() if least == i}
    assert {r["doc_id"] for r in rows(stages[3])} == want


def test_mix_takes_the_planned_copies(stages):
    plan = {r["doc_id"]: r["copies"] for r in mixing.plan(stages[3]).collect() if r["copies"]}
    assert plan and Counter(r["doc_id"] for r in rows(stages[4])) == plan


def test_tokens_are_those_of_the_library(stages):
    path, pattern = tokenizer()
    library = tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in rows(stages[4])}
    for r in rows(stages[5]):
        assert list(r["ids"]) == library.encode_ordinary(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])
