"""From raw documents to token ids: five stages, each an operator of ``tapewright.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm import byte_bpe, jaccard, line_dedup, mixing, quality
from tapewright.llm.queries import tokenizer
from tapewright.llm.tables import stage
from tapewright.session import prepare

# No SQL says the whole pipeline (merges of byte pairs); tests/llm/test_pipeline.py checks it stage by stage.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    prepare(spark)
    return quality.keep(docs)


def line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines are cut; ``n_chars`` follows the text."""
    prepare(spark)
    return line_dedup.clean(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    prepare(spark)
    return jaccard.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    prepare(spark)
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, and whether decoding them gives the text back."""
    prepare(spark)
    done = byte_bpe.round_trip(docs, *tokenizer())
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality_rules), ("line dedup", line_runs), ("n-gram Jaccard join", near_duplicates),
          ("mixing sources", source_mix), ("byte-level BPE", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read by the next."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
