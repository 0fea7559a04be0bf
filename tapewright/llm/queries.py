"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm import (
    block_names, byte_bpe, check_sql, hard_negatives, jaccard, line_dedup, mixing, near_vectors, quality, secret_scan,
    sharding, spelling, surrogates, url_trust,
)
from tapewright.session import prepare

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def tokenizer() -> tuple[str, str]:
    """Path of the rank file and the pattern that cuts text, both of the installed vocabulary package."""
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN


def mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.plan(_table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def byte_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    done = byte_bpe.round_trip(_table(spark, folder, "documents"), *tokenizer())
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.measure(_table(spark, folder, "documents"))


def line_dedup_runs(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.report(_table(spark, folder, "documents")).select(
        "doc_id", F.col("lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def shard_tree(spark: SparkSession, folder: str) -> DataFrame:
    shards = sharding.SHARDS
    return sharding.assign(_table(spark, folder, "documents"), sharding.topology(shards),
                           sharding.topology(shards + 1)).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_trust.judge(_table(spark, folder, "pages"))


def pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.replace(_table(spark, folder, "documents")).select(
        "doc_id", F.size("entities").cast("long").alias("n_entities"),
        F.array_join("entities", ",").alias("entities"), "text")


def vector_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.link(_table(spark, folder, "embeddings")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "novel")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def hard_negatives_mined(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, folder, "embeddings"))


def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_table(spark, folder, "documents"))


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return block_names.groups(_table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": mix_sources,
        "op2_byte_bpe": byte_bpe_round_trip,
        "op3_jaccard_join": jaccard_join,
        "op4_quality_rules": quality_rules,
        "op5_url_filter": url_filter,
        "op6_pii_surrogates": pii_surrogates,
        "op7_line_dedup": line_dedup_runs,
        "op8_vector_near_dedup": vector_near_dedup,
        "op9_shard_tree": shard_tree,
        "op10_secret_spans": secret_spans,
        "op11_hard_negatives": hard_negatives_mined,
        "op12_spelling_variants": spelling_variants,
        "op13_exact_dedup": exact_dedup,
    }


def checks() -> dict[str, str]:
    return {"op1_mix_sources": check_sql.mix(), "op4_quality_rules": check_sql.quality_rules(),
            "op5_url_filter": check_sql.url_filter(),
            "op11_hard_negatives": check_sql.hard_negatives_mined(), "op12_spelling_variants": check_sql.spelling_variants(),
            "op13_exact_dedup": check_sql.exact_dedup()}
