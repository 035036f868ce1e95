"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starledger.llm import (
    embedjoin, langid, merkle, minhash, mixing, oracles, packing, pii, quality, secretscan, sharding, spelling,
    tokencounts, toxicity,
)
from starledger.session import materialised

#: Tokens that a text may have, by the contract of the count.
TOKEN_LIMIT = 512

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The vocabulary file of this machine; another one may be given to the operator."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register("op1_pii")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.found(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind.name) for kind in pii.BASE_KINDS],
        F.sha2(pii.digest("base"), 256).alias("base_sha256"), pii.digest("spans").alias("spans"),
    )


@register("op2_bigru_language")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents"))


@register("op3_epsilon_grid_join", oracles.NEAR_VECTORS)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedjoin.near_vectors(table(spark, sf_dir, "embeddings"))


@register("op4_host_quality_rules", oracles.HOST_QUALITY)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


@register("op5_virtual_slot_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), shards=24, then=25).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"),
        "next_version", "next_shard", "next_place",
    )


@register("op6_mix_min_cost_flow")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", F.col("sources")[0]["source_size"].alias("source_size"),
        F.col("sources")[0]["target"].alias("target"), "taken", "copies",
    )


@register("op7_superminhash_near_dedup", oracles.NEAR_DOCUMENTS)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


@register("op8_toxicity_trees")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path())


@register("op10_markov_secrets")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.found(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind) for kind in secretscan.KINDS],
        F.sha2(secretscan.digest("base"), 256).alias("base_sha256"), secretscan.digest("spans").alias("spans"),
    )


@register("op11_bloom_spelling_groups", oracles.SPELLING)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents"))


@register("op12_pointer_jumping_manifest", oracles.MANIFEST)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents")).drop("proof")


@register("op13_prefix_token_counts")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = materialised(tokencounts.prefix_tables(table(spark, sf_dir, "documents"), tokenizer_path()), "prefixes")
    return tokencounts.truncations(tables, TOKEN_LIMIT).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "cut_chars", "cut_tokens",
    )
