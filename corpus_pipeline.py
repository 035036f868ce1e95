"""From raw documents to packed training sequences, in five stages.

Each stage reads what the one before it wrote and keeps the columns of ``documents``; the last one
returns the pieces of the packed sequences.

* quality: documents that fail their own or their host's rules go;
* near_dedup: of documents that share 80 % of their five-word shingles, one of each group stays;
* pii: personal data in the texts is replaced by its kind, and ``n_chars`` follows;
* mix: documents are dropped or repeated so that sources meet their target weights;
* pack: documents are tokenized and packed into sequences of 2048 ids.

Nulls in any column, empty texts, repeated rows, empty tables and further columns have the results
that the operators' modules state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starledger.llm import minhash, mixing, packing, pii, quality
from starledger.llm.queries import table, tokenizer_path
from starledger.session import discard, scratch_path, scratch_scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.masked(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.expanded(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("pii", mask_personal_data),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Shingle sets, flows and packing are beyond SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder and read again.

    What a stage wrote on the way is deleted at its end, and its input when its result is written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
