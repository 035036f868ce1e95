"""Constraints as checks: they report, they do not enforce."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def audit_pk(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that are missing or used more than once, with their row count."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where((F.col("row_count") > 1) | missing)
    )


def audit_pk_summary(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table: distinct keys used more than once, and rows without a key."""
    parts = []
    for name, (df, key) in tables.items():
        counts = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            counts.agg(
                F.count(F.when(F.col("k").isNotNull() & (F.col("n") > 1), 1)).alias("duplicate_keys"),
                F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_rows"),
            ).select(F.lit(name).alias("table_name"), "duplicate_keys", "null_rows")
        )
    return reduce(DataFrame.unionByName, parts)


def audit_fk(
    fact: DataFrame, references: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Per reference: distinct non-null keys, and rows using them, that no dimension row has.

    The fact is read once: its key columns are unpivoted and counted per value before
    the shuffle, so a key that owns a third of the rows is one row per task by then.
    """
    keys = list(references)
    # Numbers stand for the names until the end: a text would be hashed, compared and shuffled with every key.
    entries = ", ".join(f"{i}, CAST(`{k}` AS BIGINT)" for i, k in enumerate(keys))
    used = (
        fact.selectExpr(f"stack({len(keys)}, {entries}) AS (place, key)")
        .where("key IS NOT NULL")
        .groupBy("place", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            dim.select(F.lit(i).alias("place"), F.col(key).cast("long").alias("key"))
            for i, (dim, key) in enumerate(references.values())
        ],
    )
    return (
        used.join(known.distinct().withColumn("found", F.lit(True)), ["place", "key"], "left")
        .groupBy("place")
        .agg(
            F.count(F.when(F.col("found").isNull(), 1)).alias("orphan_keys"),
            F.coalesce(F.sum(F.when(F.col("found").isNull(), F.col("n"))), F.lit(0)).alias("orphan_rows"),
        )
        .select(F.element_at(F.array(*[F.lit(k) for k in keys]), F.col("place") + 1).alias("fk"), "orphan_keys", "orphan_rows")
    )


def _bitmaps(df: DataFrame, key: str, name: str) -> DataFrame:
    """(bucket, <name>): a bitmap of the keys of every range of 32,768; missing keys have none."""
    value = F.col(key).cast("long")
    keyed = df.select(F.bitmap_bucket_number(value).alias("bucket"), F.bitmap_bit_position(value).alias("bit"))
    return keyed.where("bucket IS NOT NULL").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias(name))


def _within(df: DataFrame, key: str, buckets: DataFrame) -> DataFrame:
    """Keys of ``df`` in some of the buckets; nothing is shuffled by key where there are none."""
    keyed = df.select(F.col(key).cast("long").alias("key")).withColumn("bucket", F.bitmap_bucket_number("key"))
    return keyed.join(buckets, "bucket", "left_semi").select("key")


def audit_pk_bitmaps(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``audit_pk_summary`` for whole-number keys that lie dense, as surrogate keys do.

    Every range of 32,768 keys is one bitmap of 4 KB: a range with as many rows as set bits has no key twice. Rows are
    shuffled as bitmaps, and by key only from ranges where the two differ.
    """
    parts = []
    for name, (df, key) in tables.items():
        value = F.col(key).cast("long")
        ranges = (
            df.select(F.bitmap_bucket_number(value).alias("bucket"), F.bitmap_bit_position(value).alias("bit"))
            .groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.bitmap_count(F.bitmap_construct_agg("bit")).alias("keys"))
        )
        repeated = ranges.where(F.col("bucket").isNotNull() & (F.col("n") > F.col("keys"))).select("bucket")
        twice = _within(df, key, repeated).groupBy("key").count().where("count > 1")
        missing = df.where(F.col(key).isNull()).agg(F.count(F.lit(1)).alias("null_rows")).scalar()
        parts.append(
            twice.agg(F.count(F.lit(1)).alias("duplicate_keys"))
            .select(F.lit(name).alias("table_name"), "duplicate_keys", missing.alias("null_rows"))
        )
    return reduce(DataFrame.unionByName, parts)


def audit_fk_bitmaps(fact: DataFrame, references: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``audit_fk`` for whole-number keys that lie dense.

    A range in which the keys of fact and dimension together set no more bits than those of the dimension has no orphan. Rows are
    read again, and joined by key, only in the other ranges.
    """
    parts = []
    for fk, (dim, key) in references.items():
        used, known = _bitmaps(fact, fk, "bits"), _bitmaps(dim, key, "bits")
        both = used.select("bucket", "bits", F.lit(False).alias("is_known")).union(known.select("bucket", "bits", F.lit(True)))
        none = F.lit(b"")
        ranges = both.groupBy("bucket").agg(
            F.bitmap_count(F.bitmap_or_agg("bits")).alias("either"),
            F.bitmap_count(F.bitmap_or_agg(F.when(F.col("is_known"), F.col("bits")).otherwise(none))).alias("known"),
        )
        open_ = ranges.where("either > known").select("bucket")
        counted = _within(fact, fk, open_).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        orphans = counted.join(_within(dim, key, open_).distinct(), "key", "left_anti")
        parts.append(
            orphans.agg(F.count(F.lit(1)).alias("orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"))
            .select(F.lit(fk).alias("fk"), "orphan_keys", "orphan_rows")
        )
    return reduce(DataFrame.unionByName, parts)


def unresolved_key_counts(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows pointing to the 'Unknown' member, per key, in one pass."""
    sums = [F.count(F.when(F.col(k) == 0, 1)).alias(k) for k in keys]
    entries = ", ".join(f"'{k}', `{k}`" for k in keys)
    return fact.agg(*sums).selectExpr(f"stack({len(keys)}, {entries}) AS (key_column, unresolved)")


def row_reconciliation(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row counts of two tables that should be equal."""
    right_rows = right.agg(F.count(F.lit(1)).alias("right_rows")).scalar()
    return left.agg(F.count(F.lit(1)).alias("left_rows")).select(
        "left_rows",
        right_rows.alias("right_rows"),
        (F.col("left_rows") - right_rows).alias("difference"),
        (F.col("left_rows") == right_rows).alias("matches"),
    )
