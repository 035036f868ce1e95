"""Sorting and previous-value operators."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from starledger.operators.keys import number_rows
from starledger.session import scratch_path


def sort_rows(df: DataFrame, *first: Column) -> DataFrame:
    """Global sort of row-level output, in which a very common sort value is no hot spot.

    All rows with one sort value would land in one task; the remaining columns and the
    partition a row came from break such ties.
    """
    spread = F.xxhash64(F.spark_partition_id(), *df.columns)
    return df.withColumn("_spread", spread).orderBy(*first, "_spread").drop("_spread")


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def previous_value(df: DataFrame, column: str) -> DataFrame:
    """Each value with the next lower row's value, and the number of rows with that pair.

    Equal to a descending LEAD over all rows: of the n rows that share a value, n - 1 are
    followed by the same value and one by the next lower distinct value (NULL for the
    lowest). Output columns: value, next_value, row_count.
    """
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = number_rows(counted.where(F.col("value").isNotNull()), ["value"], "rank")
    lower = ranked.select((F.col("rank") + 1).alias("rank"), F.col("value").alias("lower"))
    paired = ranked.join(lower, "rank", "left")
    to_lower = paired.select(
        "value", F.col("lower").alias("next_value"), F.lit(1).cast("long").alias("row_count")
    )
    to_same = paired.where(F.col("n") > 1).select(
        "value", F.col("value").alias("next_value"), (F.col("n") - 1).alias("row_count")
    )
    return to_lower.unionByName(to_same)


def lead_rows(df: DataFrame, column: str, to: str = "next_value") -> DataFrame:
    """Every row with a value, and the value of the next lower row in ``to``: a descending LEAD over all rows.

    One range exchange, whose partitions are written as the buckets of a table, so that the window inside a
    partition needs no other; what a partition's lowest row is followed by comes from one row per partition. Rows that
    share a value are dealt over several partitions where they are many.
    """
    spark = df.sparkSession
    spread = F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id())
    ranged = df.where(F.col(column).isNotNull()).withColumn("_spread", spread).repartitionByRange(column, "_spread")
    name, buckets = f"ordered_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = ranged.withColumn("_part", F.spark_partition_id()).write.format("parquet").option("path", scratch_path(spark, "ordered"))
    writer.bucketBy(buckets, "_part").saveAsTable(name)
    ordered = spark.table(name)
    inside = Window.partitionBy("_part").orderBy(column, "_spread")
    lower = ordered.withColumns({to: F.lag(column).over(inside), "_is_lowest": F.row_number().over(inside) == 1})
    # One row per partition, in one task and then in all.
    ends = ordered.groupBy("_part").agg(F.max(column).alias("_high"))
    below = ends.select("_part", F.lag("_high").over(Window.orderBy("_part")).alias("_below"))
    joined = lower.join(F.broadcast(below), "_part")
    return joined.select(*df.columns, F.when(F.col("_is_lowest"), F.col("_below")).otherwise(F.col(to)).alias(to))


def gaps_by_group(df: DataFrame, group: str, micros: str) -> DataFrame:
    """Sum and number of the gaps to the previous row in time, per group.

    For groups that follow each other in time (years of their own timestamps) the gaps of a
    group add up to its last instant minus the last instant of the group before, so a
    group needs only its ends and its row count. The oldest group starts at its own first
    instant and has one gap less. The window runs over one row per group.
    """
    ends = df.groupBy(group).agg(
        F.min(micros).alias("_first"), F.max(micros).alias("_last"), F.count(micros).alias("_rows")
    )
    previous = F.lag("_last").over(Window.orderBy("_last"))
    return ends.withColumn("_previous", previous).select(
        group,
        (F.col("_last") - F.coalesce("_previous", "_first")).alias("total_gap"),
        F.when(F.col("_previous").isNull(), F.col("_rows") - 1).otherwise(F.col("_rows")).alias("gaps"),
    )
