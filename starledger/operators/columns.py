"""Operators that change columns and leave the rows alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starledger.functions.numbers import try_double
from starledger.operators.skew import attach

# Misspelt cells and mistyped staff counts, with their corrections.
REGION_FIXES = {"eeEurope": "Europe", "eeAmerica": "America"}
STAFF_FIXES = {"3n9": "39", "A97": "97", "80R": "80", "J78": "78", "30e": "30"}

# Availability texts per status.
AVAILABILITY_TEXTS = {"Still_avaliable": "True", "Removed": "False"}


def positional_rename(df: DataFrame, *layouts: Sequence[str]) -> DataFrame:
    """Rename all columns by position, with the one layout that has the right length."""
    for names in layouts:
        if len(names) == len(df.columns):
            return df.toDF(*names)
    raise ValueError(f"no layout of {len(df.columns)} columns")


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def reorder_columns(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.select(*order)


def add_null_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({n: F.lit(None).cast(t) for n, t in types.items()})


def replace_values(df: DataFrame, fixes: Mapping[str, str]) -> DataFrame:
    """Replace whole cells in every text column."""
    return df.replace(dict(fixes))


def repair_codes(df: DataFrame, column: str, fixes: Mapping[str, str], to: str) -> DataFrame:
    repaired = df.replace(dict(fixes), subset=[column])
    return repaired.withColumn(column, F.col(column).try_cast(to))


def coerce_numeric(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, try_double(F.col(column)))


def map_literal(column: Column, mapping: Mapping[str, str]) -> Column:
    """Value of a small given dictionary; unmapped values are NULL."""
    entries = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), column)


def map_values(df: DataFrame, column: str, mapping, to: str | None = None) -> DataFrame:
    """Map a column through a dictionary, or through a (name, code) frame, into ``to``.

    A name with two codes in the frame fails the job if a row uses it.
    """
    target = to or column
    if isinstance(mapping, Mapping):
        return df.withColumn(target, map_literal(F.col(column), mapping))
    order = [c for c in df.columns if c != target] + [target]
    lookup = mapping.groupBy(F.col("name").alias("_name")).agg(F.min("code").alias("_low"), F.max("code").alias("_code"))
    joined = attach(df.withColumn("_name", F.col(column)), lookup, "_name", "left", bound=mapping)
    repeated = F.raise_error(F.concat(F.lit("more than one code for "), F.col("_name").cast("string")))
    code = F.when(F.col("_low") != F.col("_code"), repeated).otherwise(F.col("_code"))
    return joined.withColumn(target, code).select(*order)


def stamp_last_updated(df: DataFrame, run_ts: str) -> DataFrame:
    return df.withColumn("last_updated", F.lit(run_ts))


def fill_all_nulls(df: DataFrame, value: str) -> DataFrame:
    """Every NULL in a text column becomes ``value``."""
    return df.na.fill(value)
