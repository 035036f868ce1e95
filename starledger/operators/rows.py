"""Operators that drop, keep or add rows."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starledger.functions.numbers import try_double
from starledger.operators.keys import number_rows

# Payment-card provider texts that mark a junk row.
JUNK_CARD_PROVIDERS = [
    "NULL",
    "NB71VBAHJE",
    "WJVMUO4QX6",
    "JRPRLPIBZ2",
    "TS8A81WFXV",
    "JCQMU8FN85",
    "5CJH7ABGDR",
    "DE488ORDXY",
    "OGJTXI6X1H",
    "1M38DYQTZV",
    "DLWF2HANZF",
    "XGZBYBYGUW",
    "UA07L7EILH",
    "BU9U947ZGV",
    "5MFWFBZRM9",
]

# Product status texts that mark a real row.
PRODUCT_STATUSES = ["Still_avaliable", "Removed"]


def not_in_list(column: Column, values: Sequence[str]) -> Column:
    """True unless the value is listed; NULL is not listed."""
    return ~F.coalesce(column.isin(*values), F.lit(False))


def deny_list_filter(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(not_in_list(F.col(column), values))


def known_status(column: Column) -> Column:
    return column.isin(*PRODUCT_STATUSES) | column.isNull()


def status_filter(df: DataFrame, column: str) -> DataFrame:
    """Rows with a known status or none."""
    return df.where(known_status(F.col(column)))


def drop_last_seen_values(
    df: DataFrame, column: str, position: str, how_many: int = 3
) -> DataFrame:
    """Drop the rows of the ``how_many`` distinct values that appear last in source order.

    NULL counts as a value. First appearances are pre-aggregated per task, and the list
    of dropped values has ``how_many`` rows.
    """
    last = (
        df.groupBy(F.col(column).alias("_value"))
        .agg(F.min(position).alias("_first"))
        .orderBy(F.desc("_first"))
        .limit(how_many)
    )
    return df.join(F.broadcast(last), df[column].eqNullSafe(last["_value"]), "left_anti")


def numeric_mask_filter(df: DataFrame, column: str, to: str = "int") -> DataFrame:
    """Keep rows whose text is a number, and convert it."""
    number = try_double(F.col(column))
    return df.where(number.isNotNull()).withColumn(column, number.cast(to))


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def dedupe_rows(df: DataFrame, position: str | None = None) -> DataFrame:
    """Distinct rows; with ``position``, rows equal in all else keep their first position.

    Grouping the whole row combines copies before the shuffle.
    """
    if position is None:
        return df.distinct()
    rest = [c for c in df.columns if c != position]
    return df.groupBy(*rest).agg(F.min(position).alias(position)).select(*df.columns)


def subset_filter(
    df: DataFrame,
    values: Sequence[str],
    columns: Sequence[str] = ("country_code", "currency_code"),
) -> DataFrame:
    """Keep listed values of the first of ``columns`` that the frame has."""
    present = next((c for c in columns if c in df.columns), None)
    if present is None:
        raise ValueError(f"none of {list(columns)} in {df.columns}")
    return df.where(F.col(present).isin(*values))


def literal_rows(spark: SparkSession, schema: T.StructType, rows: Sequence[dict]) -> DataFrame:
    """A few given rows, typed like ``schema``; columns not named in a row are NULL."""
    named = {name for row in rows for name in row}
    unknown = named - set(schema.names)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    records = F.from_json(
        F.lit(json.dumps(list(rows), default=str)), T.ArrayType(schema), {"mode": "FAILFAST"}
    )
    return spark.range(0, 1, 1, 1).select(F.inline(records))


def prepend_rows(df: DataFrame, rows: Sequence[dict]) -> DataFrame:
    """Given rows in front of the frame. Spark frames have no order, so this is a union."""
    return literal_rows(df.sparkSession, df.schema, rows).unionByName(df)


def prepend_literal_row(df: DataFrame, row: dict, position: str, at: int = -1) -> DataFrame:
    """One given row that comes first in the order of the ``position`` column."""
    return prepend_rows(df, [{**row, position: at}])


# The two default members of every dimension.
DEFAULT_MEMBERS = {
    "dim_users": [
        {"user_key": -1, "first_name": "Not Applicable", "last_name": "Not Applicable"},
        {"user_key": 0, "first_name": "Unknown", "last_name": "Unknown"},
    ],
    "dim_store_details": [
        {"store_key": -1, "store_address": "Not Applicable"},
        {"store_key": 0, "store_address": "Unknown"},
    ],
    "dim_card_details": [
        {"card_key": -1, "card_number": "Not Applicable"},
        {"card_key": 0, "card_number": "Unknown"},
    ],
    "dim_product": [
        {"product_key": -1, "ean": "Not Applicable"},
        {"product_key": 0, "ean": "Unknown"},
    ],
    "dim_date_times": [
        {"date_key": -1, "timestamp": "00:00:00"},
        {"date_key": 0, "timestamp": "00:00:00"},
    ],
    "dim_currency": [
        {"currency_key": -1, "currency_conversion_key": -1, "currency_code": "Not Applicable"},
        {"currency_key": 0, "currency_conversion_key": 0, "currency_code": "Unknown"},
    ],
    "dim_currency_conversion": [
        {"currency_conversion_key": -1, "currency_name": "Not Applicable"},
        {"currency_conversion_key": 0, "currency_name": "Unknown"},
    ],
}


def default_members(df: DataFrame, table: str) -> DataFrame:
    return prepend_rows(df, DEFAULT_MEMBERS[table])


def union_tables(
    parts: Sequence[DataFrame],
    position: str,
    schema: T.StructType | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """All tables of a document under each other, with a fresh ``position`` from 0.

    Every part brings its own ``position``. No part at all gives an empty frame of
    ``schema``.
    """
    if not parts:
        return spark.createDataFrame([], schema)
    tagged = [part.withColumn("_part_no", F.lit(i)) for i, part in enumerate(parts)]
    stacked = reduce(DataFrame.unionByName, tagged)
    return (
        number_rows(stacked, ["_part_no", position], "_fresh")
        .withColumn(position, F.col("_fresh") - 1)
        .select(*parts[0].columns)
    )
