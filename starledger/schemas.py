"""Declared table layouts: spec text -> Spark types, typed projection, reject audit."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The declared type names and the Spark type each one maps to.
# TIME and UUID are kept as validated text.
TYPE_NAMES = {
    "BIGINT": T.LongType(),
    "VARCHAR": T.StringType(),
    "DATE": T.DateType(),
    "FLOAT": T.DoubleType(),
    "SMALLINT": T.ShortType(),
    "BOOLEAN": T.BooleanType(),
    "TIME": T.StringType(),
    "NUMERIC": T.DecimalType(38, 6),
    "TIMESTAMP": T.TimestampType(),
    "INTEGER": T.IntegerType(),
    "UUID": T.StringType(),
    "DECIMAL": T.DecimalType(38, 6),
    "DATETIME": T.TimestampNTZType(),
}

# Column names and declared types of the warehouse tables.
_LAYOUTS = {
    "users": """
        user_uuid UUID; user_key BIGINT; first_name VARCHAR(255); last_name VARCHAR(255);
        date_of_birth DATE; company VARCHAR(255); email_address VARCHAR(255);
        address VARCHAR(600); country VARCHAR(100); country_code VARCHAR(20);
        phone_number VARCHAR(50); join_date DATE""",
    "stores": """
        store_key BIGINT; store_address VARCHAR(1000); longitude FLOAT; latitude FLOAT;
        city VARCHAR(255); store_code VARCHAR(20); number_of_staff SMALLINT;
        opening_date DATE; store_type VARCHAR(255); country_code VARCHAR(20);
        region VARCHAR(255)""",
    "date_times": """
        date_key BIGINT; date_uuid UUID; day INTEGER; month INTEGER; year INTEGER;
        timestamp TIME; full_date DATE; time_period VARCHAR(40)""",
    "cards": """
        card_key BIGINT; card_number VARCHAR(30); expiry_date VARCHAR(20);
        card_provider VARCHAR(255); date_payment_confirmed DATE""",
    "products": """
        product_key BIGINT; ean VARCHAR(50); product_name VARCHAR(500); product_price FLOAT;
        weight FLOAT; weight_class VARCHAR(50); category VARCHAR(50); date_added DATE;
        uuid UUID; availability VARCHAR(30); product_code VARCHAR(50)""",
    "currency": """
        currency_key BIGINT; currency_conversion_key BIGINT; country_name VARCHAR(100);
        currency_code VARCHAR(20); country_code VARCHAR(5); currency_symbol VARCHAR(5)""",
    "currency_conversion": """
        currency_conversion_key BIGINT; currency_name VARCHAR(50); currency_code VARCHAR(5);
        conversion_rate NUMERIC(20,6); conversion_rate_percentage NUMERIC(20,6);
        last_updated TIMESTAMP""",
    "orders": """
        order_key BIGINT; date_uuid UUID; user_uuid UUID; card_key BIGINT; date_key BIGINT;
        product_key BIGINT; store_key BIGINT; user_key BIGINT; currency_key BIGINT;
        card_number VARCHAR(30); store_code VARCHAR(30); product_code VARCHAR(30);
        product_quantity SMALLINT; country_code VARCHAR(20)""",
}

# Table names per layer.
LAND_TABLES = {
    "users": "land_user_data",
    "stores": "land_store_data",
    "cards": "land_card_data",
    "products": "land_product_data",
    "date_times": "land_date_times",
    "currency": "land_currency_data",
    "currency_conversion": "land_currency_conversion_data",
}
DIM_TABLES = {
    "users": "dim_users",
    "stores": "dim_store_details",
    "cards": "dim_card_details",
    "products": "dim_product",
    "date_times": "dim_date_times",
    "currency": "dim_currency",
    "currency_conversion": "dim_currency_conversion",
}
RAW_TABLES = {
    "users": "raw_user_data",
    "stores": "raw_store_data",
    "cards": "raw_card_data",
    "products": "raw_product_data",
    "date_times": "raw_time_event_data",
}
FACT_TABLE = "orders_table"

UUID_PATTERN = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
TIME_PATTERN = "^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"


def parse_type(declared: str) -> T.DataType:
    """``VARCHAR(255)`` / ``NUMERIC(20,6)`` / ``BIGINT`` -> Spark type."""
    name, _, arguments = declared.strip().partition("(")
    name = name.strip().upper()
    if name not in TYPE_NAMES:
        raise ValueError(f"unknown type name: {declared}")
    if name in ("NUMERIC", "DECIMAL") and arguments:
        precision, *scale = [int(n) for n in arguments.rstrip(") ").split(",")]
        return T.DecimalType(precision, scale[0] if scale else 0)
    return TYPE_NAMES[name]


def max_length(declared: str) -> int | None:
    found = re.fullmatch(r"\s*VARCHAR\s*\((\d+)\)\s*", declared, re.IGNORECASE)
    return int(found.group(1)) if found else None


def parse_layout(text: str) -> dict[str, str]:
    pairs = (entry.split(None, 1) for entry in text.split(";") if entry.strip())
    return {name: declared.strip() for name, declared in pairs}


LAYOUTS = {dataset: parse_layout(text) for dataset, text in _LAYOUTS.items()}
TABLE_LAYOUTS = {
    **{table: LAYOUTS[dataset] for dataset, table in LAND_TABLES.items()},
    **{table: LAYOUTS[dataset] for dataset, table in DIM_TABLES.items()},
    FACT_TABLE: LAYOUTS["orders"],
}


def struct_type(layout: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, parse_type(t), True) for n, t in layout.items()])


_PATTERNS = {"UUID": UUID_PATTERN, "TIME": TIME_PATTERN}


def _type_name(declared: str) -> str:
    return declared.split("(")[0].strip().upper()


def flag_of(column: str) -> str:
    """Name of the column that says whether a text has its shape; see ``flag_shapes``."""
    return f"_rule_shape_{column}"


def flag_shapes(df: DataFrame, layout: Mapping[str, str]) -> DataFrame:
    """``df`` with a flag for each text that is declared by its shape, so that counting and typing match it once."""
    shaped = {c: _PATTERNS.get(_type_name(layout[c])) for c in df.columns if c in layout}
    return df.withColumns({flag_of(c): F.col(c).rlike(pattern) for c, pattern in shaped.items() if pattern})


def typed(column: str, declared: str, flag: str | None = None) -> Column:
    """Cast one column to its declared type; text that does not fit becomes NULL. ``flag`` names a column of ``flag_shapes``."""
    source = F.col(column)
    name = _type_name(declared)
    if name in _PATTERNS:
        fits = F.col(flag) if flag else source.rlike(_PATTERNS[name])
        return F.when(fits, F.lower(source) if name == "UUID" else source).alias(column)
    return source.try_cast(parse_type(declared)).alias(column)


def enforce_schema(df: DataFrame, layout: dict[str, str]) -> DataFrame:
    """Type the columns the layout names; leave other and already typed ones as they are. Flags of ``flag_shapes`` are used and left out."""
    flags = {flag_of(c) for c in layout} & set(df.columns)

    def fits(field: T.StructField) -> bool:
        declared = layout.get(field.name)
        return declared is None or (
            field.dataType == parse_type(declared)
            and _type_name(declared) not in _PATTERNS
        )

    def cast(name: str) -> Column:
        return typed(name, layout[name], flag_of(name) if flag_of(name) in flags else None)

    return df.select(*[F.col(f.name) if fits(f) else cast(f.name) for f in df.schema.fields if f.name not in flags])


def schema_rejects(df: DataFrame, layout: dict[str, str]) -> DataFrame:
    """Per column: values lost to the typed cast, and texts over the declared length.

    One pass of conditional sums over the input, unpivoted afterwards.
    """
    columns = [c for c in df.columns if c in layout]
    sums = []
    for c in columns:
        lost = F.col(c).isNotNull() & typed(c, layout[c]).isNull()
        limit = max_length(layout[c])
        long = F.length(F.col(c)) > limit if limit else F.lit(False)
        sums.append(F.count(F.when(lost, 1)).alias(f"{c}__rejected"))
        sums.append(F.count(F.when(long, 1)).alias(f"{c}__too_long"))
    entries = ", ".join(f"'{c}', `{c}__rejected`, `{c}__too_long`" for c in columns)
    return df.agg(*sums).selectExpr(
        f"stack({len(columns)}, {entries}) AS (column_name, rejected, too_long)"
    )


def alter_types(df: DataFrame, changes: dict[str, str]) -> DataFrame:
    """Explicit strict casts: a value that does not fit fails the job."""
    replaced = {}
    for c, declared in changes.items():
        name = declared.split("(")[0].strip().upper()
        pattern = {"UUID": UUID_PATTERN, "TIME": TIME_PATTERN}.get(name)
        if pattern:
            bad = F.raise_error(F.concat(F.lit(f"{c} is not a {name}: "), F.col(c)))
            text = F.lower(F.col(c)) if name == "UUID" else F.col(c)
            replaced[c] = F.when(F.col(c).isNull() | F.col(c).rlike(pattern), text).otherwise(bad)
        else:
            replaced[c] = F.col(c).cast(parse_type(declared))
    return df.withColumns(replaced)
