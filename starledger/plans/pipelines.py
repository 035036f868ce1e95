"""Raw dataset -> cleaned dataset, one function per dataset.

``position`` names the column that holds the source order; Spark frames have none.
``dense_position`` states that it counts 0, 1, 2, ... so that ordinal keys need no shuffle.
``watch`` sees the rows before a dataset's rules drop some, see ``operators.rejects``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starledger.functions.dates import clean_dates, make_full_date, parse_date_uniform
from starledger.functions.goods import weight_class, weight_to_kg
from starledger.functions.numbers import strip_symbol, try_double
from starledger.functions.text import digits_only
from starledger.operators import columns as cols, rows
from starledger.operators.keys import Watch, key_dense, key_ordinal

# Source layouts that are named by position, and target column orders.
USER_COLUMNS = [
    "user_key", "first_name", "last_name", "date_of_birth", "company", "email_address",
    "address", "country", "country_code", "phone_number", "join_date", "user_uuid",
]
STORE_SOURCE = [
    "store_key", "store_address", "longitude", "null_column", "city", "store_code",
    "number_of_staff", "opening_date", "store_type", "latitude", "country_code", "region",
]
STORE_COLUMNS = [
    "store_key", "store_address", "longitude", "latitude", "city", "store_code",
    "number_of_staff", "opening_date", "store_type", "country_code", "region",
]
CARD_COLUMNS = [
    "card_key", "card_number", "expiry_date", "card_provider", "date_payment_confirmed",
]
ORDER_SOURCE = [
    "order_key", "null_key", "date_uuid", "first_name", "last_name", "user_uuid",
    "card_number", "store_code", "product_code", "null_column", "product_quantity",
]
ORDER_KEYS = {
    "card_key": "long", "date_key": "long", "product_key": "long", "store_key": "long",
    "user_key": "long", "currency_key": "long", "country_code": "string",
}
ORDER_COLUMNS = [
    "order_key", "date_uuid", "user_uuid", "card_key", "date_key", "product_key", "store_key",
    "user_key", "currency_key", "card_number", "store_code", "product_code",
    "product_quantity", "country_code",
]
DATE_COLUMNS = [
    "date_key", "date_uuid", "day", "month", "year", "timestamp", "full_date", "time_period",
]
PRODUCT_SOURCE = [
    "product_name", "product_price", "weight", "category", "ean", "date_added", "uuid",
    "availability", "product_code",
]
PRODUCT_COLUMNS = [
    "product_key", "ean", "product_name", "product_price", "weight", "weight_class", "category",
    "date_added", "uuid", "availability", "product_code",
]
CURRENCY_COLUMNS = [
    "currency_key", "currency_conversion_key", "currency_code", "country_code", "country_name",
    "currency_symbol",
]
RATE_SOURCE = ["currency_name", "conversion_rate", "conversion_rate_percentage"]
RATE_COLUMNS = [
    "currency_conversion_key", "currency_name", "currency_code", "conversion_rate",
    "conversion_rate_percentage", "last_updated",
]
BASE_RATE = {
    "currency_name": "British Pound",
    "currency_code": "GBP",
    "conversion_rate": "1.000000",
    "conversion_rate_percentage": "1.000000",
}


def clean_users(raw: DataFrame, position: str, watch: Watch | None = None) -> DataFrame:
    dated = raw.withColumns(
        {c: clean_dates(F.col(c)) for c in ("date_of_birth", "join_date")}
    )
    rules = {c: F.col(c).isNotNull() for c in ("date_of_birth", "join_date")}
    return key_dense(dated, [position], "user_key", rules, watch).select(*USER_COLUMNS)


def clean_stores(raw: DataFrame, watch: Watch | None = None) -> DataFrame:
    """The first column of the source is its row index and gives the order."""
    named = cols.positional_rename(raw, STORE_SOURCE).drop("null_column")
    dated = named.withColumn("opening_date", clean_dates(F.col("opening_date")))
    rules = {"opening_date": F.col("opening_date").isNotNull()}
    keyed = key_dense(dated, ["store_key"], "store_key", rules, watch)
    fixed = cols.replace_values(keyed, cols.REGION_FIXES)
    fixed = cols.repair_codes(fixed, "number_of_staff", cols.STAFF_FIXES, "smallint")
    for c in ("longitude", "latitude"):
        fixed = cols.coerce_numeric(fixed, c)
    return fixed.select(*STORE_COLUMNS)


def clean_cards(
    raw: DataFrame, position: str, dense_position: bool = False, watch: Watch | None = None
) -> DataFrame:
    dated = raw.withColumns(
        {
            "card_number": digits_only(F.col("card_number")),
            "date_payment_confirmed": clean_dates(F.col("date_payment_confirmed")),
        }
    )
    rules = {
        "card_provider": rows.not_in_list(F.col("card_provider"), rows.JUNK_CARD_PROVIDERS),
        "date_payment_confirmed": F.col("date_payment_confirmed").isNotNull(),
    }
    keyed = key_ordinal(dated, [position], "card_key", rules, dense_position, watch)
    return keyed.select(*CARD_COLUMNS)


def clean_orders(raw: DataFrame) -> DataFrame:
    named = cols.positional_rename(raw, ORDER_SOURCE)
    slim = cols.drop_columns(named, "null_key", "first_name", "last_name", "null_column")
    return cols.add_null_columns(slim, ORDER_KEYS).select(*ORDER_COLUMNS)


def clean_date_times(
    raw: DataFrame, position: str, dense_position: bool = False, watch: Watch | None = None
) -> DataFrame:
    month = try_double(F.col("month"))
    rules = {"month": month.isNotNull()}
    keyed = key_ordinal(raw, [position], "date_key", rules, dense_position, watch)
    numbered = keyed.withColumn("month", month.cast("int")).withColumns(
        {c: try_double(F.col(c)).cast("int") for c in ("day", "year")}
    )
    dated = numbered.withColumn(
        "full_date", make_full_date(F.col("year"), F.col("month"), F.col("day"))
    )
    return dated.select(*DATE_COLUMNS)


def clean_products(
    raw: DataFrame, position: str, dense_position: bool = False, watch: Watch | None = None
) -> DataFrame:
    """``position`` is the unnamed first column of the file; the other nine follow it.

    The weight class stays missing here; the dimension derives it, see ``classed_products``.
    """
    source = [c for c in raw.columns if c != position]
    named = raw.select(F.col(position).alias("_position"), *source).toDF("_position", *PRODUCT_SOURCE)
    measured = named.withColumns(
        {
            "date_added": parse_date_uniform(F.col("date_added")),
            "product_price": strip_symbol(F.col("product_price")),
            "weight": weight_to_kg(F.col("weight")),
        }
    )
    rules = {
        "availability": rows.known_status(F.col("availability")),
        "weight": F.col("weight").isNotNull(),
    }
    keyed = key_ordinal(measured, ["_position"], "product_key", rules, dense_position, watch)
    return cols.add_null_columns(keyed, {"weight_class": "string"}).select(*PRODUCT_COLUMNS)


def classed_products(products: DataFrame) -> DataFrame:
    """Weight classes of a dimension; rows without a weight, the default members too, are 'Unknown'."""
    return products.withColumn("weight_class", weight_class(F.col("weight"))).select(*products.columns)


def clean_currency(raw: DataFrame, position: str) -> DataFrame:
    keyed = key_dense(raw, [position], "currency_key")
    return cols.add_null_columns(keyed, {"currency_conversion_key": "long"}).select(*CURRENCY_COLUMNS)


def clean_rates(raw: DataFrame, mapping: DataFrame, run_ts: str, position: str) -> DataFrame:
    """``mapping`` is a (name, code) frame. Missing names and rates stay missing."""
    data = [c for c in raw.columns if c != position]
    named = cols.positional_rename(raw.select(position, *data), [position, *RATE_SOURCE])
    coded = cols.map_values(
        rows.dedupe_rows(named, position), "currency_name", mapping, to="currency_code"
    )
    with_base = rows.prepend_literal_row(coded, BASE_RATE, position)
    keyed = key_dense(with_base, [position], "currency_conversion_key")
    return cols.stamp_last_updated(keyed, run_ts).select(*RATE_COLUMNS)
