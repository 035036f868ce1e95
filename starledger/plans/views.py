"""The four reporting views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starledger.functions.numbers import money, percent_of_amount, revenue
from starledger.operators.order import sort_rows
from starledger.operators.skew import KeyProfile, attach, priced_totals
from starledger.plans.star import Star

DATE_PARTS = ["day", "month", "year"]

# Country names shown for the three country codes.
COUNTRY_NAMES = {"GB": "Great Britain", "DE": "Germany", "US": "United States"}


def customer_sales_ranked_view(star: Star) -> DataFrame:
    """Every sale with its customer, highest amount first."""
    fact = star.orders.select("product_key", "date_key", "user_key", "product_quantity")
    profile = KeyProfile(fact, "product_key", "date_key", "user_key")
    sales = attach(
        fact, star.product.select("product_key", "product_price"), "product_key", "inner", profile
    )
    sales = sales.withColumn(
        "sales", money(revenue(F.col("product_price"), F.col("product_quantity")))
    ).drop("product_price", "product_quantity")
    sales = attach(
        sales, star.date_times.select("date_key", *DATE_PARTS, "time_period"), "date_key", "inner", profile
    )
    sales = attach(
        sales, star.users.select("user_key", "first_name", "last_name"), "user_key", "inner", profile
    )
    shown = sales.select("first_name", "last_name", "sales", *DATE_PARTS, "time_period")
    return sort_rows(shown, F.desc_nulls_first("sales"))


def store_sales_breakdown_germany(star: Star) -> DataFrame:
    """Revenue per German store and day.

    The store filter comes first; sales are summed per store and day before the store's
    texts are joined.
    """
    germany = star.store.where(F.col("country_code") == "DE").select(
        "store_key", "store_type", "city", "store_address", "country_code"
    )
    fact = star.orders.select("store_key", "product_key", "date_key", "product_quantity")
    profile = KeyProfile(fact, "store_key", "date_key", "product_key")
    sold = attach(fact, germany.select("store_key"), "store_key", "inner", profile)
    dated = attach(sold, star.date_times.select("date_key", *DATE_PARTS), "date_key", "inner", profile)
    prices = star.product.select("product_key", "product_price")
    by_day = ["store_key", *DATE_PARTS]
    amounts = priced_totals(dated, prices, "product_key", by_day, profile=profile)
    keys = ["store_type", "country_code", "city", "store_address", *DATE_PARTS]
    return (
        attach(amounts, germany, "store_key", "inner", reduced=True)
        .groupBy(*keys)
        .agg(money(F.sum("amount")).alias("total_sales"))
        .drop("country_code")
        .orderBy(F.desc_nulls_first("total_sales"))
    )


def store_sales_breakdown(star: Star) -> DataFrame:
    """Revenue and its share of the whole, by store, day, price and quantity.

    Price and quantity are group keys that are not shown. The whole is the sum over the
    groups, taken as a scalar, not as a window over all groups in one task.
    """
    fact = star.orders.select("store_key", "product_key", "date_key", "product_quantity")
    profile = KeyProfile(fact, "store_key", "product_key", "date_key")
    stores = star.store.select("store_key", "store_type", "city", "region")
    sales = attach(fact, star.product.select("product_key", "product_price"), "product_key", "inner", profile)
    sales = attach(
        sales, star.date_times.select("date_key", *DATE_PARTS, "time_period"), "date_key", "inner", profile
    )
    sales = sales.withColumn("amount", revenue(F.col("product_price"), F.col("product_quantity")))
    shown = ["store_type", "city", "region", "time_period", *DATE_PARTS]
    groups = (
        attach(sales, stores, "store_key", "inner", profile)
        .groupBy(*shown, "product_price", "product_quantity")
        .agg(F.sum("amount").alias("amount"))
    )
    whole = groups.agg(F.sum("amount").alias("whole")).scalar()
    shares = groups.select(
        *shown,
        money(F.col("amount")).alias("total_sales"),
        percent_of_amount(F.col("amount"), whole).alias("percentage_total"),
    )
    return sort_rows(shares, F.desc_nulls_first("percentage_total"))


def store_view(star: Star) -> DataFrame:
    """Stores of the three countries, with the country spelt out."""
    name = F.lit(None).cast("string")
    for code, country in COUNTRY_NAMES.items():
        name = F.when(F.col("country_code") == code, country).otherwise(name)
    return star.store.where(F.col("country_code").isin(*COUNTRY_NAMES)).select(
        "store_code",
        "store_type",
        "city",
        "store_address",
        "region",
        name.alias("country_name"),
        "longitude",
        "latitude",
        "number_of_staff",
    )


VIEWS = {
    "customer_sales_ranked_view": customer_sales_ranked_view,
    "store_sales_breakdown_germany": store_sales_breakdown_germany,
    "store_sales_breakdown": store_sales_breakdown,
    "store_view": store_view,
}
