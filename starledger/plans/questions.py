"""The nine business questions.

Revenue questions reduce the sales to one row per store, or per date part, before those
are shuffled or joined further, so a store that owns a third of the sales is a few rows
per task by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from starledger.functions.dates import sale_instant
from starledger.functions.gaps import format_gap, mean_gap, micros
from starledger.functions.numbers import money, percent_of_count
from starledger.operators.order import gaps_by_group, top_k
from starledger.operators.skew import KeyProfile, attach, priced_totals
from starledger.plans.star import Star

# The country codes of question 1 and the code of the web shop.
STORE_COUNTRIES = ["GB", "DE", "US"]
WEB_STORE = "WEB-1388012W"


def q1_stores_by_country(star: Star) -> DataFrame:
    return (
        star.store.where(F.col("country_code").isin(*STORE_COUNTRIES))
        .groupBy(F.col("country_code").alias("country"))
        .agg(F.count("country_code").alias("total_no_of_stores"))
        .orderBy(F.desc_nulls_first("total_no_of_stores"))
    )


def q2_stores_by_locality(star: Star) -> DataFrame:
    """Stores without a city are a group of their own that counts 0."""
    return (
        star.store.groupBy(F.col("city").alias("locality"))
        .agg(F.count("city").alias("total_no_of_stores"))
        .orderBy(F.desc_nulls_first("total_no_of_stores"))
    )


def _revenue_by_date(star: Star, *parts: str) -> DataFrame:
    fact = star.orders.select("product_key", "date_key", "product_quantity")
    profile = KeyProfile(fact, "date_key", "product_key")
    dates = star.date_times.select("date_key", *parts)
    dated = attach(fact, dates, "date_key", "inner", profile)
    prices = star.product.select("product_key", "product_price")
    return priced_totals(dated, prices, "product_key", parts, profile=profile).select(
        *parts, money(F.col("amount")).alias("total_sales")
    )


def q3_sales_by_month(star: Star) -> DataFrame:
    return (
        _revenue_by_date(star, "month")
        .select("total_sales", F.col("month").alias("month_number"))
        .orderBy(F.desc_nulls_first("total_sales"))
    )


def q4_online_vs_offline(star: Star) -> DataFrame:
    """A missing store code counts as offline. The window runs over the two groups."""
    location = F.when(F.col("store_code") == WEB_STORE, "Web").otherwise("Offline")
    whole = F.sum("number_of_sales").over(Window.partitionBy())
    return (
        star.orders.groupBy(location.alias("location"))
        .agg(
            F.count(F.lit(1)).alias("number_of_sales"),
            F.sum("product_quantity").alias("product_quantity_count"),
        )
        .select(
            "number_of_sales",
            "product_quantity_count",
            percent_of_count(F.col("number_of_sales"), whole).alias("percentage_total"),
            "location",
        )
    )


def q5_sales_by_store_type(star: Star) -> DataFrame:
    """Joins on natural codes and keeps unmatched sales; the share is one of sale counts."""
    fact = star.orders.select("product_code", "store_code", "product_quantity")
    prices = star.product.where(F.col("product_code").isNotNull()).select("product_code", "product_price")
    types = star.store.where(F.col("store_code").isNotNull()).select("store_code", "store_type")
    by_store = priced_totals(fact, prices, "product_code", ["store_code"], "left")
    orders = fact.agg(F.count(F.lit(1)).alias("orders")).scalar()
    return (
        attach(by_store, types, "store_code", "left", reduced=True)
        .groupBy("store_type")
        .agg(F.sum("amount").alias("amount"), F.sum("sales").alias("count"))
        .select(
            "store_type",
            money(F.col("amount")).alias("total_sales"),
            percent_of_count(F.col("count"), orders).alias("percentage_total"),
            "count",
            orders.alias("total_orders"),
        )
        .orderBy(F.desc_nulls_first("total_sales"))
    )


def q6_sales_by_year_month(star: Star) -> DataFrame:
    return (
        _revenue_by_date(star, "year", "month")
        .select("total_sales", "year", "month")
        .orderBy(F.desc_nulls_first("total_sales"))
    )


def q7_staff_by_country(star: Star) -> DataFrame:
    return (
        star.store.where(F.col("country_code").isNotNull())
        .groupBy("country_code")
        .agg(F.sum("number_of_staff").alias("number_of_staff"))
        .select("number_of_staff", "country_code")
        .orderBy(F.desc_nulls_first("number_of_staff"))
    )


def q8_german_store_types(star: Star) -> DataFrame:
    """The country of the sale decides, not that of the store row."""
    fact = star.orders.where(F.col("country_code") == "DE").select(
        "store_key", "product_key", "product_quantity"
    )
    prices = star.product.select("product_key", "product_price")
    by_store = priced_totals(fact, prices, "product_key", ["store_key"])
    stores = star.store.select("store_key", "store_type", "country_code")
    return (
        attach(by_store, stores, "store_key", "inner", reduced=True)
        .groupBy("store_type", "country_code")
        .agg(money(F.sum("amount")).alias("total_sales"))
        .select("total_sales", "store_type", "country_code")
        .orderBy(F.desc_nulls_first("total_sales"))
    )


def sale_gaps(star: Star) -> DataFrame:
    """Mean gap to the previous sale per year, in microseconds.

    The default members have no date and are left out by their keys. An impossible date gives
    no instant; its year then has one sale less to measure between.
    """
    instant = sale_instant(*(F.col(c) for c in ("year", "month", "day", "timestamp")))
    events = star.date_times.where(F.col("date_key") >= 1).select("year", micros(instant).alias("at"))
    return gaps_by_group(events, "year", "at").select(
        "year", mean_gap(F.col("total_gap"), F.col("gaps")).alias("mean_gap")
    )


def q9_sale_frequency(star: Star) -> DataFrame:
    """The five years with the longest mean gap, as text. Whole days are not shown."""
    longest = top_k(sale_gaps(star), [F.desc_nulls_first("mean_gap")], 5)
    return longest.select("year", format_gap(F.col("mean_gap")).alias("actual_time_taken"))


QUESTIONS = {
    "q1_stores_by_country": q1_stores_by_country,
    "q2_stores_by_locality": q2_stores_by_locality,
    "q3_sales_by_month": q3_sales_by_month,
    "q4_online_vs_offline": q4_online_vs_offline,
    "q5_sales_by_store_type": q5_sales_by_store_type,
    "q6_sales_by_year_month": q6_sales_by_year_month,
    "q7_staff_by_country": q7_staff_by_country,
    "q8_german_store_types": q8_german_store_types,
    "q9_sale_frequency": q9_sale_frequency,
}
