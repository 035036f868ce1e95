"""Registered dataset pipelines and surrogate keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from starledger.bindings.cleaning import (
    CARDS, EVENTS, MAPPING, PRODUCTS, RATES, RUN_TS, STORES, USERS,
    kilograms, number, parsed_date,
)
from starledger.bindings.registry import register
from starledger.bindings.tables import raw, raw_all, raw_sql, table
from starledger.operators.keys import key_dense, key_ordinal
from starledger.operators.rows import JUNK_CARD_PROVIDERS
from starledger.plans import pipelines
from starledger.plans.questions import q8_german_store_types
from starledger.plans.warehouse import load_warehouse
from starledger.session import scratch_path


@register("key_dense", """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_key
    FROM orders WHERE o_orderstatus <> 'F'""")
def key_dense_query(spark, sf_dir):
    kept = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderdate")
    return key_dense(kept, ["o_orderdate", "o_orderkey"], "order_key").drop("o_orderdate")


@register("key_ordinal", """
    SELECT o_orderkey, order_key FROM (
        SELECT o_orderkey, o_orderstatus,
            row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_key FROM orders)
    WHERE o_orderstatus <> 'F'""")
def key_ordinal_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    rules = {"status": F.col("o_orderstatus") != "F"}
    keyed = key_ordinal(orders, ["o_orderdate", "o_orderkey"], "order_key", rules)
    return keyed.select("o_orderkey", "order_key")


@register("fact_order_key", """
    SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber,
        l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
        l_linestatus, l_shipdate) AS order_key
    FROM lineitem""")
def fact_order_key(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    order = [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ]
    return key_dense(items, order, "order_key").select(
        "l_orderkey", "l_linenumber", "l_partkey", "order_key"
    )


@register("clean_users", f"""
    SELECT row_number() OVER (ORDER BY position) AS user_key, first_name, last_name,
        {parsed_date('date_of_birth')} AS date_of_birth, company, email_address, address, country,
        country_code, phone_number, {parsed_date('join_date')} AS join_date, user_uuid
    FROM ({USERS}) WHERE {parsed_date('date_of_birth')} IS NOT NULL
        AND {parsed_date('join_date')} IS NOT NULL""")
def clean_users(spark, sf_dir):
    return pipelines.clean_users(raw(spark, sf_dir, "users"), "position")


@register("clean_stores", f"""
    SELECT row_number() OVER (ORDER BY c0) AS store_key, c1 AS store_address,
        {number('c2')} AS longitude, {number('c9')} AS latitude, c4 AS city, c5 AS store_code,
        CAST(regexp_replace(c6, '[^0-9]', '', 'g') AS SMALLINT) AS number_of_staff,
        {parsed_date('c7')} AS opening_date, c8 AS store_type, c10 AS country_code,
        CASE c11 WHEN 'eeEurope' THEN 'Europe' WHEN 'eeAmerica' THEN 'America' ELSE c11 END AS region
    FROM ({STORES}) WHERE {parsed_date('c7')} IS NOT NULL""")
def clean_stores(spark, sf_dir):
    return pipelines.clean_stores(raw(spark, sf_dir, "stores"))


CLEAN_CARDS = f"""
    SELECT position + 1 AS card_key, regexp_replace(card_number, '[^0-9]', '', 'g') AS card_number,
        expiry_date, card_provider, {parsed_date('date_payment_confirmed')} AS date_payment_confirmed
    FROM ({CARDS}) WHERE {parsed_date('date_payment_confirmed')} IS NOT NULL
        AND (card_provider IS NULL OR card_provider NOT IN ({
            ', '.join(f"'{p}'" for p in JUNK_CARD_PROVIDERS)}))"""


@register("clean_cards", CLEAN_CARDS)
def clean_cards(spark, sf_dir):
    return pipelines.clean_cards(raw(spark, sf_dir, "cards"), "position")


@register("clean_cards_dense_position", CLEAN_CARDS)
def clean_cards_dense_position(spark, sf_dir):
    return pipelines.clean_cards(raw(spark, sf_dir, "cards"), "position", dense_position=True)


ORDERS = raw_sql("orders", False).replace("{lineitem}", "lineitem").replace("{orders}", "orders")


@register("clean_orders", f"""
    SELECT c0 AS order_key, c2 AS date_uuid, c5 AS user_uuid, CAST(NULL AS BIGINT) AS card_key,
        CAST(NULL AS BIGINT) AS date_key, CAST(NULL AS BIGINT) AS product_key,
        CAST(NULL AS BIGINT) AS store_key, CAST(NULL AS BIGINT) AS user_key,
        CAST(NULL AS BIGINT) AS currency_key, c6 AS card_number, c7 AS store_code,
        c8 AS product_code, c10 AS product_quantity, CAST(NULL AS VARCHAR) AS country_code
    FROM ({ORDERS})""")
def clean_orders(spark, sf_dir):
    return pipelines.clean_orders(raw(spark, sf_dir, "orders"))


@register("clean_date_times", f"""
    SELECT position + 1 AS date_key, date_uuid, CAST(day AS INT) AS day, CAST(month AS INT) AS month,
        CAST(year AS INT) AS year, timestamp,
        strftime(make_date(CAST(year AS INT), CAST(month AS INT), CAST(day AS INT)), '%Y-%m-%d')
            AS full_date, time_period
    FROM ({EVENTS}) WHERE {number('month')} IS NOT NULL""")
def clean_date_times(spark, sf_dir):
    return pipelines.clean_date_times(raw(spark, sf_dir, "date_times"), "position")


@register("clean_products", f"""
    SELECT position + 1 AS product_key, ean, product_name,
        CAST(replace(product_price, '£', '') AS DOUBLE) AS product_price, kg AS weight,
        CAST(NULL AS VARCHAR) AS weight_class, category,
        CAST(try_strptime(date_added, '%Y-%m-%d') AS DATE) AS date_added, uuid,
        removed AS availability, product_code
    FROM (SELECT *, {kilograms('weight')} AS kg FROM ({PRODUCTS}))
    WHERE kg IS NOT NULL AND (removed IS NULL OR removed IN ('Still_avaliable', 'Removed'))""")
def clean_products(spark, sf_dir):
    return pipelines.clean_products(raw(spark, sf_dir, "products"), "position")


@register("clean_currency", """
    SELECT row_number() OVER (ORDER BY position) AS currency_key,
        CAST(NULL AS BIGINT) AS currency_conversion_key, currency_code, country_code, country_name,
        currency_symbol FROM (""" + raw_sql("currency", False).replace("{supplier}", "supplier") + ")")
def clean_currency(spark, sf_dir):
    return pipelines.clean_currency(raw(spark, sf_dir, "currency"), "position")


@register("clean_rates", f"""
    WITH rates AS (
        SELECT min(position) AS position, currency_name, conversion_rate, conversion_rate_percentage
        FROM ({RATES}) GROUP BY ALL),
    coded AS (
        SELECT rates.*, m.code AS currency_code FROM rates
            LEFT JOIN ({MAPPING}) m ON currency_name = m.name
        UNION ALL SELECT -1, 'British Pound', '1.000000', '1.000000', 'GBP')
    SELECT row_number() OVER (ORDER BY position) AS currency_conversion_key, currency_name,
        currency_code, conversion_rate, conversion_rate_percentage, '{RUN_TS}' AS last_updated
    FROM coded""")
def clean_rates(spark, sf_dir):
    rates = raw(spark, sf_dir, "currency_conversion")
    return pipelines.clean_rates(rates, raw(spark, sf_dir, "mapping"), RUN_TS, "position")


@register("warehouse_end_to_end", f"""
    WITH stores AS (SELECT * FROM ({STORES}) WHERE {parsed_date('c7')} IS NOT NULL),
    products AS (
        SELECT *, CAST(replace(product_price, '£', '') AS DECIMAL(12, 2)) AS price FROM ({PRODUCTS})
        WHERE {kilograms('weight')} IS NOT NULL
            AND (removed IS NULL OR removed IN ('Still_avaliable', 'Removed')))
    SELECT CAST(round(sum(price * CAST(o.c10 AS BIGINT)), 2) AS DOUBLE) AS total_sales,
        s.c8 AS store_type, s.c10 AS country_code
    FROM ({ORDERS}) o JOIN stores s ON o.c7 = s.c5 JOIN products p ON o.c8 = p.product_code
    WHERE s.c10 = 'DE' GROUP BY ALL""")
def warehouse_end_to_end(spark, sf_dir):
    """Raw data through cleaning, three layers, key resolution and the fact, then question 8."""
    star = load_warehouse(
        raw_all(spark, sf_dir),
        raw(spark, sf_dir, "mapping"),
        RUN_TS,
        scratch_path(spark, "warehouse"),
    )
    return q8_german_store_types(star)
