"""The four reporting views as SQL text, for a catalog that keeps them; see ``views`` for the same plans."""

from __future__ import annotations

from starledger.plans.views import COUNTRY_NAMES

_SALE = "CAST(p.product_price AS DECIMAL(12, 2)) * o.product_quantity"
_SOLD = """{database}.orders_table o
    JOIN {database}.dim_product p ON p.product_key = o.product_key
    JOIN {database}.dim_date_times d ON d.date_key = o.date_key"""
_STORES = "JOIN {database}.dim_store_details s ON s.store_key = o.store_key"
_NAMES = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in COUNTRY_NAMES.items())
_CODES = ", ".join(f"'{code}'" for code in COUNTRY_NAMES)

STORED_VIEWS = {
    "customer_sales_ranked_view": f"""
        SELECT u.first_name, u.last_name, CAST(round({_SALE}, 2) AS DOUBLE) AS sales, d.day, d.month, d.year, d.time_period
        FROM {_SOLD} JOIN {{database}}.dim_users u ON u.user_key = o.user_key
        ORDER BY sales DESC NULLS FIRST""",
    "store_sales_breakdown_germany": f"""
        SELECT s.store_type, s.city, s.store_address, d.day, d.month, d.year,
            CAST(round(sum({_SALE}), 2) AS DOUBLE) AS total_sales
        FROM {_SOLD} {_STORES} WHERE s.country_code = 'DE'
        GROUP BY s.store_type, s.city, s.store_address, d.day, d.month, d.year
        ORDER BY total_sales DESC NULLS FIRST""",
    "store_sales_breakdown": f"""
        WITH sold AS (
            SELECT s.store_type, s.city, s.region, d.time_period, d.day, d.month, d.year, sum({_SALE}) AS amount
            FROM {_SOLD} {_STORES}
            GROUP BY s.store_type, s.city, s.region, d.time_period, d.day, d.month, d.year, p.product_price, o.product_quantity)
        SELECT store_type, city, region, time_period, day, month, year, CAST(round(amount, 2) AS DOUBLE) AS total_sales,
            round(CAST(amount AS DOUBLE) / CAST((SELECT sum(amount) FROM sold) AS DOUBLE) * 100, 2) AS percentage_total
        FROM sold ORDER BY percentage_total DESC NULLS FIRST""",
    "store_view": f"""
        SELECT store_code, store_type, city, store_address, region, CASE country_code {_NAMES} END AS country_name,
            longitude, latitude, number_of_staff
        FROM {{database}}.dim_store_details WHERE country_code IN ({_CODES})""",
}
