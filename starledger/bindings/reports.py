"""Registered views and business questions."""

from __future__ import annotations

import re
import uuid
from functools import partial

from pyspark.sql import functions as F

from starledger.bindings.registry import ORACLES, register
from starledger.bindings.relations import half_up
from starledger.bindings.tables import DIM_OF, star, star_ctes
from starledger.plans.questions import QUESTIONS, sale_gaps
from starledger.plans.star import Star
from starledger.plans.view_sql import STORED_VIEWS
from starledger.plans.views import VIEWS
from starledger.schemas import FACT_TABLE
from starledger.session import scratch_path
from starledger.sources.sinks import create_stored_views, create_views, register_tables

SALE = "CAST(p.product_price AS DECIMAL(12, 2)) * CAST(o.product_quantity AS BIGINT)"
BY_KEYS = "orders_table o JOIN dim_product p ON p.product_key = o.product_key"
DATES = "JOIN dim_date_times d ON o.date_key = d.date_key"

SQL = {
    "q1_stores_by_country": star_ctes("store") + """
        SELECT country_code AS country, count(country_code) AS total_no_of_stores
        FROM dim_store_details WHERE country_code IN ('GB', 'DE', 'US') GROUP BY country_code""",
    "q2_stores_by_locality": star_ctes("store") + """
        SELECT city AS locality, count(city) AS total_no_of_stores
        FROM dim_store_details GROUP BY locality""",
    "q3_sales_by_month": star_ctes("orders", "product", "date_times") + f"""
        SELECT CAST(round(sum({SALE}), 2) AS DOUBLE) AS total_sales, d.month AS month_number
        FROM {BY_KEYS} {DATES} GROUP BY d.month""",
    "q4_online_vs_offline": star_ctes("orders") + f"""
        SELECT count(*) AS number_of_sales,
            CAST(sum(product_quantity) AS BIGINT) AS product_quantity_count,
            {half_up("count(*) * 10000", "sum(count(*)) OVER ()")} AS percentage_total,
            CASE WHEN store_code = 'WEB-1388012W' THEN 'Web' ELSE 'Offline' END AS location
        FROM orders_table GROUP BY location""",
    "q5_sales_by_store_type": star_ctes("orders", "product", "store") + f"""
        SELECT s.store_type, CAST(round(sum({SALE}), 2) AS DOUBLE) AS total_sales,
            {half_up("count(*) * 10000", "(SELECT count(*) FROM orders_table)")} AS percentage_total,
            count(*) AS count, (SELECT count(*) FROM orders_table) AS total_orders
        FROM orders_table o LEFT JOIN dim_product p ON o.product_code = p.product_code
            LEFT JOIN dim_store_details s ON o.store_code = s.store_code
        GROUP BY s.store_type""",
    "q6_sales_by_year_month": star_ctes("orders", "product", "date_times") + f"""
        SELECT CAST(round(sum({SALE}), 2) AS DOUBLE) AS total_sales, d.year, d.month
        FROM {BY_KEYS} {DATES} GROUP BY d.year, d.month""",
    "q7_staff_by_country": star_ctes("store") + """
        SELECT CAST(sum(number_of_staff) AS BIGINT) AS number_of_staff, country_code
        FROM dim_store_details WHERE country_code IS NOT NULL GROUP BY country_code""",
    "q8_german_store_types": star_ctes("orders", "product", "store") + f"""
        SELECT CAST(round(sum({SALE}), 2) AS DOUBLE) AS total_sales, s.store_type, s.country_code
        FROM dim_store_details s JOIN orders_table o ON s.store_key = o.store_key
            JOIN dim_product p ON o.product_key = p.product_key
        WHERE (SELECT c.country_code FROM dim_store_details c WHERE c.store_code = o.store_code)
            LIKE 'DE'
        GROUP BY s.store_type, s.country_code""",
    "customer_sales_ranked_view": star_ctes("orders", "product", "date_times", "users") + f"""
        SELECT u.first_name, u.last_name, CAST(round({SALE}, 2) AS DOUBLE) AS sales,
            d.day, d.month, d.year, d.time_period
        FROM {BY_KEYS} {DATES} JOIN orders b ON b.o_orderkey + 1 = o.date_key
            JOIN dim_users u ON u.user_key = b.o_custkey + 1""",
    "store_sales_breakdown_germany": star_ctes("orders", "product", "date_times", "store") + f"""
        SELECT s.store_type, s.city, s.store_address, d.day, d.month, d.year,
            CAST(round(sum({SALE}), 2) AS DOUBLE) AS total_sales
        FROM {BY_KEYS} {DATES} JOIN dim_store_details s ON s.store_key = o.store_key
        WHERE s.country_code LIKE 'DE'
        GROUP BY s.store_type, s.country_code, s.city, s.store_address, d.day, d.month, d.year""",
    "store_sales_breakdown": star_ctes("orders", "product", "date_times", "store") + f"""
        SELECT s.store_type, s.city, s.region, d.time_period, d.day, d.month, d.year,
            CAST(round(sum({SALE}), 2) AS DOUBLE) AS total_sales,
            round(CAST(sum({SALE}) AS DOUBLE)
                / CAST(sum(sum({SALE})) OVER () AS DOUBLE) * 100, 2) AS percentage_total
        FROM {BY_KEYS} {DATES} JOIN dim_store_details s ON s.store_key = o.store_key
        GROUP BY s.store_type, p.product_price, o.product_quantity, s.city, s.region,
            d.day, d.month, d.year, d.time_period""",
    "store_view": star_ctes("store") + """
        SELECT store_code, store_type, city, store_address, region,
            CASE country_code WHEN 'GB' THEN 'Great Britain' WHEN 'DE' THEN 'Germany'
                WHEN 'US' THEN 'United States' END AS country_name,
            longitude, latitude, number_of_staff
        FROM dim_store_details WHERE country_code IN ('GB', 'DE', 'US')""",
}

# The literal form of question 9: a LEAD over all sales.
GAPS = star_ctes("date_times") + """,
    instants AS (
        SELECT year, epoch_us(make_timestamp(year, month, day, 0, 0, 0.0))
            + CAST(split_part(timestamp, ':', 1) AS BIGINT) * 3600000000
            + CAST(split_part(timestamp, ':', 2) AS BIGINT) * 60000000
            + CAST(split_part(timestamp, ':', 3) AS BIGINT) * 1000000 AS instant
        FROM dim_date_times WHERE date_key >= 1),
    gaps AS (SELECT year, instant - lead(instant) OVER (ORDER BY instant DESC) AS gap FROM instants),
    means AS (
        SELECT year, CASE WHEN count(gap) > 0
            THEN CAST((2 * sum(gap) + count(gap)) // (2 * count(gap)) AS BIGINT) END AS mean_gap
        FROM gaps GROUP BY year)"""
SQL["q9_sale_frequency"] = GAPS + """
    SELECT year, concat('"Hours": ', mean_gap // 3600000000 % 24,
        ', "minutes" :', mean_gap // 60000000 % 60,
        ', "seconds" :', (mean_gap % 60000000 + 500000) // 1000000,
        ', "milliseconds" :', (mean_gap % 1000000 + 5000) // 10000) AS actual_time_taken
    FROM means ORDER BY mean_gap DESC NULLS FIRST LIMIT 5"""


def _bind(plan, **needs):
    return lambda spark, sf_dir: plan(star(spark, sf_dir, **needs))


NEEDS = {
    "q8_german_store_types": {"country": True},
    "customer_sales_ranked_view": {"users": True},
}
for _name, _plan in {**QUESTIONS, **VIEWS}.items():
    register(_name, SQL[_name])(_bind(_plan, **NEEDS.get(_name, {})))

register("avg_interval", GAPS + " SELECT year, mean_gap FROM means")(_bind(sale_gaps))


@register("create_view", star_ctes("store") + """
    SELECT CASE country_code WHEN 'GB' THEN 'Great Britain' WHEN 'DE' THEN 'Germany'
            WHEN 'US' THEN 'United States' END AS country_name,
        count(*) AS stores, CAST(sum(number_of_staff) AS BIGINT) AS staff
    FROM dim_store_details WHERE country_code IN ('GB', 'DE', 'US') GROUP BY 1""")
def create_view(spark, sf_dir):
    bound = star(spark, sf_dir)
    create_views({"store_view": lambda: VIEWS["store_view"](bound)})
    return spark.sql(
        """SELECT country_name, count(*) AS stores, sum(number_of_staff) AS staff
           FROM store_view GROUP BY country_name"""
    )


_SALES = f"CAST(round(sum({SALE}), 2) AS DOUBLE)"


@register("create_views_all", star_ctes("orders", "product", "date_times", "store", "users") + f"""
    SELECT 'customer_sales_ranked_view' AS view_name, count(*) AS rows, {_SALES} AS total
    FROM {BY_KEYS} {DATES} JOIN orders b ON b.o_orderkey + 1 = o.date_key
        JOIN dim_users u ON u.user_key = b.o_custkey + 1
    UNION ALL SELECT 'store_sales_breakdown_germany',
        count(DISTINCT (s.store_type, s.city, s.store_address, d.day, d.month, d.year)), {_SALES}
    FROM {BY_KEYS} {DATES} JOIN dim_store_details s ON s.store_key = o.store_key WHERE s.country_code = 'DE'
    UNION ALL SELECT 'store_sales_breakdown', count(DISTINCT (s.store_type, p.product_price, o.product_quantity,
        s.city, s.region, d.day, d.month, d.year, d.time_period)), {_SALES}
    FROM {BY_KEYS} {DATES} JOIN dim_store_details s ON s.store_key = o.store_key
    UNION ALL SELECT 'store_view', count(*), CAST(sum(number_of_staff) AS DOUBLE)
    FROM dim_store_details WHERE country_code IN ('GB', 'DE', 'US')""")
def create_views_all(spark, sf_dir):
    """All four views, created without hints and read by name: rows and sum of each."""
    bound = star(spark, sf_dir, users=True)
    create_views({name: partial(plan, bound) for name, plan in VIEWS.items()})
    amount = {"customer_sales_ranked_view": "sales", "store_view": "number_of_staff"}

    def summed(name):
        exact = f"CAST({amount.get(name, 'total_sales')} AS DECIMAL(18, 2))"
        return f"SELECT '{name}' AS view_name, count(*) AS rows, CAST(sum({exact}) AS DOUBLE) AS total FROM {name}"

    return spark.sql(" UNION ALL ".join(summed(name) for name in VIEWS))


@register("stored_views", ORACLES["create_views_all"])
def stored_views(spark, sf_dir):
    """The four views as SQL in the catalog, over tables of the star, read by another session: rows and sum of each."""
    database = f"star_{uuid.uuid4().hex}"
    store_views(spark, sf_dir, database)
    other = spark.newSession()
    amount = {"customer_sales_ranked_view": "sales", "store_view": "number_of_staff"}

    def summed(name):
        exact = f"CAST({amount.get(name, 'total_sales')} AS DECIMAL(18, 2))"
        return f"SELECT '{name}' AS view_name, count(*) AS rows, CAST(sum({exact}) AS DOUBLE) AS total FROM {database}.{name}"

    return other.sql(" UNION ALL ".join(summed(name) for name in STORED_VIEWS))


VIEW_COLUMNS = {
    "orders": ["product_key", "date_key", "store_key", "user_key", "product_quantity"],
    "product": ["product_key", "product_price"],
    "date_times": ["date_key", "day", "month", "year", "time_period"],
    "users": ["user_key", "first_name", "last_name"],
}


def store_views(spark, sf_dir, database):
    """Write the tables that the views read, and store both in the catalog."""
    bound, paths = star(spark, sf_dir, users=True), {}
    for part, name in {"orders": FACT_TABLE, **DIM_OF}.items():
        df = getattr(bound, part)
        paths[name] = scratch_path(spark, name)
        df.select(*VIEW_COLUMNS.get(part, df.columns)).write.parquet(paths[name])
    register_tables(spark, paths, database)
    create_stored_views(spark, STORED_VIEWS, database)


IMPOSSIBLE = re.sub(r"dim_date_times AS \(", "all_dates AS (", GAPS).replace(
    "instants AS (", "dim_date_times AS (SELECT * FROM all_dates WHERE date_key % 7 <> 3),\n    instants AS ("
)


@register("q9_impossible_dates", IMPOSSIBLE + " SELECT year, mean_gap FROM means")
def q9_impossible_dates(spark, sf_dir):
    """Every seventh sale has a 31 February, which the cleaning keeps with its year and without a date."""
    dates = star(spark, sf_dir).date_times
    odd = F.col("date_key") % 7 == 3
    dates = dates.withColumns({"month": F.when(odd, 2).otherwise(F.col("month")), "day": F.when(odd, 31).otherwise(F.col("day"))})
    return sale_gaps(Star(orders=None, date_times=dates))
