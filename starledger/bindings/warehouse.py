"""Registered tables and audits of the loaded warehouse, next to the same tables in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from starledger.bindings.cleaning import CARDS, EVENTS, PRODUCTS, RUN_TS, STORES, USERS, class_of, kilograms, number, parsed_date
from starledger.bindings.pipelines import ORDERS
from starledger.bindings.registry import ORACLES, register
from starledger.bindings.tables import raw, raw_all
from starledger.operators import audits, joins
from starledger.operators.rows import JUNK_CARD_PROVIDERS
from starledger.plans.star import Star
from starledger.plans.warehouse import QUARANTINE_TABLE, REPORT_TABLE, load_warehouse
from starledger.session import scratch_path

def loaded(spark: SparkSession, sf_dir: str, quarantine: bool = False) -> tuple[Star, str]:
    """The warehouse of a folder, loaded now, and where it lies."""
    root = scratch_path(spark, "warehouse")
    return load_warehouse(raw_all(spark, sf_dir), raw(spark, sf_dir, "mapping"), RUN_TS, root, quarantine=quarantine), root


def _first(key: str, natural: str, table: str) -> str:
    return f"(SELECT {natural}, min({key}) AS {key} FROM {table} WHERE {natural} IS NOT NULL GROUP BY 1)"


WAREHOUSE = f"""
    WITH dim_users AS (SELECT user_key, user_uuid FROM ({ORACLES['clean_users']})
        UNION ALL SELECT -1, NULL UNION ALL SELECT 0, NULL),
    dim_store_details AS (SELECT store_key, store_code, country_code FROM ({ORACLES['clean_stores']})
        UNION ALL SELECT -1, NULL, NULL UNION ALL SELECT 0, NULL, NULL),
    dim_card_details AS (SELECT card_key, card_number FROM ({ORACLES['clean_cards']})
        UNION ALL SELECT -1, 'Not Applicable' UNION ALL SELECT 0, 'Unknown'),
    dim_date_times AS (SELECT date_key, date_uuid FROM ({ORACLES['clean_date_times']})
        UNION ALL SELECT -1, NULL UNION ALL SELECT 0, NULL),
    dim_product AS (SELECT product_key, product_code FROM ({ORACLES['clean_products']})
        UNION ALL SELECT -1, NULL UNION ALL SELECT 0, NULL),
    dim_currency_conversion AS (
        SELECT currency_conversion_key, currency_code FROM ({ORACLES['clean_rates']})
        WHERE currency_code IN ('USD', 'GBP', 'EUR')
        UNION ALL SELECT -1, NULL UNION ALL SELECT 0, NULL),
    dim_currency AS (
        SELECT c.currency_key, r.currency_conversion_key, c.currency_code, c.country_code, c.country_name, c.currency_symbol
        FROM ({ORACLES['clean_currency']}) c
            LEFT JOIN {_first('currency_conversion_key', 'currency_code', 'dim_currency_conversion')} r
                ON c.currency_code = r.currency_code
        WHERE c.country_code IN ('US', 'GB', 'DE')
        UNION ALL SELECT -1, -1, 'Not Applicable', NULL, NULL, NULL
        UNION ALL SELECT 0, 0, 'Unknown', NULL, NULL, NULL),
    orders_table AS (
        SELECT o.c0 AS order_key, o.c2 AS date_uuid, o.c5 AS user_uuid, card_key, date_key, product_key, s.store_key,
            user_key, currency_key, o.c6 AS card_number, o.c7 AS store_code, o.c8 AS product_code,
            CAST(o.c10 AS SMALLINT) AS product_quantity, s.country_code
        FROM ({ORDERS}) o
            LEFT JOIN {_first('card_key', 'card_number', 'dim_card_details')} c ON o.c6 = c.card_number
            LEFT JOIN {_first('date_key', 'date_uuid', 'dim_date_times')} d ON o.c2 = d.date_uuid
            LEFT JOIN {_first('product_key', 'product_code', 'dim_product')} p ON o.c8 = p.product_code
            LEFT JOIN (SELECT * FROM dim_store_details WHERE store_code IS NOT NULL) s ON o.c7 = s.store_code
            LEFT JOIN {_first('user_key', 'user_uuid', 'dim_users')} u ON o.c5 = u.user_uuid
            LEFT JOIN (SELECT country_code, currency_key FROM dim_currency WHERE country_code IS NOT NULL) m
                ON s.country_code = m.country_code)
    """


@register("warehouse_fact", WAREHOUSE + "SELECT * FROM orders_table")
def warehouse_fact(spark, sf_dir):
    """Every row of the loaded fact, with all keys."""
    return loaded(spark, sf_dir)[0].orders


@register("warehouse_dim_currency", WAREHOUSE + "SELECT * FROM dim_currency")
def warehouse_dim_currency(spark, sf_dir):
    return spark.read.parquet(f"{loaded(spark, sf_dir)[1]}/dim_currency").select(
        "currency_key", "currency_conversion_key", "currency_code", "country_code", "country_name", "currency_symbol"
    )


@register("warehouse_dim_product", f"""
    SELECT product_key, ean, product_name, product_price, weight, {class_of('weight')} AS weight_class, category,
        date_added, uuid, CASE availability WHEN 'Still_avaliable' THEN 'True' WHEN 'Removed' THEN 'False' END
            AS availability, product_code
    FROM ({ORACLES['clean_products']})
    UNION ALL SELECT -1, 'Not Applicable', NULL, NULL, NULL, 'Unknown', NULL, NULL, NULL, NULL, NULL
    UNION ALL SELECT 0, 'Unknown', NULL, NULL, NULL, 'Unknown', NULL, NULL, NULL, NULL, NULL""")
def warehouse_dim_product(spark, sf_dir):
    return spark.read.parquet(f"{loaded(spark, sf_dir)[1]}/dim_product")


def _dropped(table: str, column: str, source: str, keep: str, shown: str = "count(*) FILTER ({failed}) AS rows", more: str = "") -> str:
    failed = f"NOT coalesce({keep}, FALSE)"
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, 'dropped row' AS reason, "
        f"{shown.format(failed=failed)} FROM ({source}) {more.format(failed=failed)}"
    )


_JUNK = ", ".join(f"'{p}'" for p in JUNK_CARD_PROVIDERS)


RULES = [
    ("land_user_data", "date_of_birth", USERS, f"{parsed_date('date_of_birth')} IS NOT NULL"),
    ("land_user_data", "join_date", USERS, f"{parsed_date('join_date')} IS NOT NULL"),
    ("land_store_data", "opening_date", STORES, f"{parsed_date('c7')} IS NOT NULL"),
    ("land_card_data", "card_provider", CARDS, f"card_provider IS NULL OR card_provider NOT IN ({_JUNK})"),
    ("land_card_data", "date_payment_confirmed", CARDS, f"{parsed_date('date_payment_confirmed')} IS NOT NULL"),
    ("land_product_data", "availability", PRODUCTS, "removed IS NULL OR removed IN ('Still_avaliable', 'Removed')"),
    ("land_product_data", "weight", PRODUCTS, f"{kilograms('weight')} IS NOT NULL"),
    ("land_date_times", "month", EVENTS, f"{number('month')} IS NOT NULL"),
]


@register("load_rejects", "SELECT * FROM (" + " UNION ALL ".join(_dropped(*rule) for rule in RULES) + ") WHERE rows > 0")
def load_rejects(spark, sf_dir):
    """What the load counted: no value misfits its type here, but rules drop rows."""
    return spark.read.parquet(f"{loaded(spark, sf_dir)[1]}/{REPORT_TABLE}").where("rows > 0")


@register("load_rejected_rows", " UNION ALL ".join(
    _dropped(*rule, shown=f"{'c0' if rule[0] == 'land_store_data' else 'position'} AS place", more="WHERE {failed}")
    for rule in RULES))
def load_rejected_rows(spark, sf_dir):
    """The rows that the load left out, by their place in the source."""
    rows = spark.read.parquet(f"{loaded(spark, sf_dir, quarantine=True)[1]}/{QUARANTINE_TABLE}")
    return rows.drop("row")


TABLES = {
    "dim_users": ("users", "user_key"),
    "dim_store_details": ("store", "store_key"),
    "dim_card_details": ("card", "card_key"),
    "dim_product": ("product", "product_key"),
    "dim_date_times": ("date_times", "date_key"),
    "dim_currency": ("currency", "currency_key"),
    "dim_currency_conversion": ("currency_conversion", "currency_conversion_key"),
    "orders_table": ("orders", "order_key"),
}
_PK = (
    "SELECT '{t}' AS table_name, count(*) FILTER (k IS NOT NULL AND n > 1) AS duplicate_keys, "
    "CAST(coalesce(sum(n) FILTER (k IS NULL), 0) AS BIGINT) AS null_rows "
    "FROM (SELECT {k} AS k, count(*) AS n FROM {t} GROUP BY 1)"
)


@register("audit_pk_loaded", WAREHOUSE + " UNION ALL ".join(_PK.format(t=t, k=k) for t, (_, k) in TABLES.items()))
def audit_pk_loaded(spark, sf_dir):
    """The keys of all eight loaded tables."""
    star = loaded(spark, sf_dir)[0]
    return audits.audit_pk_summary({t: (getattr(star, a), k) for t, (a, k) in TABLES.items()})


REFERENCES = {
    "card_key": "dim_card_details", "date_key": "dim_date_times", "product_key": "dim_product",
    "store_key": "dim_store_details", "user_key": "dim_users", "currency_key": "dim_currency",
}
_FK = (
    "SELECT '{k}' AS fk, count(DISTINCT o.{k}) FILTER (d.{k} IS NULL) AS orphan_keys, "
    "count(*) FILTER (d.{k} IS NULL) AS orphan_rows "
    "FROM {f} o LEFT JOIN {t} d ON o.{k} = d.{k} WHERE o.{k} IS NOT NULL"
)


@register("audit_fk_loaded", WAREHOUSE + " UNION ALL ".join(
    [_FK.format(k=k, t=t, f="orders_table") for k, t in REFERENCES.items()]
    + [_FK.format(k="currency_conversion_key", t="dim_currency_conversion", f="dim_currency")]))
def audit_fk_loaded(spark, sf_dir):
    """The six references of the loaded fact, and that of the currencies to their rates."""
    star = loaded(spark, sf_dir)[0]
    fact = audits.audit_fk(star.orders, {k: (getattr(star, TABLES[t][0]), k) for k, t in REFERENCES.items()})
    rate = "currency_conversion_key"
    return fact.unionByName(audits.audit_fk(star.currency, {rate: (star.currency_conversion, rate)}))


_KEYS = ["card_key", "date_key", "product_key", "store_key", "user_key"]


@register("unresolved_loaded", WAREHOUSE + " UNION ALL ".join(
    f"SELECT '{k}' AS key_column, count(*) FILTER (coalesce({k}, 0) = 0) AS unresolved FROM orders_table" for k in _KEYS))
def unresolved_loaded(spark, sf_dir):
    """Sales of the loaded fact that no dimension row was found for, by key."""
    return audits.unresolved_key_counts(joins.fill_unknown_keys(loaded(spark, sf_dir)[0].orders, _KEYS), _KEYS)
