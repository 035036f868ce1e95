"""Registered cleaning, projection and filter operators, over dirty text made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starledger.bindings.registry import register
from starledger.bindings.tables import dirty_date, oracle_text, raw, raw_sql, run_sql, table
from starledger.functions.dates import clean_dates, make_full_date, parse_date_uniform
from starledger.functions.goods import availability_to_bool, weight_class, weight_to_kg
from starledger.functions.numbers import revenue, strip_symbol
from starledger.functions.text import concat_skip_null, digits_only
from starledger.operators import columns as cols, rows
from starledger.operators.skew import attach
from starledger.schemas import LAYOUTS, alter_types, enforce_schema, schema_rejects

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(text: str) -> str:
    """Oracle text of the strict text-to-number rule."""
    return f"CASE WHEN regexp_matches({text}, '{NUMBER}') THEN try_cast(trim({text}) AS DOUBLE) END"


def parsed_date(text: str) -> str:
    formats = "['%Y-%m-%d', '%Y/%m/%d', '%Y %B %d', '%B %Y %d', '%m/%d/%Y']"
    return f"CAST(try_strptime({text}, {formats}) AS DATE)"


def kilograms(text: str) -> str:
    pack = number(f"split_part({text}, ' x ', 1)") + " * " + number(
        f"left(split_part({text}, ' x ', 2), -1)"
    )
    bare = f"trim(trim(replace(replace({text}, '.', ''), ' ', ''), 'g'), 'ml')"
    ounces = f"trim({text}, 'oz')"
    return f"""CASE WHEN contains({text}, 'kg') THEN {number(f"trim({text}, 'kg')")}
        WHEN contains({text}, ' x ') THEN ({pack})
        WHEN contains({text}, 'g') OR contains({text}, 'ml') THEN ({number(bare)}) / 1000
        WHEN contains({text}, 'oz') THEN round(({number(ounces)}) * 0.028349523, 2) END"""


def class_of(kg: str) -> str:
    return f"""CASE WHEN {kg} < 2 THEN 'Light' WHEN {kg} < 40 THEN 'Mid_Sized'
        WHEN {kg} < 140 THEN 'Heavy' WHEN {kg} >= 140 THEN 'Truck_Required' ELSE 'Unknown' END"""


def order_dates(spark: bool) -> str:
    text = dirty_date("CAST(o_orderdate AS DATE)", "o_orderkey", spark)
    return f"SELECT o_orderkey, {text} AS text FROM {{orders}}"


@register("clean_dates", f"""
    SELECT o_orderkey, text, {parsed_date('text')} AS cleaned
    FROM ({oracle_text(order_dates(False))})""")
def clean_dates_query(spark, sf_dir):
    source = run_sql(spark, sf_dir, order_dates(True))
    return source.withColumn("cleaned", clean_dates(F.col("text")))


# Texts that no fixed layout reads, as parts of Spark and of oracle patterns around the date d, and what they mean.
_SUFFIX = (
    "CASE WHEN day(d) IN (11, 12, 13) THEN 'th' WHEN day(d) % 10 = 1 THEN 'st' WHEN day(d) % 10 = 2 THEN 'nd' "
    "WHEN day(d) % 10 = 3 THEN 'rd' ELSE 'th' END"
)
_SWAPPED = "CASE WHEN day(d) > 12 THEN d ELSE make_date(year(d), CAST(day(d) AS INT), CAST(month(d) AS INT)) END"
_MONTH = "make_date(year(d), month(d), 1)"
LENIENT = [
    ([("d", "%-d"), _SUFFIX, (" MMMM yyyy", " %B %Y")], "d"),
    ([("yyyy.MM.dd", "%Y.%m.%d")], "d"),
    ([("dd-MMM-yyyy", "%d-%b-%Y")], "d"),
    ([("EEEE, MMMM d, yyyy", "%A, %B %-d, %Y")], "d"),
    ([("M/d/yy", "%-m/%-d/%y")], "d"),
    ([("MMMM yyyy", "%B %Y")], _MONTH),
    ([("yyyy-MM", "%Y-%m")], _MONTH),
    ([("d.M.yyyy", "%-d.%-m.%Y")], _SWAPPED),
    ([("MMM. d, yyyy", "%b. %-d, %Y")], "d"),
    ([("yyyyMMdd", "%Y%m%d"), "'T1030'"], "d"),
    ([("d", "%-d"), "' of '", ("MMMM, yyyy", "%B, %Y"), "' 10:30 pm'"], "d"),
    ([("yyyy, MMM d", "%Y, %b %-d")], "d"),
    (["'the '", ("d MMMM yyyy", "%-d %B %Y")], "NULL"),
    ([("MMMM d", "%B %-d")], "NULL"),
    (["'31/31/'", ("yyyy", "%Y")], "NULL"),
    ([("EEE d MMM yyyy", "%a %-d %b %Y"), "' 5pm'"], "d"),
]


def lenient_texts(spark: bool) -> str:
    """(o_orderkey, d, text): dates in the layouts above, by turns."""
    def shown(part):
        if isinstance(part, str):
            return part
        return f"date_format(d, '{part[0]}')" if spark else f"strftime(d, '{part[1]}')"

    cases = " ".join(f"WHEN {n} THEN {' || '.join(shown(p) for p in parts)}" for n, (parts, _) in enumerate(LENIENT))
    days = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM {orders}"
    return f"SELECT o_orderkey, d, CASE o_orderkey % {len(LENIENT)} {cases} END AS text FROM ({days})"


_MEANT = " ".join(f"WHEN {n} THEN {meant}" for n, (_, meant) in enumerate(LENIENT))


@register("clean_dates_lenient", f"""
    SELECT o_orderkey, text, CAST(CASE o_orderkey % {len(LENIENT)} {_MEANT} END AS DATE) AS cleaned
    FROM ({oracle_text(lenient_texts(False))})""")
def clean_dates_lenient_query(spark, sf_dir):
    source = run_sql(spark, sf_dir, lenient_texts(True))
    return source.select("o_orderkey", "text", clean_dates(F.col("text")).alias("cleaned"))


@register("parse_date_uniform", f"""
    SELECT o_orderkey, CAST(try_strptime(text, '%Y-%m-%d') AS DATE) AS parsed
    FROM ({oracle_text(order_dates(False))})""")
def parse_date_uniform_query(spark, sf_dir):
    source = run_sql(spark, sf_dir, order_dates(True))
    return source.select("o_orderkey", parse_date_uniform(F.col("text")).alias("parsed"))


@register("make_full_date", """
    SELECT o_orderkey, strftime(make_date(year(o_orderdate), month(o_orderdate),
        CASE WHEN o_orderkey % 50 <> 3 THEN day(o_orderdate) END), '%Y-%m-%d') AS full_date
    FROM orders""")
def make_full_date_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    day = F.when(F.col("o_orderkey") % 50 == 3, 32).otherwise(F.day("o_orderdate"))
    full = make_full_date(F.year("o_orderdate"), F.month("o_orderdate"), day)
    return orders.select("o_orderkey", full.alias("full_date"))


PRODUCTS = raw_sql("products", False).replace("{part}", "part")


@register("weight_to_kg", f"SELECT product_code, weight, {kilograms('weight')} AS kg FROM ({PRODUCTS})")
def weight_to_kg_query(spark, sf_dir):
    products = raw(spark, sf_dir, "products")
    return products.select("product_code", "weight", weight_to_kg(F.col("weight")).alias("kg"))


@register("weight_class", f"""
    SELECT product_code, {class_of('kg')} AS weight_class
    FROM (SELECT product_code, {kilograms('weight')} AS kg FROM ({PRODUCTS}))""")
def weight_class_query(spark, sf_dir):
    products = raw(spark, sf_dir, "products")
    kg = weight_to_kg(F.col("weight"))
    return products.select("product_code", weight_class(kg).alias("weight_class"))


@register("strip_symbol", """
    SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(12, 2)) AS DOUBLE) AS price FROM part""")
def strip_symbol_query(spark, sf_dir):
    products = raw(spark, sf_dir, "products")
    return products.select(
        F.col("position").alias("p_partkey"), strip_symbol(F.col("product_price")).alias("price")
    )


@register("availability_to_bool", f"""
    SELECT product_code, CASE removed WHEN 'Removed' THEN FALSE WHEN 'Still_avaliable' THEN TRUE END
        AS availability FROM ({PRODUCTS})""")
def availability_to_bool_query(spark, sf_dir):
    products = raw(spark, sf_dir, "products")
    return products.select("product_code", availability_to_bool(F.col("removed")).alias("availability"))


CARDS = raw_sql("cards", False).replace("{customer}", "customer")


@register("digits_only", f"""
    SELECT position, coalesce(regexp_replace(card_number, '\\D', '', 'g'), '') AS card_number
    FROM ({CARDS})""")
def digits_only_query(spark, sf_dir):
    cards = raw(spark, sf_dir, "cards")
    return cards.select("position", digits_only(F.col("card_number")).alias("card_number"))


@register("deny_list_filter", f"""
    SELECT position, card_provider FROM ({CARDS})
    WHERE card_provider IS NULL OR card_provider NOT IN ({
        ', '.join(f"'{p}'" for p in rows.JUNK_CARD_PROVIDERS)})""")
def deny_list_filter_query(spark, sf_dir):
    cards = raw(spark, sf_dir, "cards").select("position", "card_provider")
    return rows.deny_list_filter(cards, "card_provider", rows.JUNK_CARD_PROVIDERS)


@register("status_filter", f"""
    SELECT product_code, removed FROM ({PRODUCTS})
    WHERE removed IS NULL OR removed IN ('Still_avaliable', 'Removed')""")
def status_filter_query(spark, sf_dir):
    return rows.status_filter(raw(spark, sf_dir, "products").select("product_code", "removed"), "removed")


@register("status_filter_last_seen", """
    WITH last AS (SELECT o_orderpriority AS value FROM orders GROUP BY 1
        ORDER BY min(o_orderkey) DESC LIMIT 3)
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority NOT IN (SELECT value FROM last)""")
def status_filter_last_seen(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return rows.drop_last_seen_values(orders, "o_orderpriority", "o_orderkey", 3)


EVENTS = raw_sql("date_times", False).replace("{orders}", "orders")


@register("numeric_mask_filter", f"""
    SELECT date_uuid, CAST({number('month')} AS INT) AS month FROM ({EVENTS})
    WHERE {number('month')} IS NOT NULL""")
def numeric_mask_filter_query(spark, sf_dir):
    events = raw(spark, sf_dir, "date_times").select("date_uuid", "month")
    return rows.numeric_mask_filter(events, "month")


STORES = raw_sql("stores", False).replace("{supplier}", "supplier")


@register("coerce_numeric", f"SELECT c0, {number('c2')} AS longitude FROM ({STORES})")
def coerce_numeric_query(spark, sf_dir):
    stores = raw(spark, sf_dir, "stores").select("c0", F.col("c2").alias("longitude"))
    return cols.coerce_numeric(stores, "longitude")


@register("replace_values", f"""
    SELECT c0, CASE c11 WHEN 'eeEurope' THEN 'Europe' WHEN 'eeAmerica' THEN 'America' ELSE c11 END
        AS region FROM ({STORES})""")
def replace_values_query(spark, sf_dir):
    stores = raw(spark, sf_dir, "stores").select("c0", F.col("c11").alias("region"))
    return cols.replace_values(stores, cols.REGION_FIXES)


@register("repair_codes", f"""
    SELECT c0, CAST(regexp_replace(c6, '[^0-9]', '', 'g') AS SMALLINT) AS number_of_staff
    FROM ({STORES})""")
def repair_codes_query(spark, sf_dir):
    stores = raw(spark, sf_dir, "stores").select("c0", F.col("c6").alias("number_of_staff"))
    return cols.repair_codes(stores, "number_of_staff", cols.STAFF_FIXES, "smallint")


USERS = raw_sql("users", False).replace("{customer}", "customer")


@register("drop_null_rows", f"""
    SELECT position FROM ({USERS}) WHERE {parsed_date('date_of_birth')} IS NOT NULL""")
def drop_null_rows_query(spark, sf_dir):
    users = raw(spark, sf_dir, "users").withColumn("date_of_birth", clean_dates(F.col("date_of_birth")))
    return rows.drop_null_rows(users, ["date_of_birth"]).select("position")


@register("dedupe_rows", """
    SELECT l_partkey, l_suppkey, l_returnflag, min(l_orderkey) AS first_order FROM lineitem
    GROUP BY ALL""")
def dedupe_rows_query(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_returnflag", F.col("l_orderkey").alias("first_order")
    )
    return rows.dedupe_rows(items, "first_order")


@register("distinct_values", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_values(spark, sf_dir):
    return rows.dedupe_rows(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag"))


@register("subset_filter", f"""
    SELECT position, country_code, currency_code FROM ({
        raw_sql('currency', False).replace('{supplier}', 'supplier')})
    WHERE country_code IN ('US', 'GB', 'DE')""")
def subset_filter_query(spark, sf_dir):
    currency = raw(spark, sf_dir, "currency").select("position", "country_code", "currency_code")
    return rows.subset_filter(currency, ["US", "GB", "DE"])


RATES = raw_sql("currency_conversion", False).replace("{part}", "part")
MAPPING = raw_sql("mapping", False).replace("{part}", "part")
RUN_TS = "2024-11-30 13:55:07"


@register("map_values", f"""
    SELECT r.position, r.currency_name, m.code AS currency_code
    FROM ({RATES}) r LEFT JOIN ({MAPPING}) m ON r.currency_name = m.name""")
def map_values_query(spark, sf_dir):
    rates = raw(spark, sf_dir, "currency_conversion").select("position", "currency_name")
    return cols.map_values(rates, "currency_name", raw(spark, sf_dir, "mapping"), to="currency_code")


@register("map_values_literal", f"""
    SELECT product_code, CASE removed WHEN 'Still_avaliable' THEN 'True' WHEN 'Removed' THEN 'False'
        END AS availability FROM ({PRODUCTS})""")
def map_values_literal(spark, sf_dir):
    products = raw(spark, sf_dir, "products").select("product_code", F.col("removed").alias("availability"))
    return cols.map_values(products, "availability", cols.AVAILABILITY_TEXTS)


@register("run_timestamp", f"SELECT position, currency_name, '{RUN_TS}' AS last_updated FROM ({RATES})")
def run_timestamp(spark, sf_dir):
    rates = raw(spark, sf_dir, "currency_conversion").select("position", "currency_name")
    return cols.stamp_last_updated(rates, RUN_TS)


@register("fill_all_nulls", f"""
    SELECT position, coalesce(currency_name, '{RUN_TS}') AS currency_name,
        coalesce(conversion_rate, '{RUN_TS}') AS conversion_rate FROM ({RATES})""")
def fill_all_nulls_query(spark, sf_dir):
    rates = raw(spark, sf_dir, "currency_conversion").select(
        "position", "currency_name", "conversion_rate"
    )
    return cols.fill_all_nulls(rates, RUN_TS)


@register("prepend_literal_row", f"""
    SELECT -1 AS position, 'British Pound' AS currency_name, '1.000000' AS conversion_rate
    UNION ALL SELECT position, currency_name, conversion_rate FROM ({RATES})""")
def prepend_literal_row_query(spark, sf_dir):
    rates = raw(spark, sf_dir, "currency_conversion").select(
        "position", "currency_name", "conversion_rate"
    )
    row = {"currency_name": "British Pound", "conversion_rate": "1.000000"}
    return rows.prepend_literal_row(rates, row, "position")


@register("default_members", """
    SELECT c_custkey + 1 AS user_key, c_mktsegment AS first_name, c_name AS last_name,
        c_nationkey AS nation FROM customer
    UNION ALL SELECT -1, 'Not Applicable', 'Not Applicable', NULL
    UNION ALL SELECT 0, 'Unknown', 'Unknown', NULL""")
def default_members_query(spark, sf_dir):
    users = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("user_key"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.col("c_nationkey").alias("nation"),
    )
    return rows.default_members(users, "dim_users")


@register("positional_rename", """
    SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
        c_mktsegment AS segment FROM customer""")
def positional_rename_query(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    short = ["key", "name", "nation", "segment"]
    return cols.positional_rename(customer, short, ["key", "name", "nation", "balance", "segment"])


@register("drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def drop_columns_query(spark, sf_dir):
    return cols.drop_columns(
        table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderdate", "o_orderpriority", "no_such"
    )


@register("reorder_columns", "SELECT c_mktsegment, c_custkey, c_name FROM customer")
def reorder_columns_query(spark, sf_dir):
    return cols.reorder_columns(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_custkey", "c_name"])


@register("add_null_columns", """
    SELECT s_suppkey, CAST(NULL AS BIGINT) AS card_key, CAST(NULL AS VARCHAR) AS weight_class
    FROM supplier""")
def add_null_columns_query(spark, sf_dir):
    stores = table(spark, sf_dir, "supplier").select("s_suppkey")
    return cols.add_null_columns(stores, {"card_key": "long", "weight_class": "string"})


@register("rename_column", "SELECT p_partkey, p_brand AS ean FROM part")
def rename_column(spark, sf_dir):
    quoted = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("EAN"))
    return quoted.withColumnRenamed("EAN", "ean")


@register("derive_expr", """
    SELECT l_orderkey, l_linenumber, CAST(CAST(p_retailprice AS DECIMAL(12, 2))
        * CAST(l_quantity AS BIGINT) AS DOUBLE) AS sales
    FROM lineitem JOIN part ON l_partkey = p_partkey""")
def derive_expr(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_partkey").alias("p_partkey")
    )
    prices = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    sales = revenue(F.col("p_retailprice"), F.col("l_quantity").cast("smallint")).cast("double")
    return attach(items, prices, "p_partkey", "inner").select(
        "l_orderkey", "l_linenumber", sales.alias("sales")
    )


@register("concat_skip_null", """
    SELECT o_orderkey, concat(o_orderpriority, '/',
        CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END) AS label FROM orders""")
def concat_skip_null_query(spark, sf_dir):
    status = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus"))
    label = concat_skip_null(F.col("o_orderpriority"), F.lit("/"), status)
    return table(spark, sf_dir, "orders").select("o_orderkey", label.alias("label"))


# Text columns for a typed load: some values fit their declared type and some do not.
LOOSE_SQL = """
    SELECT CAST(c_custkey AS STRING) AS user_key,
        CASE WHEN c_custkey % 10 = 0 THEN 'not-a-uuid' ELSE
            '00000000-0000-4000-8000-' || lpad(CAST(c_custkey AS STRING), 12, '0') END AS user_uuid,
        CASE WHEN c_custkey % 7 = 0 THEN 'soon' ELSE '2010-05-1' || CAST(c_custkey % 10 AS STRING)
            END AS join_date,
        c_name || c_name || c_name AS phone_number, c_mktsegment AS company
    FROM {customer}"""
STRICT_UUID = "regexp_full_match(user_uuid, '[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}')"


@register("enforce_schema", f"""
    SELECT try_cast(user_key AS BIGINT) AS user_key,
        CASE WHEN {STRICT_UUID} THEN user_uuid END AS user_uuid,
        try_cast(join_date AS DATE) AS join_date, phone_number, company
    FROM ({oracle_text(LOOSE_SQL)})""")
def enforce_schema_query(spark, sf_dir):
    return enforce_schema(run_sql(spark, sf_dir, LOOSE_SQL), LAYOUTS["users"])


@register("schema_rejects", f"""
    WITH loose AS ({oracle_text(LOOSE_SQL)})
    SELECT 'user_key' AS column_name, count(*) FILTER (try_cast(user_key AS BIGINT) IS NULL)
        AS rejected, 0 AS too_long FROM loose
    UNION ALL SELECT 'user_uuid', count(*) FILTER (NOT {STRICT_UUID}), 0 FROM loose
    UNION ALL SELECT 'join_date', count(*) FILTER (try_cast(join_date AS DATE) IS NULL), 0 FROM loose
    UNION ALL SELECT 'phone_number', 0, count(*) FILTER (length(phone_number) > 50) FROM loose
    UNION ALL SELECT 'company', 0, count(*) FILTER (length(company) > 255) FROM loose""")
def schema_rejects_query(spark, sf_dir):
    return schema_rejects(run_sql(spark, sf_dir, LOOSE_SQL), LAYOUTS["users"])


ALTER_SQL = """
    SELECT CAST(o_orderkey AS STRING) AS order_key,
        '00000000-0000-4000-A000-' || lpad(CAST(o_orderkey AS STRING), 12, '0') AS date_uuid,
        CAST(CAST(o_orderdate AS DATE) AS STRING) AS opening_date,
        CAST(o_custkey % 90 AS STRING) AS number_of_staff,
        CAST(o_totalprice AS STRING) AS longitude
    FROM {orders}"""


@register("alter_type_using", f"""
    SELECT CAST(order_key AS BIGINT) AS order_key, lower(date_uuid) AS date_uuid,
        CAST(opening_date AS DATE) AS opening_date,
        CAST(number_of_staff AS SMALLINT) AS number_of_staff, CAST(longitude AS DOUBLE) AS longitude
    FROM ({oracle_text(ALTER_SQL)})""")
def alter_type_using(spark, sf_dir):
    return alter_types(
        run_sql(spark, sf_dir, ALTER_SQL),
        {
            "order_key": "BIGINT",
            "date_uuid": "UUID",
            "opening_date": "DATE",
            "number_of_staff": "SMALLINT",
            "longitude": "FLOAT",
        },
    )
