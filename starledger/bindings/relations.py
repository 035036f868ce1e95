"""Registered key resolution, joins, unions, aggregations, windows and audits."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F, types as T

from starledger.bindings.registry import ORACLES, register
from starledger.bindings.tables import (
    BUYER_SQL, oracle_text, star, star_ctes, table,
)
from starledger.functions.gaps import micros
from starledger.functions.numbers import money, percent_of_amount, percent_of_count, revenue
from starledger.operators import audits, joins
from starledger.operators.keys import number_rows
from starledger.operators.order import lead_rows, previous_value, sort_rows, top_k
from starledger.operators.rows import default_members, literal_rows, union_tables
from starledger.operators.skew import KeyProfile, attach, salted_join, unhinted
from starledger.session import scratch_path
from starledger.sources.sinks import load_bucketed

BUYERS = oracle_text(BUYER_SQL)

# Three-currency dimension and its rates; the dollar has no rate here.
CURRENCY_ROWS = [
    {"currency_key": 1, "currency_code": "GBP", "country_code": "GB"},
    {"currency_key": 2, "currency_code": "EUR", "country_code": "DE"},
    {"currency_key": 3, "currency_code": "USD", "country_code": "US"},
]
CURRENCY_CTE = """dim_currency(currency_key, currency_code, country_code) AS (
    VALUES (1, 'GBP', 'GB'), (2, 'EUR', 'DE'), (3, 'USD', 'US'),
        (-1, 'Not Applicable', NULL), (0, 'Unknown', NULL))"""


def currency(spark):
    schema = T.StructType(
        [
            T.StructField("currency_key", T.LongType()),
            T.StructField("currency_conversion_key", T.LongType()),
            T.StructField("currency_code", T.StringType()),
            T.StructField("country_code", T.StringType()),
        ]
    )
    return default_members(literal_rows(spark, schema, CURRENCY_ROWS), "dim_currency")


def _resolve(name, dim, natural, surrogate, dim_table, users=False):
    if users:
        source, side = f"orders_table o JOIN ({BUYERS}) b ON b.date_key = o.date_key", "b"
    else:
        source, side = "orders_table o", "o"
    sql = star_ctes("orders", dim) + f"""
        SELECT o.date_key AS order_no, o.product_key AS product_no, {side}.{natural}, d.{surrogate}
        FROM {source} LEFT JOIN {dim_table} d ON {side}.{natural} = d.{natural}"""

    @register(name, sql)
    def query(spark, sf_dir):
        bound = star(spark, sf_dir, users=users)
        order_no = F.col("date_key").alias("order_no")
        product_no = F.col("product_key").alias("product_no")
        fact = bound.orders.select(order_no, product_no, natural)
        return joins.resolve_fk(fact, getattr(bound, dim), natural, surrogate)

    return query


_resolve("resolve_fk_card", "card", "card_number", "card_key", "dim_card_details", users=True)
_resolve("resolve_fk_date", "date_times", "date_uuid", "date_key", "dim_date_times")
_resolve("resolve_fk_store", "store", "store_code", "store_key", "dim_store_details")
_resolve("resolve_fk_user", "users", "user_uuid", "user_key", "dim_users", users=True)
_resolve("resolve_fk_product", "product", "product_code", "product_key", "dim_product")


@register("resolve_fk_bucketed", ORACLES["resolve_fk_date"])
def resolve_fk_bucketed(spark, sf_dir):
    """Fact and date dimension as catalog tables in equal buckets of the natural key."""
    return bucketed_dates(spark, sf_dir)


def bucketed_dates(spark, sf_dir, buckets=8):
    bound, run = star(spark, sf_dir), uuid.uuid4().hex
    fact = bound.orders.select(F.col("date_key").alias("order_no"), F.col("product_key").alias("product_no"), "date_uuid")
    tables = {"orders_table": fact, "dim_date_times": bound.date_times.select("date_uuid", "date_key")}
    loaded = {
        name: load_bucketed(df, f"{name}_{run}", scratch_path(spark, name), "date_uuid", buckets) for name, df in tables.items()
    }
    with unhinted():
        return joins.resolve_fk(loaded["orders_table"], loaded["dim_date_times"], "date_uuid", "date_key")


@register("resolve_fk_duplicate_codes", """
    SELECT o_orderkey, o_custkey, m.user_key FROM orders
        LEFT JOIN (SELECT c_nationkey, min(c_custkey) AS user_key FROM customer GROUP BY 1) m
        ON o_custkey % 40 = m.c_nationkey""")
def resolve_fk_duplicate_codes(spark, sf_dir):
    """Many dimension rows per natural key: the lowest key wins, the fact keeps its rows."""
    fact = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", (F.col("o_custkey") % 40).alias("nation")
    )
    dim = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("long").alias("nation"), F.col("c_custkey").alias("user_key")
    )
    return joins.resolve_fk(fact, dim, "nation", "user_key").drop("nation")


@register("lookup_scalar_country", star_ctes("orders", "store") + """
    SELECT o.date_key, o.store_code, (SELECT d.country_code FROM dim_store_details d
        WHERE d.store_code = o.store_code) AS country_code FROM orders_table o""")
def lookup_scalar_country(spark, sf_dir):
    return star(spark, sf_dir, country=True).orders.select("date_key", "store_code", "country_code")


@register("lookup_scalar_currency", star_ctes("orders", "store") + f""", {CURRENCY_CTE}
    SELECT o.date_key, o.store_code, CAST((SELECT c.currency_key FROM dim_currency c
        WHERE c.country_code = d.country_code) AS BIGINT) AS currency_key
    FROM orders_table o LEFT JOIN dim_store_details d ON d.store_code = o.store_code""")
def lookup_scalar_currency(spark, sf_dir):
    fact = star(spark, sf_dir, country=True).orders.select("date_key", "store_code", "country_code")
    return joins.lookup_scalar(fact, currency(spark), "country_code", "currency_key").drop("country_code")


@register("link_currency_rate", """
    WITH rates AS (SELECT 'C' || p_size AS currency_code, min(p_partkey) AS rate_key
        FROM part GROUP BY 1)
    SELECT s_suppkey AS currency_key, 'C' || s_suppkey AS currency_code,
        rate_key AS currency_conversion_key
    FROM supplier LEFT JOIN rates ON rates.currency_code = 'C' || s_suppkey""")
def link_currency_rate(spark, sf_dir):
    code = F.concat(F.lit("C"), F.col("s_suppkey").cast("string"))
    currencies = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("currency_key"),
        code.alias("currency_code"),
        F.lit(None).cast("long").alias("currency_conversion_key"),
    )
    rates = table(spark, sf_dir, "part").select(
        F.concat(F.lit("C"), F.col("p_size").cast("string")).alias("currency_code"),
        F.col("p_partkey").alias("currency_conversion_key"),
    )
    return joins.link_currency_rate(currencies, rates)


@register("fill_unknown_keys", star_ctes("orders", "store") + """
    SELECT date_key, product_key, CASE WHEN store_key IS NULL AND NOT EXISTS (
            SELECT 1 FROM dim_store_details d WHERE d.store_key = o.store_key)
        THEN 0 ELSE store_key END AS store_key FROM orders_table o""")
def fill_unknown_keys(spark, sf_dir):
    fact = star(spark, sf_dir).orders.select("date_key", "product_key", "store_key")
    return joins.fill_unknown_keys(fact, ["product_key", "store_key"])


@register("anti_join", """
    SELECT c_custkey FROM customer c WHERE NOT EXISTS (
        SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')""")
def anti_join(spark, sf_dir):
    """Users without a sale of one status; the sales are reduced to their users first."""
    sales = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    buyers = sales.select(F.col("o_custkey").alias("c_custkey")).distinct()
    return table(spark, sf_dir, "customer").select("c_custkey").join(buyers, "c_custkey", "left_anti")


# Sales and users with two common columns, of which the second is missing on both sides at times.
MERGE_SQL = """
    WITH a AS (SELECT o_custkey AS k, nullif(o_orderstatus, 'P') AS status, o_orderkey AS order_no
        FROM orders),
    b AS (SELECT c_custkey AS k, CASE c_nationkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' END AS status,
        c_name AS name FROM customer)
    SELECT coalesce(a.k, b.k) AS k, coalesce(a.status, b.status) AS status, order_no, name
    FROM a {how} JOIN b ON a.k = b.k AND a.status IS NOT DISTINCT FROM b.status"""


def _merge(how):
    @register(f"merge_frames_{how}", MERGE_SQL.format(how="FULL" if how == "outer" else how.upper()))
    def query(spark, sf_dir):
        sales = table(spark, sf_dir, "orders").select(
            F.col("o_custkey").alias("k"),
            F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
            F.col("o_orderkey").alias("order_no"),
        )
        nation = F.col("c_nationkey") % 3
        users = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("k"),
            F.when(nation == 0, "F").when(nation == 1, "O").alias("status"),
            F.col("c_name").alias("name"),
        )
        return joins.merge_frames(how, sales, users)


for _how in ("left", "right", "inner", "outer"):
    _merge(_how)


@register("union_tables", """
    WITH parts AS (
        SELECT 0 AS part_no, c_custkey AS row_index, c_name AS name FROM customer
        UNION ALL SELECT 1, s_suppkey, s_name FROM supplier
        UNION ALL SELECT 2, p_partkey, p_name FROM part)
    SELECT row_number() OVER (ORDER BY part_no, row_index) - 1 AS row_index, name FROM parts""")
def union_tables_query(spark, sf_dir):
    parts = [
        table(spark, sf_dir, name).select(F.col(key).alias("row_index"), F.col(text).alias("name"))
        for name, key, text in (
            ("customer", "c_custkey", "c_name"),
            ("supplier", "s_suppkey", "s_name"),
            ("part", "p_partkey", "p_name"),
        )
    ]
    return union_tables(parts, "row_index")


@register("union_bag", """
    SELECT o_custkey AS user_no FROM orders UNION ALL SELECT c_custkey FROM customer""")
def union_bag(spark, sf_dir):
    buyers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_no"))
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_no"))
    return buyers.unionByName(users)


@register("inner_join_chain", star_ctes("orders", "product", "date_times", "store") + """
    SELECT o.date_key, o.product_key, s.store_type, d.year,
        CAST(p.product_price AS DOUBLE) AS product_price
    FROM orders_table o JOIN dim_product p ON o.product_key = p.product_key
        JOIN dim_date_times d ON o.date_key = d.date_key
        JOIN dim_store_details s ON o.store_key = s.store_key""")
def inner_join_chain(spark, sf_dir):
    bound = star(spark, sf_dir)
    fact = bound.orders.select("date_key", "product_key", "store_key")
    profile = KeyProfile(fact, "date_key", "product_key", "store_key")
    prices = bound.product.select("product_key", F.col("product_price").cast("double").alias("product_price"))
    sales = attach(fact, prices, "product_key", "inner", profile)
    sales = attach(sales, bound.date_times.select("date_key", "year"), "date_key", "inner", profile)
    sales = attach(sales, bound.store.select("store_key", "store_type"), "store_key", "inner", profile)
    return sales.select("date_key", "product_key", "store_type", "year", "product_price")


@register("left_outer_chain", star_ctes("orders", "product", "store") + """
    SELECT o.date_key, o.product_code, p.product_name, s.store_type FROM orders_table o
        LEFT JOIN dim_product p ON o.product_code = p.product_code
        LEFT JOIN dim_store_details s ON o.store_code = s.store_code""")
def left_outer_chain(spark, sf_dir):
    bound = star(spark, sf_dir)
    fact = bound.orders.select("date_key", "product_code", "store_code")
    profile = KeyProfile(fact, "product_code", "store_code")
    sales = attach(fact, bound.product.select("product_code", "product_name"), "product_code", "left", profile)
    sales = attach(sales, bound.store.select("store_code", "store_type"), "store_code", "left", profile)
    return sales.select("date_key", "product_code", "product_name", "store_type")


@register("salted_join", """
    SELECT l_orderkey, l_linenumber, l_returnflag, o_orderpriority FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey""")
def salted_join_query(spark, sf_dir):
    """The join past the broadcast bound, whatever the size of the right side."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return salted_join(items, orders, "o_orderkey", "inner").withColumnRenamed("o_orderkey", "l_orderkey")


@register("count_column", """
    SELECT l_returnflag, l_linestatus, count(CASE WHEN l_discount > 0.05 THEN l_orderkey END)
        AS discounted FROM lineitem GROUP BY ALL""")
def count_column(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.when(F.col("l_discount") > 0.05, F.col("l_orderkey"))).alias("discounted")
    )


@register("count_star", "SELECT l_suppkey, count(*) AS sales FROM lineitem GROUP BY l_suppkey")
def count_star(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("sales"))


@register("sum_expression", """
    SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_quantity AS BIGINT))
        AS DOUBLE) AS amount FROM lineitem GROUP BY l_returnflag""")
def sum_expression(spark, sf_dir):
    amount = F.sum(revenue(F.col("l_extendedprice"), F.col("l_quantity").cast("smallint")))
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        amount.cast("double").alias("amount")
    )


@register("group_by_alias", """
    SELECT CASE WHEN o_totalprice >= 250000 THEN 'large' ELSE 'small' END AS size,
        year(o_orderdate) AS year, count(*) AS sales FROM orders GROUP BY size, 2""")
def group_by_alias(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return spark.sql(
        """SELECT CASE WHEN o_totalprice >= 250000 THEN 'large' ELSE 'small' END AS size,
               CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS sales
           FROM {orders} GROUP BY size, 2""",
        orders=orders,
    )


@register("hidden_group_key", """
    SELECT l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units FROM lineitem
    GROUP BY l_returnflag, l_suppkey""")
def hidden_group_key(spark, sf_dir):
    units = F.sum(F.col("l_quantity").cast("long")).alias("units")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_suppkey").agg(units).drop("l_suppkey")


@register("scalar_subquery_aggregate", """
    SELECT o_orderpriority, count(*) AS sales, (SELECT count(*) FROM orders) AS total,
        CAST((count(*) * 20000 + (SELECT count(*) FROM orders))
            // (2 * (SELECT count(*) FROM orders)) AS DOUBLE) / 100 AS share
    FROM orders GROUP BY o_orderpriority""")
def scalar_subquery_aggregate(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    total = orders.agg(F.count(F.lit(1)).alias("total")).scalar()
    return orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("sales")).select(
        "o_orderpriority",
        "sales",
        total.alias("total"),
        percent_of_count(F.col("sales"), total).alias("share"),
    )


@register("cte_chain", """
    WITH units AS (SELECT l_suppkey, sum(CAST(l_quantity AS BIGINT)) AS units FROM lineitem GROUP BY 1),
    ranked AS (SELECT s_nationkey, units FROM units JOIN supplier ON l_suppkey = s_suppkey),
    best AS (SELECT s_nationkey, CAST(max(units) AS BIGINT) AS best FROM ranked GROUP BY 1)
    SELECT n_name, best FROM best JOIN nation ON s_nationkey = n_nationkey""")
def cte_chain(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey"))
    units = items.agg(F.sum(F.col("l_quantity").cast("long")).alias("units"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    best = attach(units, suppliers, "s_suppkey", "inner", reduced=True).groupBy(
        F.col("s_nationkey").alias("n_nationkey")
    ).agg(F.max("units").alias("best"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return attach(best, nations, "n_nationkey", "inner", reduced=True).select("n_name", "best")


def half_up(hundredths: str, whole: str) -> str:
    """Oracle text of a quotient in hundredths, rounded by its remainder. (Its own decimals divide as binary floats.)"""
    up = f"CASE WHEN 2 * (({hundredths}) % ({whole})) >= {whole} THEN 1 ELSE 0 END"
    return f"CAST(({hundredths}) // ({whole}) + {up} AS DOUBLE) / 100"


@register("share_of_count", f"""
    SELECT o_orderstatus, count(*) AS sales, {half_up("count(*) * 10000", "sum(count(*)) OVER ()")} AS share
    FROM orders GROUP BY o_orderstatus""")
def share_of_count(spark, sf_dir):
    groups = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("sales"))
    whole = F.sum("sales").over(Window.partitionBy())
    return groups.select("o_orderstatus", "sales", percent_of_count(F.col("sales"), whole).alias("share"))


@register("share_of_revenue", """
    WITH amounts AS (SELECT l_partkey, sum(CAST(l_extendedprice AS DECIMAL(12, 2))) AS amount
        FROM lineitem GROUP BY 1)
    SELECT l_partkey, CAST(amount AS DOUBLE) AS amount,
        round(CAST(amount AS DOUBLE) / CAST(sum(amount) OVER () AS DOUBLE) * 100, 2) AS share
    FROM amounts""")
def share_of_revenue(spark, sf_dir):
    """Many groups, so the whole is a scalar sum and not a window over one task."""
    groups = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("amount")
    )
    whole = groups.agg(F.sum("amount").alias("whole")).scalar()
    return groups.select(
        "l_partkey",
        money(F.col("amount")).alias("amount"),
        percent_of_amount(F.col("amount"), whole).alias("share"),
    )


@register("lead_previous_sale", """
    WITH pairs AS (SELECT o_totalprice AS value,
        lead(o_totalprice) OVER (ORDER BY o_totalprice DESC) AS next_value FROM orders)
    SELECT value, next_value, count(*) AS row_count FROM pairs GROUP BY ALL""")
def lead_previous_sale(spark, sf_dir):
    return previous_value(table(spark, sf_dir, "orders"), "o_totalprice")


@register("lead_event_gap", """
    WITH pairs AS (SELECT epoch_us(ts) AS value,
        lead(epoch_us(ts)) OVER (ORDER BY ts DESC) AS next_value FROM events)
    SELECT value, next_value, value - next_value AS gap, count(*) AS row_count
    FROM pairs GROUP BY ALL""")
def lead_event_gap(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(micros(F.col("ts")).alias("value"))
    return previous_value(events, "value").withColumn("gap", F.col("value") - F.col("next_value"))


@register("lead_event_rows", """
    SELECT epoch_us(ts) AS value, lead(epoch_us(ts)) OVER (ORDER BY ts DESC) AS next_value FROM events""")
def lead_event_rows(spark, sf_dir):
    """Every event with the instant of the one before."""
    return lead_rows(table(spark, sf_dir, "events").select(micros(F.col("ts")).alias("value")), "value")


@register("order_by_desc_nulls_first", """
    SELECT row_number() OVER (ORDER BY amount DESC NULLS FIRST, o_orderkey) AS place, o_orderkey, amount
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 > 0 THEN o_totalprice END AS amount FROM orders)""")
def order_by_desc_nulls_first(spark, sf_dir):
    """Places of the global order, missing amounts first; the numbering is distributed too."""
    amount = F.when(F.col("o_orderkey") % 10 > 0, F.col("o_totalprice"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", amount.alias("amount"))
    # Missing amounts sort before the highest.
    ranked = orders.withColumns(
        {"_missing": F.col("amount").isNotNull().cast("int"), "_down": -F.col("amount")}
    )
    return number_rows(ranked, ["_missing", "_down", "o_orderkey"], "place").select(
        "place", "o_orderkey", "amount"
    )


@register("sort_rows", "SELECT l_orderkey, l_returnflag, l_quantity FROM lineitem ORDER BY l_quantity DESC")
def sort_rows_query(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    return sort_rows(items, F.desc_nulls_first("l_quantity"))


@register("top_k", """
    SELECT o_custkey, count(*) AS sales FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def top_k_query(spark, sf_dir):
    sales = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("sales"))
    return top_k(sales, [F.desc_nulls_first("sales"), F.asc("o_custkey")], 5)


@register("audit_pk", """
    SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
    GROUP BY ALL HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def audit_pk(spark, sf_dir):
    return audits.audit_pk(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


PK = "SELECT '{t}' AS table_name, count(*) FILTER (k IS NOT NULL AND n > 1) AS duplicate_keys, " \
     "CAST(coalesce(sum(n) FILTER (k IS NULL), 0) AS BIGINT) AS null_rows " \
     "FROM (SELECT {k} AS k, count(*) AS n FROM {t} GROUP BY 1)"
AUDITED = {
    "dim_users": ("users", "user_key"),
    "dim_store_details": ("store", "store_key"),
    "dim_card_details": ("card", "card_key"),
    "dim_product": ("product", "product_key"),
    "dim_date_times": ("date_times", "date_key"),
    "orders_table": ("orders", "date_key"),
}


@register("audit_pk_summary", star_ctes("users", "store", "card", "product", "date_times", "orders")
          + " UNION ALL ".join(PK.format(t=t, k=k) for t, (_, k) in AUDITED.items()))
def audit_pk_summary(spark, sf_dir):
    """Every table by its key, and the fact by its date key, which several rows share."""
    bound = star(spark, sf_dir)
    return audits.audit_pk_summary({t: (getattr(bound, a), k) for t, (a, k) in AUDITED.items()})


@register("audit_pk_bitmaps", ORACLES["audit_pk_summary"])
def audit_pk_bitmaps(spark, sf_dir):
    """The same keys by bitmaps of ranges."""
    bound = star(spark, sf_dir)
    return audits.audit_pk_bitmaps({t: (getattr(bound, a), k) for t, (a, k) in AUDITED.items()})


FK = "SELECT '{k}' AS fk, count(DISTINCT o.{k}) AS orphan_keys, count(*) AS orphan_rows " \
     "FROM orders_table o ANTI JOIN {t} d ON o.{k} = d.{k} WHERE o.{k} IS NOT NULL"


@register("audit_fk", star_ctes("orders", "product", "store", "date_times") + " UNION ALL ".join(
    [
        FK.format(k="product_key", t="(SELECT * FROM dim_product WHERE category <> 'SMALL')"),
        FK.format(k="store_key", t="(SELECT * FROM dim_store_details WHERE country_code IS NOT NULL)"),
        FK.format(k="date_key", t="dim_date_times"),
    ]))
def audit_fk(spark, sf_dir):
    """Two of the dimensions miss rows here, so that there is something to find."""
    bound = star(spark, sf_dir)
    return audits.audit_fk(bound.orders, _references(bound))


def _references(bound):
    return {
        "product_key": (bound.product.where("category <> 'SMALL'"), "product_key"),
        "store_key": (bound.store.where("country_code IS NOT NULL"), "store_key"),
        "date_key": (bound.date_times, "date_key"),
    }


@register("audit_fk_bitmaps", ORACLES["audit_fk"])
def audit_fk_bitmaps(spark, sf_dir):
    """The same references by bitmaps of ranges."""
    bound = star(spark, sf_dir)
    return audits.audit_fk_bitmaps(bound.orders, _references(bound))


@register("audit_fk_people", star_ctes("users", "card") + """
    SELECT 'user_key' AS fk, count(DISTINCT o_custkey) AS orphan_keys, count(*) AS orphan_rows
    FROM orders ANTI JOIN (SELECT * FROM dim_users WHERE first_name <> 'MACHINERY') d
        ON o_custkey + 1 = d.user_key
    UNION ALL SELECT 'card_key', count(DISTINCT o_custkey), count(*)
    FROM orders ANTI JOIN dim_card_details d ON o_custkey + 1 = d.card_key""")
def audit_fk_people(spark, sf_dir):
    bound = star(spark, sf_dir)
    key = F.col("o_custkey") + 1
    fact = table(spark, sf_dir, "orders").select(key.alias("user_key"), key.alias("card_key"))
    return audits.audit_fk(
        fact,
        {
            "user_key": (bound.users.where("first_name <> 'MACHINERY'"), "user_key"),
            "card_key": (bound.card, "card_key"),
        },
    )


@register("audit_fk_currency", """
    SELECT 'currency_conversion_key' AS fk, count(DISTINCT s_suppkey) AS orphan_keys,
        count(*) AS orphan_rows
    FROM supplier ANTI JOIN (SELECT DISTINCT p_size FROM part) p ON s_suppkey = p_size""")
def audit_fk_currency(spark, sf_dir):
    """Currencies against their rates."""
    rates = table(spark, sf_dir, "part").select(F.col("p_size").alias("rate_key")).distinct()
    currency = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("currency_conversion_key"))
    return audits.audit_fk(currency, {"currency_conversion_key": (rates, "rate_key")})


@register("unresolved_key_counts", star_ctes("orders") + f"""
    SELECT 'date_key' AS key_column, count(*) FILTER (o.date_key = 0) AS unresolved
    FROM orders_table o
    UNION ALL SELECT 'product_key', count(*) FILTER (product_key = 0) FROM orders_table
    UNION ALL SELECT 'store_key', count(*) FILTER (coalesce(store_key, 0) = 0) FROM orders_table
    UNION ALL SELECT 'user_key', count(*) FILTER (user_key IS NULL)
        FROM orders_table o LEFT JOIN ({BUYERS}) b ON o.date_key = b.date_key""")
def unresolved_key_counts(spark, sf_dir):
    fact = joins.fill_unknown_keys(star(spark, sf_dir, users=True).orders, ["store_key", "user_key"])
    return audits.unresolved_key_counts(fact, ["date_key", "product_key", "store_key", "user_key"])


@register("row_reconciliation", """
    SELECT l AS left_rows, r AS right_rows, l - r AS difference, l = r AS matches
    FROM (SELECT (SELECT count(*) FROM orders) AS l, (SELECT count(*) FROM lineitem) AS r)""")
def row_reconciliation(spark, sf_dir):
    return audits.row_reconciliation(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
