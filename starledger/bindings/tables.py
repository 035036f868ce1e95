"""Inputs made out of the test tables: the star, and raw datasets with realistic dirt.

Every input is one SELECT that both Spark and the oracle database run, so that both
sides see the same rows and texts. ``{name}`` stands for a test table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from starledger.operators.joins import lookup_scalar
from starledger.operators.rows import default_members
from starledger.operators.skew import attach
from starledger.plans.star import Star
from starledger.sources.sinks import spread

# Date layouts, Spark pattern -> oracle pattern.
_LAYOUTS = {
    "yyyy-MM-dd": "%Y-%m-%d",
    "yyyy/M/d": "%Y/%-m/%-d",
    "yyyy MMMM dd": "%Y %B %d",
    "MMMM yyyy dd": "%B %Y %d",
    "MM/dd/yyyy": "%m/%d/%Y",
}


# Declared schemas of the test tables, so that no query infers one.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def date_text(date: str, layout: str, spark: bool) -> str:
    if spark:
        return f"date_format({date}, '{layout}')"
    return f"strftime({date}, '{_LAYOUTS[layout]}')"


def dirty_date(date: str, key: str, spark: bool) -> str:
    """Date text in five layouts, 'NULL', junk, an impossible date, or missing."""
    return f"""CASE {key} % 9
        WHEN 0 THEN {date_text(date, 'yyyy-MM-dd', spark)}
        WHEN 1 THEN {date_text(date, 'yyyy/M/d', spark)}
        WHEN 2 THEN {date_text(date, 'yyyy MMMM dd', spark)}
        WHEN 3 THEN {date_text(date, 'MMMM yyyy dd', spark)}
        WHEN 4 THEN {date_text(date, 'MM/dd/yyyy', spark)}
        WHEN 5 THEN 'NULL' WHEN 6 THEN 'QX7' || CAST({key} AS STRING)
        WHEN 7 THEN '2001-13-45' END"""


def day_after(start: str, days: str) -> str:
    return f"CAST(DATE '{start}' + CAST({days} AS INT) AS DATE)"


_SECONDS = "((o_orderkey * 7919) % 86400)"
_TIME_OF_DAY = (
    f"lpad(CAST(CAST(floor({_SECONDS} / 3600.0) AS INT) AS STRING), 2, '0') || ':' || "
    f"lpad(CAST(CAST(floor(({_SECONDS} % 3600) / 60.0) AS INT) AS STRING), 2, '0') || ':' || "
    f"lpad(CAST({_SECONDS} % 60 AS STRING), 2, '0')"
)
_STORE_CODE = "CASE WHEN s_suppkey = 0 THEN 'WEB-1388012W' ELSE 'S' || CAST(s_suppkey AS STRING) END"
_FACT_STORE_CODE = (
    "CASE WHEN l_linenumber = 7 THEN 'S-LOST' WHEN l_suppkey = 0 THEN 'WEB-1388012W' "
    "ELSE 'S' || CAST(l_suppkey AS STRING) END"
)

WEIGHT_TEXT = """CASE p_partkey % 10
    WHEN 0 THEN CAST(p_size AS STRING) || 'kg'
    WHEN 1 THEN CAST(p_size AS STRING) || '00g'
    WHEN 2 THEN CAST(p_size AS STRING) || '0ml'
    WHEN 3 THEN CAST(p_size AS STRING) || 'oz'
    WHEN 4 THEN CAST(p_size AS STRING) || ' x 15g'
    WHEN 5 THEN CAST(p_size AS STRING) || 'g .'
    WHEN 6 THEN '0.' || CAST(p_size AS STRING) || 'g'
    WHEN 7 THEN CAST(p_size AS STRING) || 'lbs'
    WHEN 8 THEN CAST(p_size AS STRING) || ' x 85ml'
    ELSE CAST(p_size AS STRING) || '.25kg' END"""

# The clean star.
STAR_SQL = {
    "product": """
        SELECT p_partkey + 1 AS product_key, CAST(NULL AS STRING) AS ean, p_name AS product_name,
            CAST(p_retailprice AS DECIMAL(12, 2)) AS product_price,
            CAST(p_size AS DOUBLE) * 3.5 AS weight, p_type AS category,
            'P' || CAST(p_partkey AS STRING) AS product_code
        FROM {part}""",
    "store": f"""
        SELECT s_suppkey + 1 AS store_key, s_name AS store_address,
            s_acctbal / 100 AS longitude, s_acctbal / -200 AS latitude, n_name AS city,
            {_STORE_CODE} AS store_code,
            CAST(s_suppkey % 90 AS SMALLINT) AS number_of_staff,
            CASE s_suppkey % 5 WHEN 0 THEN 'Web' WHEN 1 THEN 'Corner' WHEN 2 THEN 'Mall'
                WHEN 3 THEN 'Outlet' ELSE 'Depot' END AS store_type,
            CASE n_nationkey % 4 WHEN 0 THEN 'GB' WHEN 1 THEN 'DE' WHEN 2 THEN 'US' END
                AS country_code,
            r_name AS region
        FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
            JOIN {{region}} ON n_regionkey = r_regionkey""",
    "users": """
        SELECT c_custkey + 1 AS user_key, c_mktsegment AS first_name, c_name AS last_name,
            'U' || CAST(c_custkey AS STRING) AS user_uuid
        FROM {customer}""",
    "card": """
        SELECT c_custkey + 1 AS card_key,
            '4' || lpad(CAST(c_custkey AS STRING), 15, '0') AS card_number,
            c_mktsegment AS card_provider
        FROM {customer}""",
    "date_times": f"""
        SELECT o_orderkey + 1 AS date_key, 'D' || CAST(o_orderkey AS STRING) AS date_uuid,
            CAST(day(o_orderdate) AS INT) AS day, CAST(month(o_orderdate) AS INT) AS month,
            CAST(year(o_orderdate) AS INT) AS year, {_TIME_OF_DAY} AS timestamp,
            CASE WHEN {_SECONDS} < 21600 THEN 'Late_Hours' WHEN {_SECONDS} < 43200 THEN 'Morning'
                WHEN {_SECONDS} < 64800 THEN 'Midday' ELSE 'Evening' END AS time_period
        FROM {{orders}}""",
    "orders": f"""
        SELECT l_partkey + 1 AS product_key,
            CASE WHEN l_linenumber <> 7 THEN l_suppkey + 1 END AS store_key,
            l_orderkey + 1 AS date_key,
            'P' || CAST(l_partkey AS STRING) AS product_code, {_FACT_STORE_CODE} AS store_code,
            'D' || CAST(l_orderkey AS STRING) AS date_uuid,
            CAST(l_quantity AS SMALLINT) AS product_quantity
        FROM {{lineitem}}""",
}
BUYER_SQL = """
    SELECT o_orderkey + 1 AS date_key, o_custkey + 1 AS user_key,
        '4' || lpad(CAST(o_custkey AS STRING), 15, '0') AS card_number,
        'U' || CAST(o_custkey AS STRING) AS user_uuid
    FROM {orders}"""
DIM_OF = {
    "product": "dim_product",
    "store": "dim_store_details",
    "users": "dim_users",
    "card": "dim_card_details",
    "date_times": "dim_date_times",
}

# Raw datasets. All columns are text but the position.
_RAW_SQL = {
    "users": """
        SELECT c_custkey AS position, c_mktsegment AS first_name, c_name AS last_name,
            {birth} AS date_of_birth, c_mktsegment || ' Ltd' AS company,
            CAST(c_custkey AS STRING) || '@example.com' AS email_address,
            c_name || ' Street' AS address, 'Land ' || CAST(c_nationkey AS STRING) AS country,
            CASE c_nationkey % 3 WHEN 0 THEN 'GB' WHEN 1 THEN 'DE' ELSE 'US' END AS country_code,
            '+44 ' || CAST(c_custkey AS STRING) AS phone_number, {joined} AS join_date,
            '00000000-0000-4000-8000-' || lpad(CAST(c_custkey AS STRING), 12, '0') AS user_uuid
        FROM {{customer}}""",
    "stores": """
        SELECT s_suppkey AS c0, s_name AS c1,
            CASE WHEN s_suppkey % 7 = 3 THEN 'N/A' ELSE CAST(s_nationkey AS STRING) || '.5' END AS c2,
            CAST(NULL AS STRING) AS c3, 'City ' || CAST(s_nationkey AS STRING) AS c4,
            {code} AS c5,
            CASE s_suppkey % 8 WHEN 0 THEN '3n9' WHEN 1 THEN 'A97' WHEN 2 THEN '80R'
                WHEN 3 THEN 'J78' WHEN 4 THEN '30e' ELSE CAST(s_suppkey % 90 AS STRING) END AS c6,
            {opened} AS c7,
            CASE s_suppkey % 5 WHEN 0 THEN 'Web' WHEN 1 THEN 'Corner' WHEN 2 THEN 'Mall'
                WHEN 3 THEN 'Outlet' ELSE 'Depot' END AS c8,
            CAST(s_nationkey AS STRING) || '.25' AS c9,
            CASE s_nationkey % 3 WHEN 0 THEN 'GB' WHEN 1 THEN 'DE' ELSE 'US' END AS c10,
            CASE s_suppkey % 4 WHEN 0 THEN 'eeEurope' WHEN 1 THEN 'Europe'
                WHEN 2 THEN 'eeAmerica' ELSE 'America' END AS c11
        FROM {{supplier}}""",
    "cards": """
        SELECT c_custkey AS position,
            CASE c_custkey % 3 WHEN 0 THEN '?' ELSE '' END || '4' ||
                lpad(CAST(c_custkey AS STRING), 15, '0') || '-' AS card_number,
            '12/' || CAST(20 + c_custkey % 10 AS STRING) AS expiry_date,
            CASE c_custkey % 11 WHEN 3 THEN 'NULL' WHEN 5 THEN 'NB71VBAHJE' WHEN 7 THEN NULL
                ELSE c_mktsegment END AS card_provider,
            {confirmed} AS date_payment_confirmed
        FROM {{customer}}""",
    "products": """
        SELECT p_partkey AS position, p_name AS product_name,
            '£' || CAST(CAST(p_retailprice AS DECIMAL(12, 2)) AS STRING) AS product_price,
            {weight} AS weight, p_type AS category, p_brand AS ean, {added} AS date_added,
            '00000000-0000-4000-9000-' || lpad(CAST(p_partkey AS STRING), 12, '0') AS uuid,
            CASE p_partkey % 13 WHEN 0 THEN 'T3QRRH7SRP' WHEN 1 THEN 'Removed' WHEN 2 THEN NULL
                ELSE 'Still_avaliable' END AS removed,
            'P' || CAST(p_partkey AS STRING) AS product_code
        FROM {{part}}""",
    "date_times": """
        SELECT o_orderkey AS position, {time} AS timestamp,
            CASE WHEN o_orderkey % 40 = 7 THEN 'M' || CAST(o_orderkey AS STRING)
                WHEN o_orderkey % 40 = 9 THEN NULL
                ELSE CAST(month(o_orderdate) AS STRING) END AS month,
            CAST(year(o_orderdate) AS STRING) AS year, CAST(day(o_orderdate) AS STRING) AS day,
            'Evening' AS time_period,
            '00000000-0000-4000-a000-' || lpad(CAST(o_orderkey AS STRING), 12, '0') AS date_uuid
        FROM {{orders}}""",
    "orders": """
        SELECT l_orderkey * 10 + l_linenumber AS c0, CAST(NULL AS STRING) AS c1,
            '00000000-0000-4000-a000-' || lpad(CAST(l_orderkey AS STRING), 12, '0') AS c2,
            l_returnflag AS c3, l_linestatus AS c4,
            '00000000-0000-4000-8000-' || lpad(CAST(o_custkey AS STRING), 12, '0') AS c5,
            '4' || lpad(CAST(o_custkey AS STRING), 15, '0') AS c6,
            {store} AS c7, 'P' || CAST(l_partkey AS STRING) AS c8, CAST(NULL AS STRING) AS c9,
            CAST(CAST(l_quantity AS INT) AS STRING) AS c10
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "currency": """
        SELECT s_suppkey AS position,
            CASE s_suppkey WHEN 0 THEN 'GB' WHEN 1 THEN 'DE' WHEN 2 THEN 'US'
                ELSE 'X' || CAST(s_suppkey AS STRING) END AS country_code,
            s_name AS country_name,
            CASE s_suppkey WHEN 0 THEN 'GBP' WHEN 1 THEN 'EUR' WHEN 2 THEN 'USD'
                ELSE 'C' || CAST(s_suppkey AS STRING) END AS currency_code,
            '$' AS currency_symbol
        FROM {{supplier}}""",
    "currency_conversion": """
        SELECT p_partkey AS position,
            CASE p_size WHEN 1 THEN 'US Dollar' WHEN 2 THEN 'Euro' WHEN 3 THEN NULL
                ELSE p_brand END AS currency_name,
            CASE WHEN p_size <> 3 THEN CAST(p_size AS STRING) || '.500000' END AS conversion_rate,
            CASE WHEN p_size <> 3 THEN '0.' || CAST(p_size AS STRING) END AS conversion_rate_percentage
        FROM {{part}}""",
    "mapping": """
        SELECT DISTINCT p_brand AS name, 'B' || substr(p_brand, 7) AS code FROM {{part}}
        UNION ALL SELECT 'US Dollar', 'USD' UNION ALL SELECT 'Euro', 'EUR'""",
}


def raw_sql(dataset: str, spark: bool) -> str:
    """SELECT of one raw dataset, in the Spark or the oracle dialect."""
    return _RAW_SQL[dataset].format(
        birth=dirty_date(day_after("1960-01-01", "c_custkey % 9000"), "c_custkey", spark),
        joined=date_text(day_after("2001-01-01", "c_custkey % 5000"), "yyyy-MM-dd", spark),
        opened=dirty_date(day_after("1999-01-01", "s_suppkey % 4000"), "s_suppkey", spark),
        confirmed=dirty_date(day_after("2010-01-01", "c_custkey % 3000"), "(c_custkey + 1)", spark),
        added=dirty_date(day_after("2005-01-01", "p_partkey % 3000"), "p_partkey", spark),
        code=_STORE_CODE,
        store=_FACT_STORE_CODE,
        weight=WEIGHT_TEXT,
        time=_TIME_OF_DAY,
    )


def run_sql(spark: SparkSession, sf_dir: str, text: str, spread_rows: bool = False) -> DataFrame:
    names = set(re.findall(r"\{(\w+)\}", text))
    tables = {n: table(spark, sf_dir, n) for n in names}
    return spark.sql(text, **({n: spread(t) for n, t in tables.items()} if spread_rows else tables))


def oracle_text(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text)


def raw(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Texts are made from spread rows: a small table is one file, and so one task."""
    return run_sql(spark, sf_dir, raw_sql(dataset, True), spread_rows=True)


def raw_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: raw(spark, sf_dir, name) for name in _RAW_SQL if name != "mapping"}


def star_part(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the star, dimensions with their default members."""
    df = run_sql(spark, sf_dir, STAR_SQL[name])
    return default_members(df, DIM_OF[name]) if name in DIM_OF else df


class BoundStar:
    """The star over the test tables; a table is bound when a plan first names it.

    ``users`` adds the customer of the order to the fact, ``country`` the country of the
    store; both are joins, so only plans that read the column ask for it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, users: bool = False, country: bool = False):
        self._spark, self._sf_dir = spark, sf_dir
        self._users, self._country = users, country

    def __getattr__(self, name: str) -> DataFrame:
        if name not in STAR_SQL:
            raise AttributeError(name)
        df = star_part(self._spark, self._sf_dir, name)
        if name == "orders":
            df = self._extended(df)
        setattr(self, name, df)
        return df

    def _extended(self, fact: DataFrame) -> DataFrame:
        if self._country:
            fact = lookup_scalar(fact, self.store, "store_code", "country_code")
        if self._users:
            buyers = run_sql(self._spark, self._sf_dir, BUYER_SQL)
            fact = attach(fact, buyers, "date_key", "inner")
        # Nothing is written: a plan reads the columns it names, and counts keys only where a dimension is large.
        return fact


def star(spark: SparkSession, sf_dir: str, users: bool = False, country: bool = False) -> Star:
    return BoundStar(spark, sf_dir, users, country)


def star_ctes(*names: str) -> str:
    """WITH clause of the star in the oracle dialect, default members included."""
    member_columns = {
        "product": "-1, 'Not Applicable', NULL, NULL, NULL, NULL, NULL",
        "store": "-1, 'Not Applicable', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL",
        "users": "-1, 'Not Applicable', 'Not Applicable', NULL",
        "card": "-1, 'Not Applicable', NULL",
        "date_times": "-1, NULL, NULL, NULL, NULL, '00:00:00', NULL",
    }
    ctes = []
    for name in names:
        text = oracle_text(STAR_SQL[name])
        if name in member_columns:
            first = member_columns[name]
            second = "0" + first[2:].replace("Not Applicable", "Unknown")
            text += f" UNION ALL SELECT {first} UNION ALL SELECT {second}"
        cte = {"orders": "orders_table"}.get(name, DIM_OF.get(name))
        ctes.append(f"{cte} AS ({text})")
    return "WITH " + ", ".join(ctes)
