"""The load of the warehouse: keys resolved in parts, what it leaves on disk, rejected sales."""

import time
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starledger.bindings.tables import raw, raw_all
from starledger.plans import star as stars
from starledger.plans.pipelines import ORDER_COLUMNS, ORDER_KEYS
from starledger.plans.star import Star, resolve_keys
from starledger.plans.warehouse import load_warehouse
from starledger.session import SHUFFLES_DROPPED, session_settings
from starledger.sources import sinks
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.001"
RUN_TS = "2024-11-30 13:55:07"


def sales(spark):
    """A third of the sales have one product; there are missing, unknown and repeated natural keys, and kept keys."""
    def text(name, unknown):
        return F.when(F.col("id") % 7 == 3, None).when(F.col("id") % 11 == 5, unknown).otherwise(F.concat(F.lit(name), F.col("id") % 13))

    natural = {"date_uuid": "d", "user_uuid": "u", "card_number": "c", "store_code": "s", "product_code": "p"}
    columns = {n: text(t, f"{t}-lost").alias(n) for n, t in natural.items()}
    columns["product_code"] = F.when(F.col("id") % 3 == 0, "p1").otherwise(text("p", "p-lost")).alias("product_code")
    columns |= {k: F.lit(None).cast(t).alias(k) for k, t in ORDER_KEYS.items()}
    columns["card_key"] = F.when(F.col("id") % 2 == 0, F.lit(-5)).cast("long").alias("card_key")
    columns["country_code"] = F.lit("old").alias("country_code")
    columns |= {"order_key": F.col("id").alias("order_key"), "product_quantity": (F.col("id") % 5).cast("short").alias("product_quantity")}
    return spark.range(0, 1000, 1, 4).select(*[columns[c] for c in ORDER_COLUMNS], F.monotonically_increasing_id().alias("_row"))


def dimension(spark, letter, natural, key, *more):
    """Keys 1 to 12, the last natural key twice; a missing natural key and a missing key."""
    given = [(n, f"{letter}{n}") for n in range(1, 13)] + [(99, f"{letter}12"), (-1, None), (None, f"{letter}0")]
    df = spark.createDataFrame(given, f"{key} long, {natural} string")
    return df.select("*", *more)


def star(spark, orders, repeated=True):
    country = F.when(F.col("store_key") % 2 == 0, "DE").when(F.col("store_key") % 3 == 0, "US").alias("country_code")
    stores = dimension(spark, "s", "store_code", "store_key", country)
    return Star(
        orders=orders,
        product=dimension(spark, "p", "product_code", "product_key"),
        store=stores.where(F.col("store_key").isNull() | (F.col("store_key") != 99)) if not repeated else stores,
        users=dimension(spark, "u", "user_uuid", "user_key"),
        card=dimension(spark, "c", "card_number", "card_key"),
        date_times=dimension(spark, "d", "date_uuid", "date_key"),
        currency=spark.createDataFrame([(7, "DE"), (8, "GB"), (-1, None)], "currency_key long, country_code string"),
    )


def expected(sale):
    """The sale with its keys, by the rules."""
    given = sale.asDict()
    for natural, key in (("date_uuid", "date"), ("user_uuid", "user"), ("card_number", "card"), ("store_code", "store"), ("product_code", "product")):
        n = (given[natural] or "-")[1:]
        if n.isdigit() and int(n) > 0:
            given[f"{key}_key"] = int(n)
    store = given["store_key"]
    given["country_code"] = None if store is None else "DE" if store % 2 == 0 else "US" if store % 3 == 0 else None
    given["currency_key"] = 7 if given["country_code"] == "DE" else None
    return tuple(given[c] for c in ORDER_COLUMNS)


@pytest.mark.parametrize("forced", [None, 3, 2, 1, 0])
def test_keys_resolved_in_parts_are_those_of_the_rules(spark, tmp_path, monkeypatch, forced):
    """With all dimensions small, with so many of them large that rows are numbered, and with fewer."""
    if forced is not None:
        seen = []

        def small(df, *bounds):
            seen.append(df)
            return 0 < forced < len(seen) or bool({"country_code", "currency_key"} == set(df.columns))

        monkeypatch.setattr(stars.skew, "measured_small", small)
        monkeypatch.setattr(stars.skew, "MIN_HEAVY_ROWS", 10)
    monkeypatch.setattr(sinks, "PART_BYTES", 1)
    sales(spark).write.parquet(str(tmp_path / "sales"))
    staged = spark.read.parquet(str(tmp_path / "sales"))
    parts = sinks.file_parts(staged)
    assert len(parts) == 4 and sum(p.count() for p in parts) == 1000
    found = resolve_keys(star(spark, staged, False), "_row", parts)
    fact = sinks.load_parts(found, str(tmp_path / "fact"))
    assert fact.columns == ORDER_COLUMNS
    assert rows(fact) == sorted((expected(r) for r in staged.collect()), key=str)
    (whole,) = resolve_keys(star(spark, staged, False), "_row")
    assert rows(whole) == rows(fact)


def test_a_repeated_store_code_fails_only_if_a_sale_uses_it(spark, large):
    used = sales(spark).localCheckpoint()
    with pytest.raises(PySparkException, match="more than one store"):
        resolve_keys(star(spark, used), "_row")[0].collect()
    unused = used.where("store_code IS NULL OR store_code != 's12'")
    assert resolve_keys(star(spark, unused), "_row")[0].count() == unused.count()


def test_files_are_parted_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 10).write.parquet(path)
    df = spark.read.parquet(path)
    assert sinks.file_parts(df) == [df]
    monkeypatch.setattr(sinks, "PART_BYTES", 1)
    for most in (1, 3, 4, 20):
        monkeypatch.setattr(sinks, "MOST_PARTS", most)
        parts = sinks.file_parts(df)
        assert len(parts) == min(most, 10)
        assert sorted(r.id for p in parts for r in p.collect()) == list(range(1000))


def test_a_part_that_fails_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.load_parts([spark.range(2), spark.range(2, 4)], path)
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        sinks.load_parts([spark.range(7, 9), broken], path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,), (3,)]


def test_settings_are_set_back(spark):
    (name,) = SHUFFLES_DROPPED
    before = spark.conf.get(name)
    with session_settings(spark, SHUFFLES_DROPPED), session_settings(spark, {name: "false", "spark.starledger.test": "1"}):
        assert spark.conf.get(name) == "false" and spark.conf.get("spark.starledger.test") == "1"
    assert spark.conf.get(name) == before and spark.conf.get("spark.starledger.test", None) is None


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    folders = list(env.blockManager().diskBlockManager().localDirsString())
    return {str(f) for folder in folders for f in Path(folder).rglob("shuffle_*.data")}


def test_a_load_reads_its_sales_once_and_leaves_no_shuffles(spark, tmp_path, large):
    """Rejected sales come from the staged ones; every shuffle is deleted with its query."""
    read = spark.sparkContext.accumulator(0)

    def seen(key):
        read.add(1)
        return key

    raws = raw_all(spark, SF_DIR)
    given = [
        (n, None, "no uuid" if n == 4 else f"00000000-0000-4000-A000-{n:012d}", "R", "F", f"00000000-0000-4000-8000-{n:012d}",
         f"4{n:015d}", "S1", "P1" * (40 if n == 6 else 1), None, "many" if n == 9 else "3")
        for n in range(20)
    ]
    types = ", ".join(f"c{i} {'long' if i == 0 else 'string'}" for i in range(11))
    raws["orders"] = spark.createDataFrame(given, types).withColumn("c0", F.udf(seen, "long")("c0"))
    before = shuffle_files(spark)
    load_warehouse(raws, raw(spark, SF_DIR, "mapping"), RUN_TS, str(tmp_path), quarantine=True)
    # Files are deleted behind the query's end.
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert read.value == len(given)
    kept = spark.read.parquet(str(tmp_path / "load_rejected_rows")).where("table_name = 'orders_table'").collect()
    assert sorted((r.column_name, r.reason, r.place) for r in kept) == [
        ("date_uuid", "rejected value", None), ("product_code", "too long", None), ("product_quantity", "rejected value", None)
    ]
    (wrong,) = [r.row for r in kept if r.column_name == "date_uuid"]
    assert wrong == (
        '{"order_key":4,"date_uuid":"no uuid","user_uuid":"00000000-0000-4000-8000-000000000004","card_number":"4000000000000004",'
        '"store_code":"S1","product_code":"P1","product_quantity":"3"}'
    )
    fact = spark.read.parquet(str(tmp_path / "orders_table"))
    assert fact.columns == ORDER_COLUMNS and fact.count() == len(given)
    assert {(r.order_key, r.date_uuid) for r in fact.where("order_key IN (3, 4)").collect()} == {
        (3, "00000000-0000-4000-a000-000000000003"), (4, None)
    }
    assert sorted(p.name for p in tmp_path.iterdir() if "__" in p.name) == []
