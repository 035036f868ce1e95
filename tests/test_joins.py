import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starledger.operators import skew
from starledger.operators.audits import audit_fk, audit_pk, row_reconciliation
from starledger.operators.joins import (
    fill_unknown_keys, link_currency_rate, lookup_scalar, merge_frames, resolve_fk,
)
from tests.conftest import rows


def skewed(spark, n=30_000):
    """A third of the rows on key 7, a tenth without key, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 900)
    return spark.range(n).select(key.cast("long").alias("k"), "id", F.lit("x").alias("same"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_a_plain_join(spark, how):
    left = skewed(spark)
    right = spark.range(600).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    # Key 7 and 8 twice, so the join multiplies rows of a heavy key.
    right = right.union(spark.createDataFrame([(7, -1), (8, -1)], "k long, v long"))
    plain = left.join(right, "k", how).select("k", "id", "same", "v")
    assert rows(skew.salted_join(left, right, "k", how)) == rows(plain)


def test_heavy_keys_are_counted_in_about_one_row_per_row(spark, monkeypatch):
    """Several keys, none or some heavy, nulls among them: exact shares, and no row per key and row on the way."""
    df = spark.range(10_000).select(
        F.when(F.col("id") % 4 > 0, F.col("id")).alias("a"), (F.col("id") % 2).alias("b"), "id", F.lit(None).cast("string").alias("n")
    )
    made = []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: made.append(self._jdf.queryExecution()) or collect(self))
    profile = skew.KeyProfile(df, "a", "b", "id", ["a", "b"], "n")
    assert sorted(profile.heavy("b").values()) == [0.5, 0.5] and list(profile.heavy("a").values()) == [0.25]
    assert profile.heavy("id") == {} and list(profile.heavy(("a", "b")).values()) == [0.25] and list(profile.heavy("n").values()) == [1.0]
    assert "inline" not in made[-1].optimizedPlan().toString().lower()


def test_profile_finds_the_heavy_keys(spark):
    left = skewed(spark)
    profile = skew.KeyProfile(left, "k", ["k", "same"])
    heavy = profile.heavy("k")
    hashes = spark.range(1).select(
        F.xxhash64(F.lit(7).cast("long")).alias("seven"), F.xxhash64(F.lit(None).cast("long")).alias("none")
    ).first()
    assert hashes["seven"] in heavy and hashes["none"] in heavy
    assert len(heavy) == 2
    assert len(profile.heavy(["k", "same"])) == 2
    assert skew.KeyProfile(spark.range(50_000), "id").heavy("id") == {}
    assert skew.KeyProfile(spark.range(0), "id").heavy("id") == {}


def test_salts_follow_the_shuffle_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert skew.default_salts(spark) == skew.MIN_SALTS
        spark.conf.set("spark.sql.shuffle.partitions", "20000")
        assert skew.default_salts(spark) == 40_000
        shares = {n: 0.33 if n == 0 else 0.0021 for n in range(300)}
        salts = {h: n for n, hashes in skew.salt_counts(shares, 40_000).items() for h in hashes}
        assert salts[0] >= 40_000 * 0.33 and sum(salts.values()) <= 4 * 40_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_salted_join_spreads_the_heavy_key(spark):
    """Also where the rows of the key come from few partitions."""
    left = skewed(spark).coalesce(2)
    right = spark.range(900).select(F.col("id").alias("k"), F.col("id").alias("v"))
    before = {n: spark.conf.get(n) for n in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(left, right, "k").withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("p").count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 30_000 and max(sizes) < 2 * 30_000 / 8


def test_salted_join_refuses_keys_of_different_type(spark):
    with pytest.raises(ValueError):
        skew.salted_join(skewed(spark), spark.createDataFrame([(7, 1)], "k int, v int"), "k")


def test_size_check(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 100).alias("t"))
    assert skew.measured_small(df, 100, 100_000)
    assert not skew.measured_small(df, 99, 100_000)
    assert not skew.measured_small(df, 100, 1_000)


def test_priced_totals_both_ways(spark, monkeypatch):
    sales = spark.range(5_000).select(
        (F.col("id") % 40).alias("product_key"),
        (F.col("id") % 3).alias("store"),
        (F.col("id") % 7).cast("smallint").alias("product_quantity"),
    )
    prices = spark.range(30).select(
        F.col("id").alias("product_key"), (F.col("id") / 4).cast("decimal(12,2)").alias("product_price")
    )
    for how in ("inner", "left"):
        monkeypatch.undo()
        small = rows(skew.priced_totals(sales, prices, "product_key", ["store"], how))
        monkeypatch.setattr(skew, "measured_small", lambda df, *bounds: False)
        assert rows(skew.priced_totals(sales, prices, "product_key", ["store"], how)) == small


def check_resolve(spark):
    fact = skewed(spark, 3_000)
    dim = spark.createDataFrame([(7, 20), (7, 10), (8, 30), (None, 40)], "k long, key long")
    got = resolve_fk(fact, dim, "k", "key")
    assert got.count() == fact.count()
    assert rows(got.where("key IS NOT NULL").groupBy("k", "key").count().select("k", "key")) == [
        (7, 10), (8, 30),
    ]
    assert got.columns == [*fact.columns, "key"]


def test_resolve_fk(spark):
    check_resolve(spark)


def test_resolve_fk_shuffled(spark, large):
    check_resolve(spark)


def test_resolve_fk_keeps_the_old_key_of_unmatched_rows(spark):
    fact = spark.createDataFrame([("a", 5), ("b", 6), ("c", None)], "code string, key long")
    dim = spark.createDataFrame([("a", 1)], "code string, key long")
    assert rows(resolve_fk(fact, dim, "code", "key")) == [("a", 1), ("b", 6), ("c", None)]


def test_lookup_scalar(spark):
    fact = spark.createDataFrame([("a", "old"), ("b", "old"), (None, "old")], "code string, v string")
    dim = spark.createDataFrame([("a", "1"), ("x", "2"), ("x", "3")], "code string, v string")
    # The unmatched lose their value, and an ambiguous code nobody uses does no harm.
    assert rows(lookup_scalar(fact, dim, "code", "v")) == [("a", "1"), ("b", None), (None, None)]
    used = fact.union(spark.createDataFrame([("x", "old")], "code string, v string"))
    with pytest.raises(PySparkException, match="more than one v"):
        lookup_scalar(used, dim, "code", "v").collect()


def test_link_currency_and_unknown_keys(spark):
    currency = spark.createDataFrame(
        [(1, "GBP", None), (-1, "Not Applicable", -1)],
        "currency_key long, currency_code string, currency_conversion_key long",
    )
    rate = spark.createDataFrame([(9, "GBP")], "currency_conversion_key long, currency_code string")
    assert rows(link_currency_rate(currency, rate)) == [(-1, "Not Applicable", -1), (1, "GBP", 9)]
    fact = spark.createDataFrame([(None,), (3,)], "card_key long")
    assert rows(fill_unknown_keys(fact, ["card_key"])) == [(0,), (3,)]


@pytest.mark.parametrize("how", ["left", "right", "inner", "outer"])
def test_merge_equals_pandas(spark, how):
    a = pd.DataFrame({"k": [1, 1, 2, None, 4], "s": ["a", "a", "b", "c", None], "x": range(5)})
    b = pd.DataFrame({"k": [1, 2, None, 4, 9], "s": ["a", "b", "c", None, "z"], "y": range(5)})
    expected = a.merge(b, how=how)
    schema = "k double, s string, {} long"

    def spark_frame(frame, last):
        clean = [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
        return spark.createDataFrame(clean, schema.format(last))

    got = merge_frames(how, spark_frame(a, "x"), spark_frame(b, "y"))
    clean = [tuple(None if pd.isna(v) else v for v in r) for r in expected.itertuples(index=False)]
    assert got.columns == list(expected.columns)
    assert rows(got) == sorted(((r[0], r[1], *[None if v is None else int(v) for v in r[2:]]) for r in clean), key=str)


def test_merge_needs_a_known_kind_and_common_columns(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        merge_frames("cross", df, df)
    with pytest.raises(ValueError):
        merge_frames("left", df, df.withColumnRenamed("id", "other"))


def test_audits(spark):
    fact = spark.createDataFrame([(1, 5), (1, None), (2, 6), (None, 6)], "a long, b long")
    dim = spark.createDataFrame([(1,), (3,)], "key long")
    assert rows(audit_pk(fact, ["a"])) == [(1, 2), (None, 1)]
    assert rows(audit_fk(fact, {"a": (dim, "key"), "b": (dim, "key")})) == [("a", 1, 1), ("b", 2, 3)]
    assert rows(row_reconciliation(fact, dim)) == [(4, 2, 2, False)]


def test_references_are_counted_by_number(spark):
    """Keys go through the shuffle with a number, not with the name of their reference."""
    fact = spark.createDataFrame([(1, 2), (3, None)], "first_key int, second_key int")
    dim = spark.createDataFrame([(1,)], "key int")
    found = audit_fk(fact, {"first_key": (dim, "key"), "second_key": (dim, "key")})
    assert rows(found) == [("first_key", 1, 1), ("second_key", 1, 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "stack(2, 0," in plan
