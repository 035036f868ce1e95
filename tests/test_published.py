"""Published tables, replacing loads that fail, stable keys, buckets, stored views, quarantine, bitmap audits."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starledger.bindings.relations import bucketed_dates
from starledger.bindings.reports import store_views
from starledger.bindings.tables import raw, raw_all
from starledger.operators import audits
from starledger.operators.keys import number_few_rows, number_rows, stable_keys
from starledger.plans.view_sql import STORED_VIEWS
from starledger.plans.views import VIEWS
from starledger.plans.warehouse import load_warehouse
from starledger.sources import sinks
from starledger.sources.published import Manifest, PublishConflict, Published
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.001"


def table(spark, *numbers):
    return spark.createDataFrame([(n, str(n)) for n in numbers], "n long, t string")


def failing(spark):
    return table(spark, 1, 2, 3).withColumn("t", F.when(F.col("n") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("t")))


def test_versions_and_batches(spark, tmp_path):
    published = Published(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="nothing was published"):
        published.read()
    assert published.manifest() is None
    first = published.publish(table(spark, 1, 2))
    published.publish(table(spark, 3).select("t", "n"), "append", "b")
    assert published.publish(table(spark, 4), "append", "b").count() == 3
    assert rows(published.read()) == [(1, "1"), (2, "2"), (3, "3")] and published.versions() == [1, 2]
    # What was read stays readable.
    published.publish(table(spark, 9))
    assert rows(first) == [(1, "1"), (2, "2")] and rows(published.read(2)) == rows(published.read(1)) + [(3, "3")]
    assert rows(published.read()) == [(9, "9")]
    # After a replacement the batch is a new one.
    assert published.publish(table(spark, 4), "append", "b").count() == 2
    published.expire(1)
    assert published.versions() == [4] and rows(published.read()) == [(4, "4"), (9, "9")]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2
    with pytest.raises(ValueError, match="no version"):
        published.read(1)
    with pytest.raises(ValueError, match="do not fit"):
        published.publish(table(spark, 1).withColumn("n", F.lit("x")), "append")
    with pytest.raises(ValueError, match="unknown load condition"):
        published.publish(table(spark, 1), "merge")


def test_a_failing_publication_changes_nothing(spark, tmp_path):
    published = Published(spark, str(tmp_path / "t"))
    published.publish(table(spark, 1, 2))
    for condition in ("replace", "append"):
        with pytest.raises(PySparkException):
            published.publish(failing(spark), condition)
    # Tasks that still ran when the load failed may leave a folder, which no version names.
    assert published.versions() == [1] and rows(published.read()) == [(1, "1"), (2, "2")]
    assert len(published.manifest().parts) == 1


def test_two_loads_cannot_publish_one_version(spark, tmp_path):
    published = Published(spark, str(tmp_path / "t"))
    published.publish(table(spark, 1))
    with pytest.raises(PublishConflict):
        published._put(Manifest(1, [], [], {}))
    assert rows(published.read()) == [(1, "1")]


def test_a_failing_load_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.load_table(table(spark, 1, 2), path, "replace")
    with pytest.raises(PySparkException):
        sinks.load_table(failing(spark), path, "replace")
    assert rows(spark.read.parquet(path)) == [(1, "1"), (2, "2")]
    assert rows(sinks.load_table(table(spark, 7), path, "replace")) == [(7, "7")]


def test_keys_hold_from_load_to_load(spark):
    names = "name string, v long"
    first, map_1 = stable_keys(spark.createDataFrame([("b", 1), ("d", 2), (None, 3), ("b", 4)], names), "name", "key")
    assert rows(first) == sorted([("b", 1, 1), ("d", 2, 2), (None, 3, None), ("b", 4, 1)], key=str) and rows(map_1) == [("b", 1), ("d", 2)]
    second, map_2 = stable_keys(spark.createDataFrame([("a", 1), ("d", 2), ("c", 3)], names), "name", "key", map_1)
    assert rows(second) == [("a", 1, 3), ("c", 3, 4), ("d", 2, 2)] and rows(map_2) == [("a", 3), ("c", 4)]
    third, map_3 = stable_keys(second.drop("key"), "name", "key", map_1.union(map_2))
    assert rows(third) == rows(second) and map_3.count() == 0
    with pytest.raises(ValueError, match="already"):
        stable_keys(first, "name", "key")


def test_few_rows_are_numbered_as_many_are(spark):
    df = spark.range(500).select((F.col("id") % 37).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 11).alias("b"), "id")
    for order in (["a"], ["b", "a"]):
        assert rows(number_few_rows(df, order, "k")) == rows(number_rows(df, order, "k"))


def test_bucketed_tables_join_without_an_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = bucketed_dates(spark, SF_DIR)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan


def test_a_second_session_reads_the_stored_views(spark):
    store_views(spark, SF_DIR, "stored_views_test")
    other = spark.newSession()
    assert other is not spark
    found = {name: other.table(f"stored_views_test.{name}") for name in STORED_VIEWS}
    assert set(found) == set(VIEWS) and all(df.count() > 0 for df in found.values())
    totals = [r.total_sales for r in found["store_sales_breakdown_germany"].collect()]
    assert totals == sorted(totals, reverse=True)


def test_quarantine_holds_what_the_report_counts(spark, tmp_path):
    raws = raw_all(spark, SF_DIR)
    # One value that misfits its type beside the dropped rows.
    raws["users"] = raws["users"].withColumn("user_uuid", F.when(F.col("position") == 4, F.lit("no uuid")).otherwise(F.col("user_uuid")))
    load_warehouse(raws, raw(spark, SF_DIR, "mapping"), "2024-11-30 13:55:07", str(tmp_path), quarantine=True)
    report = spark.read.parquet(str(tmp_path / "load_rejects")).where("rows > 0")
    kept = spark.read.parquet(str(tmp_path / "load_rejected_rows"))
    assert rows(kept.groupBy("table_name", "column_name", "reason").count()) == rows(report)
    one = kept.where("reason = 'rejected value' AND column_name = 'user_uuid' AND table_name = 'land_user_data'").collect()
    assert len(one) == 1 and '"user_uuid":"no uuid"' in one[0].row
    assert kept.where("reason = 'dropped row' AND place IS NULL").count() == 0


def test_bitmap_audits_agree_with_the_others(spark):
    keys = [*range(-3, 70_000, 7), 7, 7, 14, 33_000 * 7, None, None, 2**40]
    fact = spark.createDataFrame([(k, (k or 0) % 1000) for k in keys], "k long, other int")
    unique = fact.where("k IS NOT NULL").select("k").distinct()
    tables = {"repeated": (fact, "k"), "unique": (unique, "k"), "none": (fact.limit(0), "k")}
    assert rows(audits.audit_pk_bitmaps(tables)) == rows(audits.audit_pk_summary(tables))
    dim = unique.where("k % 5 <> 0")
    for references in ({"k": (dim, "k"), "other": (unique, "k")}, {"k": (unique, "k")}, {"k": (dim.limit(0), "k")}):
        expected = {r.fk: (r.orphan_keys, r.orphan_rows) for r in audits.audit_fk(fact, references).collect()}
        assert {r.fk: (r.orphan_keys, r.orphan_rows) for r in audits.audit_fk_bitmaps(fact, references).collect()} == expected
