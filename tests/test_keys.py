from pyspark.sql import functions as F

from starledger.operators.keys import key_dense, key_ordinal
from starledger.operators.order import gaps_by_group, lead_rows, previous_value, sort_rows
from starledger.operators.rejects import Rejects
from starledger.operators.rows import (
    dedupe_rows, default_members, drop_last_seen_values, prepend_literal_row, union_tables,
)
from tests.conftest import rows


def test_dense_keys_follow_the_source_order(spark):
    df = spark.range(10_000).select((F.col("id") * 7 % 10_007).alias("p"), F.lit("x").alias("v"))
    got = key_dense(df, ["p"], "k").orderBy("k").collect()
    assert [r["k"] for r in got] == list(range(1, 10_001))
    assert [r["p"] for r in got] == sorted(r["p"] for r in got)


def test_dense_keys_over_one_big_group_of_copies(spark):
    df = spark.range(6_000).select(F.when(F.col("id") < 4_000, 5).otherwise(F.col("id")).alias("p"))
    got = key_dense(df, ["p"], "k").collect()
    assert sorted(r["k"] for r in got) == list(range(1, 6_001))
    assert max(r["k"] for r in got if r["p"] == 5) == 4_000


def test_dense_key_replaces_the_source_index(spark):
    df = spark.createDataFrame([(30, "c"), (10, "a"), (20, "b")], "k long, v string")
    assert rows(key_dense(df, ["k"], "k").select("k", "v")) == [(1, "a"), (2, "b"), (3, "c")]


def test_dense_keys_skip_dropped_rows(spark):
    df = spark.createDataFrame([(3, "c"), (1, None), (2, "b"), (4, "d")], "p long, v string")
    got = key_dense(df, ["p"], "k", {"v": F.col("v").isNotNull()})
    assert got.columns == ["p", "v", "k"] and rows(got) == [(2, "b", 1), (3, "c", 2), (4, "d", 3)]


def test_ordinal_keys_keep_gaps(spark):
    df = spark.range(10).select(F.col("id").alias("p"))
    keep = {"p": F.col("p") % 3 != 0}
    expected = [(p, p + 1) for p in range(10) if p % 3]
    assert rows(key_ordinal(df, ["p"], "k", keep)) == expected
    assert rows(key_ordinal(df, ["p"], "k", keep, dense=True)) == expected


def test_ties_do_not_follow_the_file_layout(spark):
    df = spark.range(3_000).select((F.col("id") % 5).alias("p"), F.col("id").alias("v"))
    one, seven = (rows(key_dense(df.repartition(n), ["p"], "k")) for n in (1, 7))
    assert one == seven


def test_dropped_rows_are_watched(spark):
    df = spark.createDataFrame([(3, "c"), (1, None), (2, None), (4, "d")], "p long, v string")
    rules = {"v": F.col("v").isNotNull(), "p": F.col("p") != 1}
    for dense in (None, False, True):
        rejects = Rejects()
        watch = lambda frame, given: rejects.dropped(frame, "t", given)  # noqa: E731, B023
        keyed = key_dense(df, ["p"], "k", rules, watch) if dense is None else key_ordinal(df, ["p"], "k", rules, dense, watch)
        assert keyed.columns == ["p", "v", "k"] and keyed.count() == 2
        assert rows(rejects.frame(spark)) == [("t", "p", "dropped row", 1), ("t", "v", "dropped row", 2)]


def test_empty_frame_gets_no_keys(spark):
    assert key_dense(spark.range(0), ["id"], "k").count() == 0


def test_union_tables_numbers_afresh(spark):
    a = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "n long, v string")
    assert rows(union_tables([a, a], "n")) == [
        (0, "a"), (1, "b"), (2, "c"), (3, "a"), (4, "b"), (5, "c"),
    ]
    assert union_tables([], "n", a.schema, spark).schema == a.schema


def test_dedupe_keeps_the_first_position(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, None)], "n long, v string")
    assert rows(dedupe_rows(df, "n")) == [(1, "a"), (2, None)]


def test_last_seen_values_go(spark):
    data = [(0, "a"), (1, "b"), (2, None), (3, "c"), (4, "a"), (5, "d"), (6, None)]
    df = spark.createDataFrame(data, "n long, v string")
    assert rows(drop_last_seen_values(df, "v", "n", 3)) == [(0, "a"), (1, "b"), (4, "a")]


def test_rows_in_front(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "user_key long, first_name string, last_name string")
    assert rows(default_members(df, "dim_users").select("user_key", "first_name")) == [
        (-1, "Not Applicable"), (0, "Unknown"), (1, "a"),
    ]
    numbered = spark.createDataFrame([(0, "x")], "n long, v string")
    assert rows(prepend_literal_row(numbered, {"v": "first"}, "n")) == [(-1, "first"), (0, "x")]


def test_previous_value_equals_a_global_lead(spark):
    df = spark.range(3_000).select((F.col("id") * 31 % 500).alias("t"), "id")
    df = df.union(spark.range(2_000).select(F.lit(77).cast("long"), "id"))
    literal = spark.sql(
        """SELECT value, next_value, count(*) AS row_count FROM (
               SELECT t AS value, lead(t) OVER (ORDER BY t DESC) AS next_value FROM {df})
           GROUP BY ALL""",
        df=df,
    )
    assert rows(previous_value(df, "t")) == rows(literal)


def test_gaps_by_group_equal_a_global_lead(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 4001).alias("t"))
    df = df.withColumn("g", F.floor(F.col("t") / 600))
    literal = spark.sql(
        """SELECT g, sum(gap) AS total, count(gap) AS gaps FROM (
               SELECT g, t - lead(t) OVER (ORDER BY t DESC) AS gap FROM {df}) GROUP BY g""",
        df=df,
    )
    assert rows(gaps_by_group(df, "g", "t")) == rows(literal)


def test_a_group_with_one_row_has_no_gap_only_if_it_is_the_oldest(spark):
    df = spark.createDataFrame([(1, 10), (2, 50)], "g int, t long")
    assert rows(gaps_by_group(df, "g", "t")) == [(1, 0, 0), (2, 40, 1)]


def test_sort_spreads_ties_and_keeps_the_order(spark):
    df = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"))
    ordered = sort_rows(df, F.desc_nulls_first("v"))
    values = [r["v"] for r in ordered.collect()]
    assert values == sorted(values, reverse=True) and ordered.columns == ["v"]


def test_lead_of_rows_needs_one_exchange(spark):
    """A value with a third of all rows, ties, missing values, and partitions without rows."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(500)).when(F.col("id") % 41 > 0, F.col("id") * 7919 % 1000).alias("v"), F.col("id").alias("n")
    )
    values = sorted((r.v for r in df.collect() if r.v is not None), reverse=True)
    expected = sorted(zip(values, [*values[1:], None]), key=str)
    found = lead_rows(df, "v")
    assert found.columns == ["v", "n", "next_value"]
    assert sorted(((r.v, r.next_value) for r in found.collect()), key=str) == expected
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Only the partitions' ends, one row each, are exchanged when the table is read.
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    assert rows(lead_rows(df.limit(1).select("v"), "v")) == [(500, None)] and lead_rows(df.limit(0), "v").count() == 0
