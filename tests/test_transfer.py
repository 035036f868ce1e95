import json
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from starledger.operators.rejects import Rejects
from starledger.operators.rows import DEFAULT_MEMBERS, literal_rows, subset_filter
from starledger.schemas import (
    DIM_TABLES, LAYOUTS, TABLE_LAYOUTS, alter_types, enforce_schema, max_length, parse_type,
    schema_rejects, struct_type,
)
from starledger.session import materialised, scratch_path, scratch_scope
from starledger.sources import files, html, sinks
from tests.conftest import rows


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("col1,col2\nvalue1,value2\n")
    assert rows(files.read_csv(spark, str(tmp_path), "col1 string, col2 string")) == [("value1", "value2")]


def test_json_by_columns(spark, tmp_path):
    text = {"a": {"0": "x", "1": "y"}, "b": {"1": 5, "2": None}, "unused": {"0": 1}}
    (tmp_path / "a.json").write_text(json.dumps(text, indent=1))
    got = files.read_json_columnar(spark, str(tmp_path), ["a", "b"]).drop("document")
    assert rows(got) == [(0, "x", None), (1, "y", "5"), (2, None, None)]


def test_json_by_key(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n"GB": {"n": "Ünited", "s": "£"},\n"DE": {"n": "G"}\n}')
    got = files.read_json_keyed(spark, str(tmp_path), ["n", "s"], "code")
    assert rows(got) == [(0, "GB", "Ünited", "£"), (1, "DE", "G", None)]


def test_mapping_file_last_line_wins(spark, tmp_path):
    (tmp_path / "m.txt").write_text("US Dollar,USD\nEuro,XXX\nEuro,EUR\n")
    assert rows(files.read_mapping_file(spark, str(tmp_path))) == [("Euro", "EUR"), ("US Dollar", "USD")]


def test_jdbc_options():
    options = files.jdbc_options("jdbc:x", "t", "id", 0, 100, 4, fetchsize="1000")
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id"
    assert options["upperBound"] == "100" and options["fetchsize"] == "1000"


PAGE = """<html><table><tr><td>menu</td></tr></table>
<TABLE class="r"><thead><tr><th>name</th><th>rate</th></tr></thead>
<tr><td>US&nbsp;Dollar</td><td> 1.25 </td></tr>
<tr><td><a href='x'>A &amp; B</a></td><td></td></tr></TABLE></html>"""
LOOSE = """<table><tr><td>menu</table><table><tr><th>name<th>rate<tr><td>US&nbsp;Dollar<td> 1.25
<tr><td>A &amp; B <table><tr><td>inner</td></tr></table><td></table>"""


def test_html_tables(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>none</p>"), (3, None)], "page_id long, html string")
    expected = [(1, 0, True, "name", "rate"), (1, 1, False, "US Dollar", "1.25"), (1, 2, False, "A & B", None)]
    assert rows(html.harvest_tables(pages, 1, ["name", "rate"])) == expected
    assert html.harvest_tables(pages, 2, ["name"]).count() == 0
    assert rows(html.harvest_tables_lenient(pages, 1, ["name", "rate"])) == expected


def test_html_tables_from_loose_markup(spark):
    pages = spark.createDataFrame([(1, LOOSE)], "page_id long, html string")
    got = html.harvest_tables_lenient(pages, 1, ["name", "rate"])
    assert rows(got.select("row_no", "name", "rate")) == [
        (0, "name", "rate"), (1, "US Dollar", "1.25"), (2, "A & B inner", None),
    ]


def test_load_conditions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "GB"), (2, "FR")], "store_key long, country_code string")
    assert rows(sinks.load_table(df, path, "fail", subset=["GB"])) == [(1, "GB")]
    with pytest.raises(AnalysisException):
        sinks.load_table(df, path, "fail")
    assert sinks.load_table(df, path, "append").count() == 3
    assert sinks.load_table(df, path, "replace").count() == 2
    assert sinks.truncate_table(spark, path).count() == 0
    with pytest.raises(ValueError):
        sinks.load_table(df, path, "merge")


def test_load_steps_in_order(spark):
    df = spark.createDataFrame(
        [("1", "Still_avaliable", "GB"), ("2", "odd", "DE"), ("x", "Removed", "FR")],
        "product_key string, availability string, country_code string",
    )
    first = [{"product_key": 0, "availability": "kept as given"}]
    got = sinks.prepare_load(df, {"Still_avaliable": "True", "Removed": "False"}, ["GB", "DE"], first)
    assert rows(got) == [("0", "kept as given", None), ("1", "True", "GB"), ("2", None, "DE")]


def test_subset_falls_back_to_the_currency(spark):
    df = spark.createDataFrame([("USD",), ("JPY",), (None,)], "currency_code string")
    assert rows(subset_filter(df, ["USD", "EUR"])) == [("USD",)]
    with pytest.raises(ValueError):
        subset_filter(df.withColumnRenamed("currency_code", "c"), ["USD"])


def test_create_tables_and_default_members(spark, tmp_path):
    tables = sinks.create_tables(spark, str(tmp_path))
    assert set(tables) == set(TABLE_LAYOUTS) and len(tables) == 15
    for table in DIM_TABLES.values():
        layout = struct_type(TABLE_LAYOUTS[table])
        assert tables[table].schema == layout
        assert literal_rows(spark, layout, DEFAULT_MEMBERS[table]).count() == 2


def test_types():
    assert parse_type("NUMERIC(20,6)").simpleString() == "decimal(20,6)"
    assert parse_type("VARCHAR(255)").simpleString() == "string"
    assert parse_type("SMALLINT").simpleString() == "smallint"
    assert max_length("VARCHAR(30)") == 30 and max_length("DATE") is None
    with pytest.raises(ValueError):
        parse_type("MONEY")


def test_typed_load_counts_its_rejects(spark):
    df = spark.createDataFrame([("1", "2001-02-03", "y" * 60), ("x", "soon", None)],
                               "user_key string, join_date string, phone_number string")
    typed = enforce_schema(df, LAYOUTS["users"])
    assert [r["user_key"] for r in typed.collect()] == [1, None]
    assert rows(schema_rejects(df, LAYOUTS["users"])) == [
        ("join_date", 1, 0), ("phone_number", 0, 1), ("user_key", 1, 0),
    ]


def test_strict_casts_fail(spark):
    df = spark.createDataFrame([("1", "no-uuid")], "n string, u string")
    assert alter_types(df, {"n": "SMALLINT"}).dtypes[0] == ("n", "smallint")
    with pytest.raises(PySparkException):
        alter_types(df, {"u": "UUID"}).collect()
    with pytest.raises(PySparkException):
        alter_types(df.withColumn("n", F.lit("x")), {"n": "SMALLINT"}).collect()


def test_a_shape_is_matched_once(spark):
    """Counting what does not fit and typing it share one match; flags are not in the result."""
    texts = spark.createDataFrame([("00000000-0000-4000-8000-00000000000A",), ("x",), (None,)], "date_uuid string")
    rejects = Rejects(keep=True)
    watched = rejects.lost(texts, "orders_table", TABLE_LAYOUTS["orders_table"])
    found = enforce_schema(watched, TABLE_LAYOUTS["orders_table"])
    assert found.columns == ["date_uuid"]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 1
    assert sorted(r.date_uuid or "" for r in found.collect()) == ["", "", "00000000-0000-4000-8000-00000000000a"]
    assert rows(rejects.frame(spark).where("rows > 0")) == [("orders_table", "date_uuid", "rejected value", 1)]
    assert [r.row for r in rejects.rows(spark).collect()] == ['{"date_uuid":"x"}']


def test_load_counts_what_it_loses(spark, tmp_path):
    df = spark.createDataFrame([("1", "x" * 31), ("no", "y")], "card_key string, card_number string")
    rejects = Rejects()
    loaded = sinks.load_table(df, str(tmp_path / "t"), "replace", "dim_card_details", rejects)
    assert rows(loaded.select("card_key")) == [(1,), (None,)]
    assert rows(rejects.frame(spark).where("rows > 0")) == [
        ("dim_card_details", "card_key", "rejected value", 1), ("dim_card_details", "card_number", "too long", 1),
    ]


def test_broken_documents_fail(spark, tmp_path):
    lines = ['{"a": {"0": "x"}}', "", '{"a": {"0": "y"', '[{"a": "z"}]']
    for n, broken in enumerate((False, True)):
        path = tmp_path / f"d{n}.json"
        path.write_text("\n".join(line for line in lines if broken or line.endswith(("}", "]"))))
        read = files.read_json_columnar(spark, str(path), ["a", "b"], one_per_line=True).select("row_id", "a", "b")
        if broken:
            with pytest.raises(PySparkException, match="malformed JSON"):
                read.collect()
        else:
            assert rows(read) == [(0, "x", None), (0, "z", None)]
    keyed = spark.createDataFrame([('{"GB": {"n": "1"',)], "value string")
    with pytest.raises(PySparkException, match="malformed JSON"):
        files.keyed_records(keyed, ["n"], "code").collect()


def test_csv_records_that_do_not_fit_fail(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,"two\nlines"\n')
    assert rows(files.read_csv(spark, str(path), "a long, b string", multiline=True)) == [(1, "two\nlines")]
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)malformed"):
        files.read_csv(spark, str(path), "a long, b string").collect()


def test_scratch_of_a_load_is_deleted(spark, tmp_path):
    with scratch_scope(spark) as folder:
        materialised(spark.range(5), "x")
        assert len(list(Path(folder.removeprefix("file://")).iterdir())) == 1
    assert not Path(folder.removeprefix("file://")).exists()


def test_scratch_paths_are_fresh(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
