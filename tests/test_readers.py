"""Readers against files that are odd, broken, or of several layouts, and table grids against plain Python."""

import gzip
import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starledger.sources import files, html
from tests.conftest import rows


def test_csv_whose_header_has_another_order_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\n1,2\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="a.csv"):
        files.read_csv(spark, str(tmp_path), "a long, b long").collect()


def test_csv_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a,c d\n1,2,x\n")
    (tmp_path / "b.csv").write_text('﻿a,other,b\n3,"say ""hi"", ok",4\n,,6\n')
    (tmp_path / "c.csv").write_text("a\n7\n")
    (tmp_path / "d.csv").write_text("")
    with gzip.open(tmp_path / "e f.csv.gz", "wt") as file:
        file.write("c d,a\n\"z,z\",8\n")
    schema = "a long, b long, `c d` string"
    found = files.read_csv_by_name(spark, str(tmp_path), schema)
    assert found.dtypes == [("a", "bigint"), ("b", "bigint"), ("c d", "string")]
    assert rows(found) == sorted([(2, 1, "x"), (3, 4, None), (None, 6, None), (7, None, None), (8, None, "z,z")], key=str)
    report = {r.file.rsplit("/", 1)[1]: (r.missing, r.extra) for r in files.csv_header_report(spark, str(tmp_path), schema).collect()}
    assert report == {
        "a.csv": ([], []), "b.csv": (["c d"], ["other"]), "c.csv": (["b", "c d"], []), "d.csv": (["a", "b", "c d"], []),
        "e f.csv.gz": (["b"], []),
    }
    scan = files.read_csv_by_name(spark, str(tmp_path / "a.csv"), schema).select("a")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:bigint>" in scan


def test_csv_by_name_refuses_what_is_unclear(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,a\n1,2,3\n")
    with pytest.raises(ValueError, match="more than once"):
        files.read_csv_by_name(spark, str(tmp_path), "a long")
    assert rows(files.read_csv_by_name(spark, str(tmp_path), "b long")) == [(2,)]
    (tmp_path / "b.csv").write_text("b\nx\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="b.csv"):
        files.read_csv_by_name(spark, str(tmp_path), "b long").collect()


def documents(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "document int, value string")


def test_json_by_columns_resolves_repeated_keys_and_keeps_nested_cells(spark):
    docs = documents(
        spark,
        '{"a":{"0":"x","1":"y"},"b":{"1":[1,{"k":2}]}}', ' \n\t [{"a":1.5},{"b":null,"a":"z","a":"last"}]',
        '{"a":{"0":"p","5":"gone"},"a":{"0":"q","0":"r"}}', "[]", "{}", '{"a":null,"b":{"2":true}}', None, '{"a":{"0":"] ["}}',
    )
    assert rows(files.columnar_records(docs, ["a", "b"])) == sorted([
        (0, 0, "x", None), (0, 1, "y", '[1,{"k":2}]'), (1, 0, "1.5", None), (1, 1, "last", None), (2, 0, "r", None),
        (5, 2, None, "true"), (7, 0, "] [", None),
    ], key=str)


BROKEN = ['{"a":{"0":1}}{"a":{"0":2}}', '[{"a":1}][{"a":2}]', '[{"a":1}] x', '{"a":{"0":1}}] [', "", "[{}],[{}]", '{"a":{"0":1}']


@pytest.mark.parametrize("text", BROKEN)
def test_json_with_anything_behind_it_fails(spark, text):
    docs = documents(spark, text)
    for found in (files.columnar_records(docs, ["a"]), files.keyed_records(docs, ["0"], "k")):
        with pytest.raises(PySparkException, match="malformed JSON document"):
            found.collect()


def test_json_column_that_is_no_object_fails(spark):
    with pytest.raises(PySparkException, match="without row labels"):
        files.columnar_records(documents(spark, '{"a":5}'), ["a"]).collect()


def test_json_names_with_quotes_and_dots(spark):
    docs = documents(spark, json.dumps([{"it's": "1", 'a"b': "2", "c.d": "3", "e f": "4"}]))
    found = files.columnar_records(docs, ["it's", 'a"b', "c.d", "e f"])
    assert rows(found) == [(0, 0, "1", "2", "3", "4")]
    with pytest.raises(ValueError):
        files.columnar_records(docs, ["'\""])


def test_json_by_key_keeps_one_row_of_a_repeated_key(spark):
    docs = documents(spark, '{"GB":{"n":"1","m":{"q":[1]}},"FR":{"n":"2"},"GB":{"n":"3"}}', '{"A":{"n":"] ["}}', "{}")
    assert rows(files.keyed_records(docs, ["n", "m"], "k")) == [(0, "A", "] [", None), (0, "GB", "3", None), (1, "FR", "2", None)]


def grid(table, width):
    """A table's cells (text, columns, rows) laid out; ``None`` in place of a row ends a section."""
    placed, row_no, first = {}, 0, 0
    for cells in table:
        if cells is None:
            placed = {at: text for at, text in placed.items() if at[0] < row_no}
            continue
        column = 0
        for text, across, down in cells:
            for _ in range(min(across, width)):
                while (row_no, column) in placed:
                    column += 1
                for k in range(down):
                    placed[row_no + k, column] = text
        row_no += 1
    return [[placed.get((n, c)) for c in range(width)] for n in range(row_no)]


def markup(table, closed, made):
    out = ["<table>"]
    for cells in table:
        if cells is None:
            out.append("</tbody><tbody>")
            continue
        out.append("<tr>")
        for text, across, down in cells:
            spans = (f' colspan="{across}"' if across > 1 or made.random() < 0.2 else "") + (f" ROWSPAN={down}" if down > 1 else "")
            out.append(f"<td class=x{spans}>{text}" + ("</td>" if closed else ""))
        out.append("</tr>" if closed else "")
    return "".join(out) + "</table>"


@pytest.mark.parametrize("width", [3, 6])
def test_spans_match_a_plain_grid(spark, width, monkeypatch):
    monkeypatch.setattr(html, "ROWS_AT_ONCE", 4)
    made = random.Random(width)
    tables = []
    for _ in range(40):
        table = []
        for r in range(made.randint(1, 12)):
            if made.random() < 0.1:
                table.append(None)
            table.append([(f"c{r}.{c}", made.choice([1, 1, 1, 2, 3]), made.choice([1, 1, 1, 2, 4])) for c in range(made.randint(1, 4))])
        tables.append(table)
    names = [f"n{c}" for c in range(width)]
    expected = {(n, k): row for n, table in enumerate(tables) for k, row in enumerate(grid(table, width))}
    for closed, harvest in ((True, html.harvest_tables), (True, html.harvest_tables_lenient), (False, html.harvest_tables_lenient)):
        pages = spark.createDataFrame([(n, markup(t, closed, made)) for n, t in enumerate(tables)], "page_id int, html string")
        found = {(r.page_id, r.row_no): [r[c] for c in names] for r in harvest(pages, 0, names).collect()}
        assert found == expected


def test_spans_of_a_header_end_with_it_and_odd_ones_count_as_one(spark):
    page = (
        "<table><thead><tr><th rowspan=9>h</th><th>i</th></tr></thead><tbody><tr><td rowspan=0>1</td><td colspan=x>2</td></tr>"
        "<tr><td rowspan='-3'>3</td></tr></tbody></table>"
    )
    pages = spark.createDataFrame([(1, page), (2, "<table></table>"), (3, None)], "page_id int, html string")
    expected = [(1, 0, True, "h", "i"), (1, 1, False, "1", "2"), (1, 2, False, "3", None)]
    assert rows(html.harvest_tables(pages, 0, ["a", "b"])) == expected
    assert rows(html.harvest_tables_lenient(pages, 0, ["a", "b"])) == expected


def test_character_references(spark):
    cells = {
        "&eacute;&Uuml;&euro;": "éÜ€", "&#8364;&#x20AC;&#X41;": "€€A", "&amp;lt;": "&lt;", "a &nope; b &": "a &nope; b &",
        "&#0;&#xD800;&#1114112;": "�" * 3, "&#150;&#128;": "–€", "&nbsp;x&nbsp;&nbsp;y&emsp;": "x y", "&#128512;": "😀", "&lt;b&gt;": "<b>",
    }
    page = "<table>" + "".join(f"<tr><td>{c}</td></tr>" for c in cells) + "</table>"
    pages = spark.createDataFrame([(1, page)], "page_id int, html string")
    expected = list(cells.values())
    assert [r.a for r in html.harvest_tables(pages, 0, ["a"]).orderBy("row_no").collect()] == expected
    assert [r.a for r in html.harvest_tables_lenient(pages, 0, ["a"]).orderBy("row_no").collect()] == expected


def test_every_named_character_is_found_among_few(spark):
    """A map is searched from end to end, so no reference may be looked for in the whole list."""
    named = {name: text for name, text in html.html5.items() if name.endswith(";")}
    parts = json.loads(html._entities())
    assert max(len(part) for part in parts) <= 12 and sum(map(len, parts)) == len(named) + 32
    texts = spark.createDataFrame([(f"&{name}", text) for name, text in named.items()], "text string, expected string")
    assert texts.where(~html.decoded(F.col("text")).eqNullSafe(F.col("expected"))).count() == 0


def test_cells_without_spans_raise_no_error(spark):
    """A tag without the attribute is no text to cast: the plan tries no cast of it."""
    tag = spark.createDataFrame([("td",), ("td rowspan=3",), ("td rowspan='00'",)], "tag string")
    found = tag.select(html._span(F.col("tag"), "rowspan").alias("n"))
    assert sorted(r.n for r in found.collect()) == [1, 1, 3]
    assert "try_cast" not in found._jdf.queryExecution().toString().lower()


def test_a_long_table_with_spans(spark):
    """Twenty thousand rows, every third of which goes on with the cell above."""
    body = "".join(f"<tr><td rowspan=3>g{n}</td><td>{n}a</td></tr><tr><td>{n}b</td></tr><tr><td>{n}c</td></tr>" for n in range(7000))
    pages = spark.createDataFrame([(1, f"<table>{body}</table>")], "page_id int, html string")
    found = html.harvest_tables(pages, 0, ["a", "b"])
    wrong = found.where(F.col("a") != F.concat(F.lit("g"), F.regexp_replace("b", "[abc]$", "")))
    assert found.count() == 21_000 and wrong.count() == 0
