"""Registered sources and sinks: data from the tables goes out in a format and is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from starledger.bindings.pipelines import CLEAN_CARDS
from starledger.bindings.registry import register
from starledger.bindings.tables import raw, table
from starledger.operators.columns import AVAILABILITY_TEXTS
from starledger.operators.keys import number_rows, stable_keys
from starledger.operators.rows import DEFAULT_MEMBERS
from starledger.plans import pipelines
from starledger.schemas import DIM_TABLES, LAND_TABLES, RAW_TABLES, TABLE_LAYOUTS
from starledger.session import scratch_path
from starledger.sources import files, html, sinks
from starledger.sources.published import Published

# A document or page holds this many records, whatever keys the table repeats.
RECORDS = 500
ROWS_PER_PAGE = 50


def numbered(spark, sf_dir, name, key):
    """Rows of a table with ``n`` = 0, 1, 2, ... along its key."""
    return number_rows(table(spark, sf_dir, name), [key], "n").withColumn("n", F.col("n") - 1)


def numbered_sql(name, key):
    return f"(SELECT *, row_number() OVER (ORDER BY {key}) - 1 AS n FROM {name})"


@register("src_csv", """
    SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
        o_orderpriority FROM orders""")
def src_csv(spark, sf_dir):
    schema = """o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate date,
        o_orderpriority string"""
    path = scratch_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    orders.drop("o_custkey").write.option("header", True).csv(path)
    return files.read_csv(spark, path, schema)


@register("src_csv_by_name", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus, o_totalprice,
        CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""")
def src_csv_by_name(spark, sf_dir):
    """Files in two orders of columns; the second lacks one of them and has another."""
    path = scratch_path(spark, "csv-by-name")
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    first = orders.where("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    second = orders.where("o_orderkey % 2 <> 0").select("o_orderdate", "o_orderpriority", "o_totalprice", "o_orderkey")
    for part in (first, second):
        part.write.mode("append").options(**files.CSV_OPTIONS).csv(path)
    return files.read_csv_by_name(spark, path, "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate date")


def _note(spark: bool) -> str:
    """Text with quotes, commas, backslashes and line breaks."""
    line_break = "char(10)" if spark else "chr(10)"
    backslash = "char(92)" if spark else "chr(92)"
    return (
        f"CASE o_orderkey % 4 WHEN 0 THEN 'say \"' || o_orderpriority || '\", ok' "
        f"WHEN 1 THEN o_orderpriority || ',' || {line_break} || '\"second line\"' "
        f"WHEN 2 THEN {backslash} || o_orderstatus || {backslash} ELSE '\"' END"
    )


@register("src_csv_quoted", f"SELECT o_orderkey, {_note(False)} AS note, o_custkey FROM orders")
def src_csv_quoted(spark, sf_dir):
    path = scratch_path(spark, "csv-quoted")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_note(True)} AS note", "o_custkey")
    sinks.export_csv(orders, path, orders.columns)
    return files.read_csv(spark, path, "o_orderkey long, note string, o_custkey long", multiline=True)


@register("export_csv_indexed", """
    SELECT row_number() OVER (ORDER BY p_name, p_partkey) - 1 AS row_index, p_partkey AS product, p_name AS name
    FROM part""")
def export_csv_indexed(spark, sf_dir):
    path = scratch_path(spark, "export-indexed")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    sinks.export_csv(parts, path, ["product", "name"], "row_index", ["p_name", "p_partkey"])
    return files.read_csv(spark, path, "row_index long, product long, name string")


@register("src_json_records", f"""
    SELECT event_id, n % {RECORDS} AS row_id, event_type, CASE WHEN event_id % 3 > 0 THEN props END AS props
    FROM {numbered_sql("events", "event_id")}""")
def src_json_records(spark, sf_dir):
    """Documents that are arrays of records; a record without the field has no value there."""
    record = F.struct(
        "n", F.col("event_id").cast("string").alias("event_id"), "event_type",
        F.when(F.col("event_id") % 3 > 0, F.col("props")).alias("props"),
    )
    records = F.transform(F.sort_array(F.collect_list(record)), lambda r: r.dropFields("n"))
    documents = numbered(spark, sf_dir, "events", "event_id").groupBy(F.floor(F.col("n") / RECORDS)).agg(
        F.to_json(records).alias("value")
    )
    path = scratch_path(spark, "json-records")
    documents.select("value").write.text(path)
    rows = files.read_json_columnar(spark, path, ["event_id", "event_type", "props"], one_per_line=True)
    return rows.select(F.col("event_id").cast("long").alias("event_id"), "row_id", "event_type", "props")


@register("src_json_columnar_repeated", """
    SELECT CAST(r AS BIGINT) AS row_id, CASE r WHEN 0 THEN o_orderpriority ELSE o_orderstatus END AS word
    FROM orders, (SELECT unnest([0, 1]) AS r)""")
def src_json_columnar_repeated(spark, sf_dir):
    """One small document per order; many of them are the same text."""
    word = F.create_map(F.lit("0"), "o_orderpriority", F.lit("1"), "o_orderstatus")
    path = scratch_path(spark, "json-repeated")
    table(spark, sf_dir, "orders").select(F.to_json(F.struct(word.alias("word"))).alias("value")).write.text(path)
    return files.read_json_columnar(spark, path, ["word"], one_per_line=True).select("row_id", "word")


@register("src_json_keyed", f"""
    SELECT n AS row_no, c_name, c_mktsegment, CAST(row_number() OVER (
        PARTITION BY n // {RECORDS} ORDER BY CAST(n AS VARCHAR)) - 1 AS INT) AS position
    FROM {numbered_sql("customer", "c_custkey")}""")
def src_json_keyed(spark, sf_dir):
    documents = (
        numbered(spark, sf_dir, "customer", "c_custkey")
        .groupBy(F.floor(F.col("n") / RECORDS))
        .agg(
            files.json_object(
                F.col("n").cast("string").alias("key"),
                F.struct("c_name", "c_mktsegment").alias("record"),
            ).alias("value")
        )
    )
    path = scratch_path(spark, "json-keyed")
    documents.select("value").write.text(path)
    fields = ["c_name", "c_mktsegment"]
    records = files.read_json_keyed(spark, path, fields, "row_no", one_per_line=True)
    return records.withColumn("row_no", F.col("row_no").cast("long"))


@register("src_json_columnar", f"""
    SELECT event_id, n % {RECORDS} AS row_id, event_type, user_id, props
    FROM {numbered_sql("events", "event_id")}""")
def src_json_columnar(spark, sf_dir):
    def column(name):
        cell = F.struct((F.col("n") % RECORDS).cast("string"), F.col(name).cast("string"))
        return F.map_from_entries(F.collect_list(cell)).alias(name)

    names = ["event_id", "event_type", "user_id", "props"]
    documents = (
        numbered(spark, sf_dir, "events", "event_id")
        .groupBy(F.floor(F.col("n") / RECORDS))
        .agg(*[column(n) for n in names])
        .select(F.to_json(F.struct(*names)).alias("value"))
    )
    path = scratch_path(spark, "json-columnar")
    documents.write.text(path)
    rows = files.read_json_columnar(spark, path, names, one_per_line=True)
    return rows.select(
        F.col("event_id").cast("long").alias("event_id"),
        "row_id",
        "event_type",
        F.col("user_id").cast("long").alias("user_id"),
        "props",
    )


@register("src_json_variant", f"""
    SELECT event_id, n % {RECORDS} AS row_id, event_type, '{{"ids":[' || event_id || '],"user":' || user_id || '}}' AS detail
    FROM {numbered_sql("events", "event_id")}""")
def src_json_variant(spark, sf_dir):
    """Documents by column that name a column twice, and arrays behind white space; cells that are objects."""
    detail = F.struct(F.col("user_id").alias("user"), F.array("event_id").alias("ids"))
    rows = numbered(spark, sf_dir, "events", "event_id").select(
        F.floor(F.col("n") / RECORDS).alias("document"), (F.col("n") % RECORDS).alias("label"), "event_id", "event_type", detail.alias("detail"),
    )

    def column(name):
        cells = F.sort_array(F.collect_list(F.struct(F.col("label"), F.col(name).alias("cell"))))
        entries = F.transform(cells, lambda c: F.struct(c["label"].cast("string").alias("key"), c["cell"].alias("value")))
        return F.to_json(F.map_from_entries(entries))

    names = ["event_id", "event_type", "detail"]
    written = [F.concat(F.lit(f'"{n}": '), column(n)) for n in names]
    stale = F.lit('"event_type": {"0": "stale", "x": "gone"}')
    by_column = rows.where("document % 2 = 0").groupBy("document").agg(
        F.concat(F.lit(" { "), F.concat_ws(", ", stale, *written), F.lit(" }")).alias("value")
    )
    records = F.sort_array(F.collect_list(F.struct("label", *names)))
    arrays = rows.where("document % 2 = 1").groupBy("document").agg(
        F.concat(F.lit("\t  "), F.to_json(F.transform(records, lambda r: r.dropFields("label")))).alias("value")
    )
    path = scratch_path(spark, "json-variant")
    by_column.union(arrays).select("value").write.text(path)
    found = files.read_json_columnar(spark, path, names, one_per_line=True)
    return found.select(F.col("event_id").cast("long").alias("event_id"), "row_id", "event_type", "detail")


@register("src_mapping_file", """
    SELECT c_mktsegment || ' ' || c_nationkey AS name, arg_max('K' || c_custkey, c_custkey) AS code
    FROM customer GROUP BY 1""")
def src_mapping_file(spark, sf_dir):
    """Names repeat across many files; the customer with the highest number comes last."""
    path = scratch_path(spark, "mapping")
    name = F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string"))
    line = F.concat_ws(",", name, F.concat(F.lit("K"), F.col("c_custkey").cast("string")))
    table(spark, sf_dir, "customer").orderBy("c_custkey").select(line.alias("value")).write.text(path)
    return files.read_mapping_file(spark, path)


def _pages(spark, sf_dir, closed: bool):
    """Pages of two tables: a menu, and one row per order, with or without end tags."""
    td, tr = ("</td>", "</tr>") if closed else ("", "")
    buyer = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_custkey").cast("string")).otherwise("")
    row = F.concat(
        F.lit("<tr><td class='k'>"), F.col("o_orderkey").cast("string"), F.lit(f"{td}\n<TD>"),
        F.col("o_orderpriority"), F.lit(" &amp; <b>"), F.col("o_orderstatus"),
        F.lit(f"</b>{td}<td>"), buyer, F.lit(f"{td}{tr}"),
    )
    in_order = F.sort_array(F.collect_list(F.struct("n", row.alias("row"))))
    body = F.array_join(F.transform(in_order, lambda r: r["row"]), "\n")
    head = (
        "<html><body><table><tr><td>menu</td></tr></table><p>x</p><table border=1>"
        "<tr><th>order</th><th>label</th><th>buyer</th></tr>"
    )
    return (
        numbered(spark, sf_dir, "orders", "o_orderkey")
        .groupBy(F.floor(F.col("n") / ROWS_PER_PAGE).alias("page_id"))
        .agg(F.concat(F.lit(head), body, F.lit("</table></body></html>")).alias("html"))
    )


HTML_SQL = f"""
    SELECT n // {ROWS_PER_PAGE} AS page_id, CAST(o_orderkey AS VARCHAR) AS order_no,
        o_orderpriority || ' & ' || o_orderstatus AS label,
        CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_custkey AS VARCHAR) END AS buyer,
        CAST(n % {ROWS_PER_PAGE} + 1 AS INT) AS row_no
    FROM {numbered_sql("orders", "o_orderkey")}"""


@register("src_html_table", HTML_SQL)
def src_html_table(spark, sf_dir):
    rows = html.harvest_tables(_pages(spark, sf_dir, True), 1, ["order_no", "label", "buyer"])
    return rows.where(~F.col("is_header")).drop("is_header")


@register("src_html_table_lenient", HTML_SQL)
def src_html_table_lenient(spark, sf_dir):
    rows = html.harvest_tables_lenient(_pages(spark, sf_dir, False), 1, ["order_no", "label", "buyer"])
    return rows.where(~F.col("is_header")).drop("is_header")


@register("src_html_spans", f"""
    SELECT n // {ROWS_PER_PAGE} AS page_id, CAST(n % {ROWS_PER_PAGE} + 1 AS INT) AS row_no,
        CASE WHEN n % 2 = 0 THEN 'N°' || o_orderkey ELSE 'N°' || lag(o_orderkey) OVER (ORDER BY n) END AS pair,
        CASE WHEN n % 2 = 0 THEN o_orderpriority ELSE o_orderkey || ' € é' END AS label,
        CASE WHEN n % 2 = 0 THEN o_orderstatus ELSE o_orderkey || ' € é' END AS status
    FROM {numbered_sql("orders", "o_orderkey")}""")
def src_html_spans(spark, sf_dir):
    """Every second row goes on with the first cell of the one before, and its own cell covers two columns."""
    key = F.col("o_orderkey").cast("string")
    first = F.concat(
        F.lit("<tr><td rowspan='2'>N&deg;"), key, F.lit("</td><td>"), "o_orderpriority", F.lit("</td><td>"), "o_orderstatus", F.lit("</td></tr>")
    )
    second = F.concat(F.lit('<tr><td class="x" COLSPAN=2>'), key, F.lit(" &#8364;&nbsp;&#xE9;</td></tr>"))
    row = F.when(F.col("n") % 2 == 0, first).otherwise(second)
    in_order = F.sort_array(F.collect_list(F.struct("n", row.alias("row"))))
    head = "<table><thead><tr><th rowspan=5>pair</th><th>label</th><th>status</th></tr></thead><tbody>"
    pages = numbered(spark, sf_dir, "orders", "o_orderkey").groupBy(F.floor(F.col("n") / ROWS_PER_PAGE).alias("page_id")).agg(
        F.concat(F.lit(head), F.array_join(F.transform(in_order, lambda r: r["row"]), ""), F.lit("</tbody></table>")).alias("html")
    )
    rows = html.harvest_tables(pages, 0, ["pair", "label", "status"])
    return rows.where(~F.col("is_header")).drop("is_header")


LOADED = """
    SELECT s_suppkey AS store_key, CASE s_suppkey % 3 WHEN 0 THEN 'GB' WHEN 1 THEN 'DE' ELSE 'FR' END
        AS country_code, CASE s_suppkey % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'False' END AS availability
    FROM supplier WHERE s_suppkey % 3 < 2"""


@register("load_table", f"""
    WITH once AS ({LOADED} UNION ALL SELECT -1, NULL, 'Not Applicable'),
    twice AS ({LOADED})
    SELECT * FROM once UNION ALL SELECT * FROM twice""")
def load_table(spark, sf_dir):
    """A replacing load with all steps, then an appending one without the given row."""
    key = F.col("s_suppkey")
    stores = table(spark, sf_dir, "supplier").select(
        key.alias("store_key"),
        F.when(key % 3 == 0, "GB").when(key % 3 == 1, "DE").otherwise("FR").alias("country_code"),
        F.when(key % 4 == 0, "Still_avaliable").when(key % 4 == 1, "Removed").otherwise("odd")
        .alias("availability"),
    )
    path = scratch_path(spark, "load")
    steps = {"mapping": AVAILABILITY_TEXTS, "subset": ["US", "GB", "DE"]}
    first = [{"store_key": -1, "availability": "Not Applicable"}]
    sinks.load_table(stores, path, "replace", additional_rows=first, **steps)
    return sinks.load_table(stores, path, "append", **steps)


@register("load_table_append", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def load_table_append(spark, sf_dir):
    """A published table and a batch behind it that comes twice and counts once."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    published = Published(spark, scratch_path(spark, "published"))
    published.publish(suppliers.where("s_suppkey % 3 > 0"), "replace")
    rest = suppliers.where("s_suppkey % 3 = 0").select("s_nationkey", "s_suppkey", "s_name")
    published.publish(rest, "append", batch="rest")
    return published.publish(rest, "append", batch="rest")


@register("key_stable", """
    WITH loads AS (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 2 END AS load FROM customer)
    SELECT c_custkey, c_name, row_number() OVER (ORDER BY load, c_name) AS user_key FROM loads""")
def key_stable(spark, sf_dir):
    """Two loads with one key map: the second has all customers, and those of the first keep their keys."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    keys = Published(spark, scratch_path(spark, "key-map"))
    _, new = stable_keys(customers.where("c_custkey % 3 = 0"), "c_name", "user_key")
    known = keys.publish(new, "append", batch="first")
    keyed, new = stable_keys(customers, "c_name", "user_key", known)
    keys.publish(new, "append", batch="second")
    return keyed


@register("layered_load", f"""
    {CLEAN_CARDS}
    UNION ALL SELECT -1, 'Not Applicable', NULL, NULL, NULL
    UNION ALL SELECT 0, 'Unknown', NULL, NULL, NULL""")
def layered_load(spark, sf_dir):
    """Loads twice into one place: the second load replaces the first."""
    root = scratch_path(spark, "layers")

    def load():
        return sinks.layered_load(
            raw(spark, sf_dir, "cards"),
            lambda cards: pipelines.clean_cards(cards, "position"),
            root,
            LAND_TABLES["cards"],
            DIM_TABLES["cards"],
            RAW_TABLES["cards"],
            additional_rows=DEFAULT_MEMBERS["dim_card_details"],
        )

    load()
    return load()


@register("export_csv", """
    SELECT CAST(p_partkey AS VARCHAR) AS product, p_name AS name, CAST(p_size AS VARCHAR) AS size
    FROM part""")
def export_csv(spark, sf_dir):
    path = scratch_path(spark, "export")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    sinks.export_csv(parts, path, ["product", "name", "size"])
    return files.read_csv(spark, path, "product string, name string, size string")


@register("truncate", "SELECT count(*) AS before, 0 AS after FROM orders")
def truncate(spark, sf_dir):
    path = scratch_path(spark, "truncate")
    loaded = sinks.load_table(table(spark, sf_dir, "orders"), path, "replace")
    before = loaded.count()
    emptied = sinks.truncate_table(spark, path)
    return emptied.agg(
        F.lit(before).cast("long").alias("before"), F.count(F.lit(1)).cast("int").alias("after")
    )


@register("create_tables", """
    SELECT c_custkey + 1 AS card_key, c_name AS card_number, CAST(NULL AS VARCHAR) AS expiry_date,
        c_mktsegment AS card_provider, CAST(NULL AS DATE) AS date_payment_confirmed FROM customer""")
def create_tables(spark, sf_dir):
    """Declared empty tables, one of which is then loaded by appending."""
    root = scratch_path(spark, "tables")
    wanted = {t: TABLE_LAYOUTS[t] for t in ("land_card_data", "dim_card_details", "orders_table")}
    sinks.create_tables(spark, root, wanted)
    cards = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("card_key"),
        F.col("c_name").alias("card_number"),
        F.lit(None).cast("string").alias("expiry_date"),
        F.col("c_mktsegment").alias("card_provider"),
        F.lit(None).cast("date").alias("date_payment_confirmed"),
    )
    return sinks.load_table(cards, f"{root}/dim_card_details", "append", "dim_card_details")
