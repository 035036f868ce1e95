"""Readers: relational tables, CSV by place or by name, JSON in two orientations, name/code lists."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starledger.functions.lists import let

#: How comma-separated files are written and read: a header line, quotes doubled inside quoted cells.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def jdbc_options(
    url: str, table: str, split_on: str, lower: int, upper: int, partitions: int, **properties: str
) -> dict[str, str]:
    """Options of a parallel table read: ``partitions`` ranges of the ``split_on`` column.

    The bounds only place the splits; rows outside them are read by the end ranges.
    """
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": split_on,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        **properties,
    }


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, multiline: bool = False
) -> DataFrame:
    """Comma-separated files with a header line, in a declared schema.

    Quotes inside a cell are doubled. ``multiline`` allows line breaks inside quoted cells, at
    the price of one task per file. A record that does not fit the schema fails the read, and so does a
    file whose header does not name the columns of the schema in their order; ``read_csv_by_name`` reads those.
    """
    reader = spark.read.schema(schema).options(**CSV_OPTIONS)
    return reader.option("enforceSchema", False).option("mode", "FAILFAST").option("multiLine", multiline).csv(path)


#: Headers read at the same time.
HEADERS_TOGETHER = 32


def csv_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Names in the header line of every file under ``path``; an empty file has none.

    One line per file comes to the driver, which lists the files for a read anyway.
    """
    jvm = spark.sparkContext._jvm
    hadoop, io = jvm.org.apache.hadoop, jvm.java.io
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    codecs = hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(at) -> str:
        stream = at.getFileSystem(conf).open(at)
        try:
            codec = codecs.getCodec(at)
            reader = io.BufferedReader(io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
            return reader.readLine() or ""
        finally:
            stream.close()

    files = [hadoop.fs.Path(jvm.java.net.URI(f)) for f in sorted(spark.read.format("binaryFile").load(path).inputFiles())]
    with ThreadPoolExecutor(HEADERS_TOGETHER) as pool:
        lines = list(pool.map(first_line, files))
    return {f.toString(): next(csv.reader([line.lstrip("\ufeff")]), []) for f, line in zip(files, lines)}


def read_csv_by_name(
    spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = False
) -> DataFrame:
    """Comma-separated files whose columns are found by the names in their own header lines.

    Files may order their columns differently, lack some (NULL), and have others (ignored); ``csv_header_report`` tells
    which. Files with the same header are read together. Names count as they are written; one that a header repeats, or an
    unnamed one, fails the read where the schema names it.
    """
    declared = spark.createDataFrame([], schema).schema
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file, names in csv_headers(spark, path).items():
        if names:
            by_header[tuple(names)].append(file)
    parts = []
    for names, files in sorted(by_header.items()):
        for field in declared.names:
            if names.count(field) > 1:
                raise ValueError(f"{files[0]} names the column {field} more than once")
        # Others are read by place under names that cannot meet a declared one.
        placed = T.StructType([
            T.StructField(n if n in declared.names else f"_other_{k}", declared[n].dataType if n in declared.names else T.StringType())
            for k, n in enumerate(names)
        ])
        reader = spark.read.schema(placed).options(**CSV_OPTIONS).option("mode", "FAILFAST").option("multiLine", multiline)
        found = reader.option("enforceSchema", True).csv(files)
        parts.append(found.select(*[
            F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in declared
        ]))
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], declared)


def csv_header_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """(file, missing, extra): per file the declared columns it lacks, and its columns that are not declared."""
    names = spark.createDataFrame([], schema).schema.names
    rows = [
        (file, [n for n in names if n not in found], [n for n in found if n not in names])
        for file, found in csv_headers(spark, path).items()
    ]
    return spark.createDataFrame(rows, "file string, missing array<string>, extra array<string>")


def read_documents(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """JSON texts in column ``value``: one per file, or one per line of splittable files.

    ``document`` names a text by its file, and by its block and line where a file has many;
    equal texts are different documents. Blank lines are no documents.
    """
    texts = spark.read.text(path, wholetext=not one_per_line)
    file = F.col("_metadata.file_path")
    if not one_per_line:
        return texts.select("value", F.struct(file.alias("file")).alias("document"))
    place = F.struct(
        file.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return texts.select("value", place.alias("document")).where(F.trim("value") != "")


def _malformed(text: str) -> Column:
    return F.raise_error(F.concat(F.lit("malformed JSON document: "), F.left(F.col(text), F.lit(200))))


def _one_value(text: str) -> tuple[Column, Column]:
    """The text as the only element of a JSON array, and whether something may stand behind the end of that array.

    Parsers stop where a value ends; inside an array what follows the value has to be the array's end. Only behind a
    closing bracket of the text's own could more follow unseen, and there a second parse inside an object looks.
    """
    body = F.col(text)
    return F.concat(F.lit("["), body, F.lit("]")), body.rlike(r"\]\s*[^\s,\]\}]")


def parsed_variant(text: str) -> Column:
    """A JSON text as a variant; of repeated keys the last counts. One that is not exactly one JSON value fails the job."""
    wrapped, unsure = _one_value(text)
    inside = F.try_parse_json(F.concat(F.lit('{"v":'), F.col(text), F.lit("}")))

    def value(array: Column) -> Column:
        whole = array.isNotNull() & F.try_variant_get(array, "$[1]", "variant").isNull()
        first = F.try_variant_get(array, "$[0]", "variant")
        whole = whole & first.isNotNull() & (~unsure | inside.isNotNull())
        return F.when(whole, first).otherwise(_malformed(text))

    return F.when(F.col(text).isNotNull(), let(F.try_parse_json(wrapped), value))


def columnar_records(
    documents: DataFrame, columns: Sequence[str], document_id: str = "document", text: str = "value"
) -> DataFrame:
    """Rows of column-oriented JSON, ``{"col": {"0": v, "1": v}, ...}``, or of an array of records.

    Every text is parsed once, to a variant. Cells are unpivoted and grouped back by (document, row), so one large document spreads
    over many tasks after it was parsed. ``row_id`` is the row label as a number, for an array
    the place in it; all other values are text, nested ones JSON text. A cell that a column lacks is NULL; of a repeated key the last
    value counts; anything behind the first JSON value fails the job.
    """
    spark = documents.sparkSession
    # A setting of the session, since it is no option of the function; without it a repeated key is an error.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    parsed = documents.select(F.col(document_id).alias("document"), parsed_variant(text).alias("parsed"))
    entries = parsed.lateralJoin(spark.tvf.variant_explode(F.col("parsed").outer()))
    entries = entries.select("document", F.col("pos").alias("place"), F.col("key").alias("name"), F.col("value").alias("entry"))
    # An object has keys, an array has none.
    by_column = entries.where(F.col("name").isin(*columns)).select("document", "name", _cells("entry").alias("entry"))
    cells = by_column.lateralJoin(spark.tvf.variant_explode(F.col("entry").outer())).select(
        "document", "name", F.col("key").cast("long").alias("row_id"), F.col("value").cast("string").alias("cell")
    )
    picked = [F.max(F.when(F.col("name") == c, F.col("cell"))).alias(c) for c in columns]
    rows = cells.groupBy("document", "row_id").agg(*picked)
    records = entries.where(F.col("name").isNull())
    fields = [F.try_variant_get("entry", f"$[{_quoted(c)}]", "string").alias(c) for c in columns]
    found = rows.union(records.select("document", F.col("place").cast("long"), *fields))
    return found.withColumnRenamed("document", document_id)


def _quoted(name: str) -> str:
    """A name inside a variant path, which knows no escapes."""
    if "'" in name and '"' in name:
        raise ValueError(f"a column of a JSON document cannot be named {name}")
    return f'"{name}"' if "'" in name else f"'{name}'"


def _cells(entry: str) -> Column:
    """The cells of a column; a value that is no object is no column."""
    kind = F.schema_of_variant(entry)
    wrong = F.raise_error(F.concat(F.lit("JSON column without row labels: "), F.left(F.col(entry).cast("string"), F.lit(200))))
    return F.when(kind.startswith("OBJECT") | (kind == "VOID"), F.col(entry)).otherwise(wrong)


def read_json_columnar(
    spark: SparkSession, path: str, columns: Sequence[str], one_per_line: bool = False
) -> DataFrame:
    return columnar_records(read_documents(spark, path, one_per_line), columns)


def keyed_records(
    documents: DataFrame, fields: Sequence[str], key: str, text: str = "value"
) -> DataFrame:
    """Rows of key-oriented JSON: ``{"GB": {"field": v, ...}, ...}``.

    The object key becomes column ``key``; ``position`` is its place among the object's keys. A key that repeats is one row, at its
    first place and with its last record. Anything behind the first JSON value fails the job.
    """
    record = ", ".join(f"`{f}`: string" for f in fields)
    kind = f"map<string,struct<{record}>>"
    wrapped, unsure = _one_value(text)
    inside = F.from_json(F.concat(F.lit('{"v":'), F.col(text), F.lit("}")), f"struct<v:{kind}>")["v"]

    def entries(array: Column) -> Column:
        whole = array.isNotNull() & (F.size(array) == 1) & (~unsure | inside.isNotNull())
        return F.when(whole & F.get(array, F.lit(0)).isNotNull(), F.map_entries(F.get(array, F.lit(0)))).otherwise(_malformed(text))

    def once(held: Column) -> Column:
        keys = F.array_distinct(F.transform(held, lambda e: e["key"]))
        last = F.transform(keys, lambda k: F.element_at(F.filter(held, lambda e: e["key"] == k), -1))
        return F.when(F.size(keys) == F.size(held), held).otherwise(last)

    parsed = F.when(F.col(text).isNotNull(), let(let(F.from_json(wrapped, f"array<{kind}>"), entries), once))
    rows = documents.select(F.posexplode(parsed).alias("position", "entry"))
    return rows.select("position", F.col("entry.key").alias(key), *[F.col(f"entry.value.`{f}`").alias(f) for f in fields])


def read_json_keyed(
    spark: SparkSession, path: str, fields: Sequence[str], key: str, one_per_line: bool = False
) -> DataFrame:
    return keyed_records(read_documents(spark, path, one_per_line), fields, key)


def read_mapping_file(spark: SparkSession, path: str) -> DataFrame:
    """``name,code`` lines without a header; of repeated names the last line wins."""
    lines = spark.read.text(path).select(
        F.split(F.trim("value"), ",").alias("pair"),
        F.struct(
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("place"),
    )
    pairs = lines.where(F.size("pair") == 2).select(
        F.get("pair", F.lit(0)).alias("name"), F.get("pair", F.lit(1)).alias("code"), "place"
    )
    return pairs.groupBy("name").agg(F.max_by("code", "place").alias("code"))


def json_object(key: Column, record: Column) -> Column:
    """Aggregate (key, record) pairs of a bounded group into one keyed JSON text."""
    return F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, record)))))
