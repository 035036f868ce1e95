"""Writers: typed loads, three-layer loads, CSV export, empty, declared and bucketed tables, views."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from math import ceil

from pyspark.sql import DataFrame, SparkSession, functions as F

from starledger.operators.columns import map_values
from starledger.operators.keys import number_rows
from starledger.operators.rejects import Rejects
from starledger.operators.rows import prepend_rows, subset_filter
from starledger.operators.skew import unhinted
from starledger.schemas import TABLE_LAYOUTS, enforce_schema, struct_type
from starledger.sources.files import CSV_OPTIONS

# Load conditions and the Spark save mode of each.
SAVE_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}
#: Options of replacing writes. A warehouse holds its rows in three layers, and texts and keys pack well.
PACKED = {"compression": "zstd"}


def prepare_load(
    df: DataFrame,
    mapping: Mapping[str, str] | None = None,
    subset: Sequence[str] | None = None,
    additional_rows: Sequence[dict] | None = None,
) -> DataFrame:
    """The steps of a load before its types: mapped availability, then subset, then given rows."""
    if mapping:
        df = map_values(df, "availability", mapping)
    if subset:
        df = subset_filter(df, subset)
    if additional_rows:
        df = prepend_rows(df, additional_rows)
    return df


def spread(df: DataFrame) -> DataFrame:
    """``df`` over as many partitions as tasks run at a time, where its few and small files would give fewer.

    A file is not split inside a row group, so one small file is one task, in every later layer too. Frames that read
    many files, or files of many partitions, are left as they are.
    """
    tasks, files = df.sparkSession.sparkContext.defaultParallelism, df.inputFiles()
    if not 0 < len(files) < tasks:
        return df
    total = sum(_file_sizes(df.sparkSession, files).values())
    # Below this size a shuffle costs less than tasks that wait.
    return df.repartition(tasks) if LEAST_SPREAD <= total < SPREAD_BYTES * tasks else df


def _file_sizes(spark: SparkSession, files: Sequence[str]) -> dict[str, int]:
    """Bytes by path of files that are given by URI."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in files]
    return {p.toString(): p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths}


def file_parts(df: DataFrame) -> list[DataFrame]:
    """A table as read back, as frames of some of its files each: one frame per ``PART_BYTES``, ``MOST_PARTS`` at most.

    For steps that shuffle all columns, one part after the other: they need the disk of one part only.
    """
    sizes = _file_sizes(df.sparkSession, sorted(df.inputFiles()))
    number = min(MOST_PARTS, ceil(sum(sizes.values()) / PART_BYTES), len(sizes))
    if number < 2:
        return [df]
    groups: list[list[str]] = [[] for _ in range(number)]
    before, total = 0, sum(sizes.values())
    for path, size in sizes.items():
        groups[min(number - 1, (before + size // 2) * number // total)].append(path)
        before += size
    return [df.sparkSession.read.schema(df.schema).parquet(*group) for group in groups if group]


#: Bytes of files in a part, and the parts of the largest table: what is joined to each part is read for each.
PART_BYTES = 256 << 20
MOST_PARTS = 4

#: Bytes of files from which, and up to which for each task, rows are spread.
LEAST_SPREAD = 1 << 20
SPREAD_BYTES = 64 << 20


def load_table(
    df: DataFrame,
    path: str,
    condition: str = "append",
    table: str | None = None,
    rejects: Rejects | None = None,
    **steps,
) -> DataFrame:
    """Write a prepared frame as Parquet and return the table as read back.

    ``table`` names a declared layout; ``rejects`` then counts the values that do not fit it.
    Reading back cuts the lineage, so a later step
    neither recomputes the cleaning nor depends on the executors that did it. A replacing load writes beside the table and takes its
    place when it is complete; one that fails leaves the table as it was. ``Published`` keeps versions and counts a batch once.
    """
    if condition not in SAVE_MODES:
        raise ValueError(f"unknown load condition: {condition}")
    prepared = prepare_load(df, **steps)
    if table:
        layout = dict(TABLE_LAYOUTS[table])
        if rejects:
            prepared = rejects.lost(prepared, table, layout)
        prepared = enforce_schema(prepared, layout)
    if condition == "replace":
        _replace(prepared, path)
    else:
        prepared.write.mode(SAVE_MODES[condition]).parquet(path)
    return df.sparkSession.read.schema(prepared.schema).parquet(path)


def _replace(df: DataFrame, path: str) -> None:
    """Write the rows beside ``path`` and rename them into its place."""
    with replacing(df.sparkSession, path) as beside:
        df.write.options(**PACKED).parquet(beside)


def load_parts(parts: Sequence[DataFrame], path: str) -> DataFrame:
    """Replace a table by the rows of all parts, written one after the other, and return it as read back."""
    spark = parts[0].sparkSession
    with replacing(spark, path) as beside:
        for part in parts:
            part.write.mode("append").options(**PACKED).parquet(beside)
    return spark.read.schema(parts[0].schema).parquet(path)


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder beside ``path`` to write to. It takes the place of ``path`` at the end, or is deleted on failure."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    final, beside, before = (hadoop.Path(f"{path.rstrip('/')}{end}") for end in ("", f"__{uuid.uuid4().hex}", f"__{uuid.uuid4().hex}"))
    files = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        yield beside.toString()
    except Exception:
        files.delete(beside, True)
        raise
    replaced = files.exists(final) and files.rename(final, before)
    if not files.rename(beside, final):
        if replaced:
            files.rename(before, final)
        raise RuntimeError(f"{beside} could not take the place of {path}")
    if replaced:
        files.delete(before, True)


def layered_load(
    raw: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    root: str,
    land_table: str,
    dim_table: str,
    raw_table: str | None = None,
    link: Callable[[DataFrame], DataFrame] | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    rejects: Rejects | None = None,
    **dim_steps,
) -> DataFrame:
    """Raw, landing and dimension table of one dataset; each layer reads the one before.

    All three replace what was there, so a second run gives the same tables. ``link`` works on the
    landing rows before the dimension's own steps, ``finish`` after them, default members
    included. Returns the dimension.
    """
    if raw_table:
        raw = load_table(spread(raw), f"{root}/{raw_table}", "replace")
    land = load_table(clean(raw), f"{root}/{land_table}", "replace", land_table, rejects)
    rows = prepare_load(link(land) if link else land, **dim_steps)
    return load_table(finish(rows) if finish else rows, f"{root}/{dim_table}", "replace", dim_table, rejects)


def export_csv(
    df: DataFrame,
    path: str,
    headers: Sequence[str],
    row_index: str | None = None,
    order_by: Sequence[str] = (),
) -> None:
    """CSV files with a header line; all columns renamed by position.

    ``row_index`` names a further first column that counts the rows from 0 along ``order_by``.
    """
    named = df.toDF(*headers)
    if row_index:
        numbered = number_rows(df, list(order_by), "_row_number")
        index = (F.col("_row_number") - 1).alias(row_index)
        named = numbered.select(index, *[F.col(c).alias(h) for c, h in zip(df.columns, headers)])
    named.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def truncate_table(spark: SparkSession, path: str) -> DataFrame:
    """Leave a table with its schema and no rows."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def create_tables(
    spark: SparkSession, root: str, layouts: Mapping[str, Mapping[str, str]] = TABLE_LAYOUTS
) -> dict[str, DataFrame]:
    """Empty tables of the declared layouts, replacing existing ones."""
    tables = {}
    for name, layout in layouts.items():
        empty = spark.createDataFrame([], struct_type(dict(layout)))
        empty.write.mode("overwrite").parquet(f"{root}/{name}")
        tables[name] = spark.read.schema(empty.schema).parquet(f"{root}/{name}")
    return tables


def load_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write a frame as a catalog table in buckets of ``key``, one sorted file each, and return the table.

    One exchange at the load; tables with equal buckets of a key join and group by it without another.
    """
    spread = df.repartition(buckets, key)
    writer = spread.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def register_tables(spark: SparkSession, tables: Mapping[str, str], database: str = "default") -> None:
    """Name written tables (name -> path) in the catalog, so that SQL and other sessions find them."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, path in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        spark.catalog.createTable(f"`{database}`.`{name}`", path=path, source="parquet")


def create_stored_views(spark: SparkSession, views: Mapping[str, str], database: str = "default") -> None:
    """Views stored in the catalog as SQL text; they outlive the session, as far as the catalog does.

    Tables in the text are named by ``{database}``.
    """
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS " + text.replace("{database}", f"`{database}`"))


def create_views(views: Mapping[str, Callable[[], DataFrame]]) -> None:
    """Temporary views of plans that are made without hints.

    A view outlives the sizes its tables have now: Spark chooses the joins whenever it is read.
    """
    with unhinted():
        for name, plan in views.items():
            plan().createOrReplaceTempView(name)
