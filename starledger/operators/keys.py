"""Surrogate keys over a distributed order."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from starledger.operators import skew
from starledger.operators.skew import attach
from starledger.session import materialised

#: Sees the rows before some are dropped, and the rules by name; returns the rows.
Watch = Callable[[DataFrame, Mapping[str, Column]], DataFrame]

# monotonically_increasing_id keeps the partition number above this many row bits.
_ROW_BITS = 33


#: So many rows, with order keys of so many bytes, are numbered in one task where they are counted and weighed.
FEW_ROWS = 50_000
FEW_BYTES = 8 * 1024 * 1024


def number_few_rows(df: DataFrame, order_by: Sequence[str], key: str) -> DataFrame:
    """``number_rows`` in one task, for frames that are known to be small."""
    along = Window.orderBy(*order_by, "_tie")
    tied = df.withColumn("_tie", F.xxhash64(*df.columns))
    return tied.select(*df.columns, F.row_number().over(along).cast("long").alias(key))


def _number(df: DataFrame, order_by: Sequence[str], key: str) -> DataFrame:
    """``df`` numbered in one task where it is counted and weighed to be small, else by a range shuffle."""
    few = skew.measured_small(df.select(*order_by), FEW_ROWS, FEW_BYTES)
    return (number_few_rows if few else number_rows)(df, order_by, key)


def number_rows(df: DataFrame, order_by: Sequence[str], key: str) -> DataFrame:
    """``key`` = 1..n along ``order_by``, without bringing the rows into one task.

    One range shuffle sorts the rows; the per-partition counts are the only global state
    (one row per partition). The sorted rows are written out because the count and the
    numbering must see the same partitions, also after a lost executor. Rows that tie on
    ``order_by`` are told apart by a hash of their content, so they get the same numbers
    whatever the layout of the files; only exact copies are told apart by where they lie,
    which spreads a large group of them.
    """
    ordered = [*order_by, "_tie", "_copy"]
    placed = materialised(
        df.withColumn("_tie", F.xxhash64(*df.columns))
        .withColumn("_copy", F.spark_partition_id())
        .repartitionByRange(*ordered)
        .sortWithinPartitions(*ordered)
        .drop("_tie", "_copy")
        .withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_at", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        # One row per partition, so a single-task window and a broadcast are bounded.
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    in_part = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(
            *df.columns, (F.col("_offset") + in_part + 1).cast("long").alias(key)
        )
    )


def all_hold(rules: Mapping[str, Column]) -> Column:
    return reduce(Column.__and__, [F.coalesce(rule, F.lit(False)) for rule in rules.values()], F.lit(True))


def _flagged(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with one flag per rule, and the rules in terms of the flags."""
    flags = {name: f"_rule_{i}" for i, name in enumerate(rules)}
    marked = df.withColumns({flags[n]: F.coalesce(rule, F.lit(False)) for n, rule in rules.items()}) if rules else df
    return marked, {n: F.col(flag) for n, flag in flags.items()}


def key_dense(
    df: DataFrame,
    order_by: Sequence[str],
    key: str,
    rules: Mapping[str, Column] | None = None,
    watch: Watch | None = None,
) -> DataFrame:
    """Keys 1..n in source order over the rows that all ``rules`` leave, replacing ``key`` if present.

    Where rows are dropped the cleaned rows are written first, so that each is cleaned once, and only
    those that stay are sorted. ``watch`` is given the rows before they are dropped, and the rules.
    """
    source = f"_source_{key}"
    order = [source if c == key else c for c in order_by]
    df = df.withColumnRenamed(key, source) if key in order_by else df.drop(key)
    if not rules:
        return _number(df, order, key).drop(source)
    marked, flags = _flagged(df, rules)
    if watch:
        marked = watch(marked, flags)
    written = materialised(marked, "cleaned")
    kept = written.where(all_hold(flags)).drop(*[f"_rule_{i}" for i in range(len(flags))])
    return _number(kept, order, key).drop(source)


def key_ordinal(
    df: DataFrame,
    order_by: Sequence[str],
    key: str,
    rules: Mapping[str, Column],
    dense: bool = False,
    watch: Watch | None = None,
) -> DataFrame:
    """Key = source row position, assigned before ``rules`` drop rows, so keys have gaps.

    ``dense`` states that the one ``order_by`` column already counts rows 0, 1, 2, ...;
    the key is then read off it and nothing is shuffled. ``watch`` is given the rows before they
    are dropped, and the rules.
    """
    if dense:
        (position,) = order_by
        keyed, flags = df.withColumn(key, F.col(position).cast("long") + 1), dict(rules)
    else:
        marked, flags = _flagged(df, rules)
        keyed = _number(marked, order_by, key)
    if watch:
        keyed = watch(keyed, flags)
    return keyed.where(all_hold(flags)).select(*[c for c in df.columns if c != key], key)


def stable_keys(df: DataFrame, natural: str, key: str, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``key`` by its natural key, and the new entries (natural, key) of the key map.

    Natural keys that the map ``known`` holds keep their surrogate; only unseen ones are numbered, in their order, behind the
    highest surrogate of the map. So keys hold from load to load, whatever rows come or go. Every row of a
    natural key has the same surrogate; a missing natural key has none. The highest surrogate comes to the driver.
    """
    if key in df.columns:
        raise ValueError(f"the frame has a column {key} already")
    seen = df.select(natural).where(F.col(natural).isNotNull()).distinct()
    # One row per natural key on both sides.
    unseen = seen if known is None else seen.join(known.select(natural), natural, "left_anti")
    highest = 0 if known is None else known.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    numbered = number_rows(unseen, [natural], "_number")
    new = materialised(numbered.select(natural, (F.col("_number") + highest).cast("long").alias(key)), "new-keys")
    keys = new if known is None else known.select(natural, key).union(new)
    return attach(df, keys, natural, "left").select(*df.columns, key), new
