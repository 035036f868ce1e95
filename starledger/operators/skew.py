"""Joins that hold up when one key owns a large part of the rows.

``attach`` is the join every plan uses. A side is broadcast only when its size is known to
be small; beyond the bound the join shuffles, and keys that are heavy on the big side are
spread over several salts. Milder skew is left to the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starledger.functions.numbers import revenue

BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 32 * 1024 * 1024
HEAVY_SHARE = 0.002
#: A frame that is expected to have so many times the broadcast bound is not added up as a whole.
EXPECTED_TIMES = 16
MIN_SALTS = 64
MIN_HEAVY_ROWS = 64

# Inside ``unhinted`` joins are left to Spark's planner.
_PLAIN: ContextVar[bool] = ContextVar("plain_joins", default=False)


def measured_small(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> bool:
    """True when ``df`` was counted and weighed, and stays within the broadcast bounds.

    Only texts need weighing, other values have a width. Where the planner expects little to read, all of it is added up
    in place, with one row per task to add; elsewhere a job takes no more rows than the bound.
    """
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in df.dtypes if kind == "string"]
    weighed = df.select(reduce(Column.__add__, texts, F.lit(0)).cast("long").alias("weight"))
    if expected_bytes(df) > EXPECTED_TIMES * max_bytes:
        weighed = weighed.limit(max_rows + 1)
    rows, weight = weighed.agg(F.count(F.lit(1)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    return rows <= max_rows and rows * 16 * len(df.columns) + weight <= max_bytes


def expected_bytes(df: DataFrame) -> int:
    """The planner's estimate of the size of a frame: the size of its files, the product of the sides of its joins."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


class KeyProfile:
    """Heavy keys of a frame, for one or several join keys, found together when first needed.

    Keys are told by hash. Frequent-item counting keeps a bounded buffer per task and
    returns at most ``1 / share`` candidates per key, among them every hash with more than
    ``share`` of the rows. A second pass counts the candidates and all rows, so that only keys
    that really are heavy are salted. A missing key is a key like any other here.
    """

    def __init__(self, df: DataFrame, *keys: str | Sequence[str], share: float = HEAVY_SHARE):
        self._df, self._share = df, share
        self._keys = [_names(k) for k in keys]
        self._found: dict[tuple[str, ...], dict[int, float]] | None = None

    def heavy(self, key: str | Sequence[str]) -> dict[int, float]:
        """Share of all rows by the hash of each heavy key."""
        if self._found is None:
            self._found = self._find()
        return self._found[_names(key)]

    def _find(self) -> dict[tuple[str, ...], dict[int, float]]:
        names = [f"_hash_{i}" for i in range(len(self._keys))]
        hashes = self._df.select(
            *[F.xxhash64(*key).alias(name) for name, key in zip(names, self._keys)]
        )
        candidates = hashes.stat.freqItems(names, self._share).first()
        # Only the candidates of a row leave it, so most rows are one row here, whatever the number of keys.
        wanted = [
            F.when(F.col(n).isin(list(found)), F.struct(F.lit(n).alias("key"), F.col(n).alias("hash")))
            for n, found in zip(names, candidates)
            if found
        ]
        none = [F.lit(0).alias("pos"), F.lit(None).alias("col")]
        pairs = hashes.select(*([F.posexplode_outer(F.array_compact(F.array(*wanted)))] if wanted else none))
        counted = pairs.groupBy("col", (F.coalesce("pos", F.lit(0)) == 0).alias("is_first")).count()
        counts: dict[tuple[str, int], int] = {}
        total = 0
        # At most 1 / share rows per key, twice.
        for pair, is_first, n in counted.collect():
            total += n if is_first else 0
            if pair is not None:
                counts[pair["key"], pair["hash"]] = counts.get((pair["key"], pair["hash"]), 0) + n
        least = max(self._share * total, MIN_HEAVY_ROWS)
        return {
            key: {h: n / total for (of, h), n in counts.items() if of == name and n > least}
            for name, key in zip(names, self._keys)
        }


def _names(keys: str | Sequence[str]) -> tuple[str, ...]:
    return (keys,) if isinstance(keys, str) else tuple(keys)


@contextmanager
def unhinted() -> Iterator[None]:
    """Plans made inside have no broadcast hints and no salts, so they hold for any later size of their tables."""
    token = _PLAIN.set(True)
    try:
        yield
    finally:
        _PLAIN.reset(token)


def default_salts(spark: SparkSession) -> int:
    """Salts of a key that owned all rows: two per shuffle partition."""
    partitions = spark.conf.get(
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum", None
    ) or spark.conf.get("spark.sql.shuffle.partitions")
    return max(MIN_SALTS, 2 * int(partitions))


def salt_counts(heavy: dict[int, float], salts: int) -> dict[int, list[int]]:
    """Heavy hashes by their number of salts, which follows the share and is a power of two.

    Shares add up to one at most, so all right rows together are repeated less than about
    ``2 * salts`` times, plus twice per heavy key.
    """
    classes: dict[int, list[int]] = {}
    for found, share in heavy.items():
        classes.setdefault(1 << max(1, ceil(log2(max(salts * share, 1)))), []).append(found)
    return classes


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str],
    how: str = "left",
    profile: KeyProfile | None = None,
    salts: int | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join with the heavy keys of the left side split over as many parts as their share asks for.

    ``salts`` is for a key that owned all rows, by default two per shuffle partition, so
    that a key with a third of all rows is spread over about two thirds of them.

    ``profile`` counts the keys, by default on the left side itself; one made of the base
    table avoids computing a derived left side twice. The right rows of heavy keys, and
    only those, are repeated once per salt. The salt depends on the row and on the
    partition that holds it: a retried task gives the same salt, and copies of one row in
    different partitions still part. Result columns are the left ones, then the right
    ones without the keys.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"salted_join does not do {how!r}")
    names = _names(keys)
    left_types, right_types = dict(left.dtypes), dict(right.dtypes)
    for k in names:
        if left_types[k] != right_types[k]:
            raise ValueError(f"{k} is {left_types[k]} on one side, {right_types[k]} on the other")
    heavy = {} if _PLAIN.get() else (profile or KeyProfile(left, names)).heavy(names)
    rest = [c for c in right.columns if c not in names]
    renamed = right.select(*[F.col(k).alias(f"_right_{k}") for k in names], *rest)

    def same(k: str) -> Column:
        a, b = F.col(k), F.col(f"_right_{k}")
        return a.eqNullSafe(b) if null_safe else a == b

    condition = reduce(Column.__and__, [same(k) for k in names])
    if not heavy:
        return left.join(renamed, condition, how).select(*left.columns, *rest)
    classes = salt_counts(heavy, salts or default_salts(left.sparkSession))

    def parts(found: Column) -> Column:
        chosen = F.lit(1)
        for number, hashes in classes.items():
            chosen = F.when(found.isin(hashes), number).otherwise(chosen)
        return chosen

    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *left.columns), parts(F.xxhash64(*names)))
    salted_left = left.withColumn("_salt", spread.cast("int"))
    right_parts = parts(F.xxhash64(*[f"_right_{k}" for k in names]))
    salted_right = renamed.withColumn("_right_salt", F.explode(F.sequence(F.lit(0), right_parts - 1)))
    condition = condition & (F.col("_salt") == F.col("_right_salt"))
    return salted_left.join(salted_right, condition, how).select(*left.columns, *rest)


def attach(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    profile: KeyProfile | None = None,
    reduced: bool = False,
    bound: DataFrame | None = None,
) -> DataFrame:
    """Join ``right`` onto ``left`` by an equally named key.

    ``reduced`` says that the left side was aggregated by this key and a few others, so
    no key owns many rows any more and a plain shuffled join is even. ``bound`` is a frame
    no smaller than ``right`` that is cheaper to measure, such as the table it groups.
    """
    if not _PLAIN.get() and measured_small(right if bound is None else bound):
        return left.join(F.broadcast(right), key, how)
    if reduced:
        return left.join(right, key, how)
    return salted_join(left, right, key, how, profile)


def priced_totals(
    sales: DataFrame,
    prices: DataFrame,
    key: str,
    groups: Sequence[str],
    how: str = "inner",
    profile: KeyProfile | None = None,
) -> DataFrame:
    """Per group: ``amount``, the sum of price times quantity, and ``sales``, the row count.

    With few prices they are broadcast and the rows go straight into the groups. Beyond
    that, units are summed per product and group first, so that all sales of a hot
    product in one group are one row per task before they are shuffled; a product that is
    heavy still, because it has many groups, is salted.
    """
    if _PLAIN.get() or measured_small(prices):
        few = prices if _PLAIN.get() else F.broadcast(prices)
        return (
            sales.join(few, key, how)
            .groupBy(*groups)
            .agg(
                F.sum(revenue(F.col("product_price"), F.col("product_quantity"))).alias("amount"),
                F.count(F.lit(1)).alias("sales"),
            )
        )
    units = sales.groupBy(key, *groups).agg(
        F.sum("product_quantity").alias("units"), F.count(F.lit(1)).alias("sales")
    )
    return (
        salted_join(units, prices, key, how, profile or KeyProfile(sales, key))
        .groupBy(*groups)
        .agg(
            F.sum(revenue(F.col("product_price"), F.col("units"))).alias("amount"),
            F.sum("sales").alias("sales"),
        )
    )
