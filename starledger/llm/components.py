"""Connected components and joins for very uneven groups."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from starledger.session import materialised

HEAVY_SHARE = 0.002
HEAVY_LEAST = 1000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over the links of one partition: every node with its smallest relative."""
    parent: dict = {}

    def root(x):
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != x:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch["a"], batch["b"]):
            a, b = root(a), root(b)
            if a != b:
                low, high = (a, b) if a < b else (b, a)
                parent[high] = low
                parent.setdefault(low, low)
    out = [(x, root(x)) for x in list(parent) if root(x) != x]
    for at in range(0, len(out), 10_000):
        yield pd.DataFrame(out[at : at + 10_000], columns=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b), the component being its smallest node.

    Each round forms union-find forests inside the partitions and then hangs all larger
    neighbours of a node, and then all smaller ones, onto its smallest neighbour, until
    nothing changes; that takes about the logarithm of the longest chain in rounds. Every round
    is written to the shared folder. Nodes come as text, number or bytes; a group of any size is only
    ever joined and aggregated, never collected. No links give an empty table.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialised(ordered.where("a != b").mapInPandas(_forest, ordered.schema), "forest")
    state = None
    while True:
        new_state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if new_state == state:
            return (
                edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
                .union(edges.select("b", "b"))
                .distinct()
            )
        state = new_state
        edges = materialised(_star(_star(edges, larger=True), larger=False), "stars")


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang the larger (or the smaller) neighbours of every node onto its smallest neighbour."""
    sides = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges
    lowest = sides.groupBy("a").agg(F.min("b").alias("low"))
    joined = sides.join(lowest, "a").withColumn("low", F.least("low", "a"))
    if larger:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            lowest.select("a", F.col("low").alias("b"))
        )
    return out.where("a != b").distinct()


def attach_weighed(left: DataFrame, right: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of ``left`` with ``right`` (one row per key, whose ``weight`` is how many left rows it meets).

    Keys with more than ``HEAVY_SHARE`` of the rows, at most 1 / ``HEAVY_SHARE`` of them, are
    broadcast, so that their rows stay where they are; the others meet in a shuffle.
    ``left`` and ``right`` are written tables.
    """
    total = right.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    is_heavy = F.col(weight) > max(total * HEAVY_SHARE, HEAVY_LEAST)
    heavy, light = right.where(is_heavy), right.where(~is_heavy)
    names = [*left.columns, *[c for c in right.columns if c not in (key, weight)]]
    with_heavy = left.join(F.broadcast(heavy), key).select(names)
    others = left.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return with_heavy.union(others.join(light, key).select(names))


def spread_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join of a written ``left`` with ``right``, which has one wide row per key.

    Rows of keys with more than ``HEAVY_SHARE`` of ``left`` are dealt over as many salts as make parts of about
    a task's share, and only their right rows are repeated, once per salt. Only the heavy keys
    with their numbers of salts, 1 / ``HEAVY_SHARE`` rows at most, are broadcast.
    """
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = left.count()
    tasks = 2 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = counts.where(F.col("rows") > max(total * HEAVY_SHARE, HEAVY_LEAST)).select(
        key, F.ceil(F.col("rows") / max(total / tasks, HEAVY_LEAST / 2)).cast("int").alias("salts")
    )
    heavy = F.broadcast(materialised(heavy, "heavy"))
    salts = F.coalesce("salts", F.lit(1))
    dealt = left.join(heavy, key, "left").withColumn("salt", F.pmod(F.xxhash64(*left.columns), salts).cast("int"))
    repeated = right.join(heavy, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return dealt.drop("salts").join(repeated.drop("salts"), [key, "salt"]).drop("salt")
