"""Bounded labelled samples and the split that keeps rows out of training.

A null id counts as an empty one in the split, whose CRC-32 is 0, so its rows are held out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

FOLDS = 5


def held_out(doc_id: str | Column) -> Column:
    """Whether a document is kept from training: CRC-32 of its id as text, modulo 5, is 0. A null id counts as ''."""
    column = F.col(f"`{doc_id}`") if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def share_of_hash(seed: int, *columns: str | Column) -> Column:
    """A number in [0, 1) that follows from the columns."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30)) / float(1 << 30)


def shares(counts: dict, total: int, most: int | None = None, least: int = 0) -> dict:
    """Per label the share of its rows to take, so that about ``total`` rows are taken.

    Labels get equal numbers of rows, at most ``most`` and at least ``least`` as far as they have them; what a
    label has too few rows for goes to the others.
    """
    taken, left = {}, total
    for n, label in enumerate(sorted(counts, key=counts.get)):
        rows = max(least, left // (len(counts) - n))
        taken[label] = min(counts[label], rows if most is None else min(rows, most))
        left = max(0, left - taken[label])
    return {label: taken[label] / counts[label] for label in counts}


#: A count of distinct rows may be so far off, so that much more is taken before the exact limit.
SLACK = 1.1


def per_label(
    rows: DataFrame, label: str, keys: Sequence[str], values: Sequence[str],
    total: int, most: int | None, least: int, seed: int,
) -> DataFrame:
    """(label, *values) of at most ``total`` rows, shared out to all values of ``label`` as ``shares`` does.

    Rows are chosen by a hash of ``keys``, and rows equal in them count once, however often they come, so that neither an id nor a
    text that repeats can fill the sample or swell it. ``values`` follow from the keys. The limit is exact: behind the share of the
    hash, a label's rows are taken in the order of the hash up to its number. One row per label comes to the driver.
    """
    hashed = rows.withColumn("_pick", F.xxhash64(F.lit(seed), *keys))
    found = hashed.groupBy(label).agg(F.approx_count_distinct("_pick", 0.02).alias("n")).collect()
    counts = {r[label]: r["n"] for r in sorted(found, key=lambda r: r[label])}
    if not counts:
        return rows.select(label, *values).limit(0)
    wanted = [
        (name, min(1.0, share * SLACK), round(share * counts[name])) for name, share in shares(counts, total, most, least).items()
    ]
    schema = rows.select(label).schema.add("_share", "double").add("_rows", "long")
    shared = F.broadcast(rows.sparkSession.createDataFrame(wanted, schema))  # a row per label
    thinned = hashed.select(label, "_pick").join(shared, label).where(share_of_hash(seed, "_pick") < F.col("_share"))
    in_order = F.row_number().over(Window.partitionBy(label).orderBy("_pick"))
    picked = thinned.select(label, "_pick", "_rows").distinct().withColumn("_place", in_order)
    # At most ``total`` hashes.
    picked = F.broadcast(picked.where(F.col("_place") <= F.col("_rows")).select(label, "_pick"))
    once = hashed.join(picked, [label, "_pick"]).groupBy(label, "_pick").agg(*[F.first(v).alias(v) for v in values])
    return once.select(label, *values)
