"""Shards of near equal bytes through fixed virtual slots.

Records are hashed into ``SLOTS`` slots that never change. Bytes and rows are added up per
slot, and a versioned table maps slots to shards. The first map deals the slots from the largest to
the emptiest shard; a later version is the former one with as few slots moved as balance needs, so that
rebalancing, or another number of shards, moves few records. Only the slot loads, ``SLOTS`` rows
at most, come to the driver. A record's place inside its shard is its place inside its slot after the
rows of the shard's earlier slots, so no shard is ever sorted as a whole.

The law is ``bytes``: the sizes of the shards are near equal.

A record's slot follows from its id, size and checksum. Of rows that repeat more often than ``REPEATS`` times in a slot's mean share,
every copy has a number, and the numbers are dealt over as many slots as the copies need; so a row that is a third of the table
still fills no slot beyond its share.

Defined cases: a null text has no bytes and checksum 0; a null id is a value like any other; repeated rows
have places of their own, and it does not matter which copy has which; an empty table gives an empty result and an even
map; further columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from starledger.operators.keys import number_rows
from starledger.session import materialised, scratch_path

SLOTS = 4096
HEADER = 8
#: Equal rows are spread from this part of a slot's mean share on, over so many slots for each mean share they have.
REPEATS = 0.5
PARTS = 4
#: A shard may hold this much more than the mean before slots are moved.
TOLERANCE = 0.01
MAP_COLUMNS = "version int, virtual_slot int, shard int, bytes long, rows long, place_from long"


def records(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) of every row, written."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    narrow = materialised(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            (F.octet_length(body) + HEADER).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
        ),
        "records",
    )
    repeated = _repeated(narrow, slots)
    if repeated is None:
        return narrow.withColumn("virtual_slot", _slot(slots))
    # ``same`` tells the rows apart, also those with a null id; the table has 4 * slots rows at most.
    marked = narrow.withColumn("same", F.xxhash64("doc_id", "size", "text_crc32"))
    marked = materialised(marked.join(F.broadcast(repeated), "same", "left"), "marked")
    plain = marked.where("number IS NULL").withColumn("virtual_slot", _slot(slots))
    # Copies are numbered along a distributed order, not in one task.
    counted = number_rows(marked.where("number IS NOT NULL"), ["number"], "rank")
    copy = F.pmod(F.col("rank") - F.col("before") - 1, F.col("parts"))
    names = [*narrow.columns, "virtual_slot"]
    return plain.select(names).union(counted.withColumn("virtual_slot", _slot(slots, copy)).select(names))


def _slot(slots: int, *more: Column) -> Column:
    return F.pmod(F.xxhash64("doc_id", "size", "text_crc32", *more), F.lit(slots)).cast("int")


def _repeated(narrow: DataFrame, slots: int) -> DataFrame | None:
    """(same, number, before, parts): hashes of rows that fill more than ``REPEATS`` of a slot's mean share of rows or bytes.

    ``before`` counts the copies of those with smaller numbers. ``parts`` is over how many slots its copies go.
    """
    rows, size = narrow.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    share = F.greatest(F.col("rows") * (slots / max(rows, 1)), F.col("bytes") * (slots / max(size, 1)))
    counted = narrow.groupBy(F.xxhash64("doc_id", "size", "text_crc32").alias("same")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")
    )
    # Each has at least REPEATS / slots of all rows or all bytes.
    heavy = materialised(counted.where((F.col("rows") > 1) & (share > REPEATS)), "repeated")
    if heavy.isEmpty():
        return None
    along = Window.orderBy("same")
    return heavy.select(
        "same", F.row_number().over(along).alias("number"),
        (F.sum("rows").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")).alias("before"),
        F.least(F.col("rows"), F.ceil(share * PARTS)).cast("long").alias("parts"),
    )


def slot_loads(placed: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows per slot; one row per slot comes to the driver."""
    loads = placed.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return {r["virtual_slot"]: (r["bytes"], r["rows"]) for r in loads.collect()}


def first_map(loads: dict[int, tuple[int, int]], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Slot to shard: the largest slot first, each to the shard with the fewest bytes, then rows."""
    heap = [(0, 0, shard) for shard in range(shards)]
    assigned = {}
    for slot in sorted(range(slots), key=lambda s: (*(-x for x in loads.get(s, (0, 0))), s)):
        size, rows = loads.get(slot, (0, 0))
        held, count, shard = heapq.heappop(heap)
        assigned[slot] = shard
        heapq.heappush(heap, (held + size, count + max(rows, 1), shard))
    return assigned


def rebalanced(
    current: dict[int, int], loads: dict[int, tuple[int, int]], shards: int, tolerance: float = TOLERANCE
) -> dict[int, int]:
    """``current`` edited for new loads or another number of shards, with few slots moved."""
    held: dict[int, list[int]] = {shard: [] for shard in range(shards)}
    homeless = []
    for slot, shard in sorted(current.items()):
        held[shard].append(slot) if shard < shards else homeless.append(slot)
    weight = {slot: loads.get(slot, (0, 0))[0] for slot in current}
    total = {shard: sum(weight[s] for s in own) for shard, own in held.items()}
    for slot in sorted(homeless, key=lambda s: (-weight[s], s)):
        to = min(total, key=lambda shard: (total[shard], shard))
        held[to].append(slot)
        total[to] += weight[slot]
    mean = sum(total.values()) / shards
    while True:
        full = max(total, key=lambda shard: (total[shard], -shard))
        empty = min(total, key=lambda shard: (total[shard], shard))
        gap = total[full] - total[empty]
        # The slot that comes nearest to closing the gap; it must narrow it.
        movable = [s for s in held[full] if 0 < weight[s] < gap]
        if (total[full] <= mean * (1 + tolerance) and total[empty] >= mean * (1 - tolerance)) or not movable:
            break
        slot = min(movable, key=lambda s: (abs(gap / 2 - weight[s]), s))
        held[full].remove(slot)
        held[empty].append(slot)
        total[full] -= weight[slot]
        total[empty] += weight[slot]
    return {slot: shard for shard, own in held.items() for slot in own}


def write_map(
    spark: SparkSession, path: str, version: int, assigned: dict[int, int], loads: dict[int, tuple[int, int]]
) -> DataFrame:
    """Store one version of the map, with the loads it was made for, and read it back."""
    before: dict[int, int] = {}
    rows = []
    for slot in sorted(assigned):
        size, count = loads.get(slot, (0, 0))
        start = before.get(assigned[slot], 0)
        rows.append((version, slot, assigned[slot], size, count, start))
        before[assigned[slot]] = start + count
    spark.createDataFrame(rows, MAP_COLUMNS).coalesce(1).write.parquet(f"{path}/v{version:06d}")
    return read_map(spark, path, version)


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_COLUMNS).parquet(f"{path}/v{version:06d}")


def map_rows(stored: DataFrame) -> dict[int, int]:
    return {r["virtual_slot"]: r["shard"] for r in stored.select("virtual_slot", "shard").collect()}


def placed_by(placed: DataFrame, stored: DataFrame) -> DataFrame:
    """``placed`` with shard, place in the shard (gapless from 0) and the version of the map."""
    # One row per slot: a broadcast of SLOTS rows.
    mapped = placed.join(F.broadcast(stored.select("version", "virtual_slot", "shard", "place_from")), "virtual_slot")
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    place = F.col("place_from") + F.row_number().over(inside) - 1
    return mapped.withColumn("place", place.cast("long")).drop("place_from")


def sharded(
    docs: DataFrame,
    shards: int,
    doc_id: str = "doc_id",
    text: str = "text",
    slots: int = SLOTS,
    path: str | None = None,
    then: int | None = None,
) -> DataFrame:
    """Per row doc_id, size, text_crc32, virtual_slot, version, shard and place, by a new map.

    The map is stored under ``path``, or in the shared folder. With ``then`` shards to come, a second version is edited from the
    stored one and stored too, and ``next_version``, ``next_shard`` and ``next_place`` tell where it puts the row.
    """
    spark = docs.sparkSession
    placed = materialised(records(docs, doc_id, text, slots), "slots")
    loads = slot_loads(placed)
    path = path or scratch_path(spark, "slotmap")
    first = write_map(spark, path, 1, first_map(loads, shards, slots), loads)
    found = placed_by(placed, first)
    if then is None:
        return found
    edited = write_map(spark, path, 2, rebalanced(map_rows(read_map(spark, path, 1)), loads, then), loads)
    # A place inside the slot is the same under both maps.
    starts = first.select("virtual_slot", F.col("place_from").alias("_from")).join(
        edited.select("virtual_slot", F.col("version").alias("next_version"), F.col("shard").alias("next_shard"),
                      F.col("place_from").alias("_next_from")), "virtual_slot")
    moved = found.join(F.broadcast(starts), "virtual_slot")  # a row per slot
    return moved.withColumn("next_place", F.col("place") - F.col("_from") + F.col("_next_from")).drop("_from", "_next_from")
