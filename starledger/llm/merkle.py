"""A Merkle manifest of a table, with a proof for every row made by pointer jumping.

Every row is a leaf, the SHA-256 of its fields. Per group the leaves lie in the order of their key, and every
``FANOUT`` consecutive nodes become the hash of their digests until one is left, the group's subroot; subroots
in the order of the groups become the root in the same way. Each level is one aggregation by the first leaf
that a node covers, and has a ``FANOUT``-th of the rows of the level below.

Proofs: a node starts with a pointer to its parent and the *segment* of its siblings. A round joins the table of pointers
with itself, puts the parent's segments behind the node's own and takes over the parent's pointer, so that the
distance to the ancestor doubles; rounds end when all pointers have reached the root. Leaves of one
run differ only in their first segment, so the run is the row that jumps, and leaves take its proof at the end. After ``r`` rounds
only nodes ``2**r`` levels up are pointed to, so the other side of the join shrinks as the number of rows that
point to one of its rows grows; ``attach`` broadcasts it where it is small and salts heavy keys where it is not.

A proof is a text: per level the digests of the run with ``|`` in the place of the node, and ``;`` behind it. Folding
puts the digest found so far in the place of the mark and hashes again.

Defined cases: a null field is written as ``-``, so it differs from an empty one; null groups are a group, which comes first; null keys come first in
their group; rows with the same key lie in the order of their leaves, and exact copies are leaves of their own; a lone leaf is its
group's subroot and a lone subroot the root, without hashing; an empty table gives an empty
result; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starledger.operators.keys import number_rows
from starledger.operators.skew import attach
from starledger.session import materialised

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
MARK, BREAK = "|", ";"


def hashed(fields: Sequence[Column]) -> Column:
    """SHA-256 over fields, each as its UTF-8 length, a colon and its text, or ``-`` if null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def leaves(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    key: str = "doc_id",
    group: str = "source",
    changed: dict[str, Column] | None = None,
    when: Column | None = None,
) -> DataFrame:
    """(key, group, leaf, other_leaf): the digest of every row; ``other_leaf`` is that with ``changed`` fields, where ``when`` holds.

    The group is its text behind ``=``, or empty for null, so that it sorts as it should and joins.
    """
    columns = {f: F.col(f"`{f}`") for f in fields}
    other = hashed([(changed or {}).get(f, column) for f, column in columns.items()])
    return docs.select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("group"),
        hashed(list(columns.values())).alias("leaf"),
        F.when(F.lit(False) if when is None else when, other).alias("other_leaf"),
    )


def _node(tree: int, level: int, first: Column) -> Column:
    """One number for a node: its tree, its level, and the first leaf it covers."""
    return F.shiftleft(first.cast("long"), 6) + F.lit(tree * 32 + level)


def _cover(width: int) -> Column:
    """First leaf of the node of ``width`` leaves that holds a node."""
    return (F.col("start") + F.floor((F.col("first") - F.col("start")) / width) * width).cast("long")


def _segments(digests: Column, at: Column) -> Column:
    """The run's digests with a mark in place of number ``at``."""
    return F.concat(F.array_join(F.transform(digests, lambda d, n: F.when(n == at, F.lit(MARK)).otherwise(d)), ""), F.lit(BREAK))


@dataclass
class _Tree:
    tops: DataFrame  # (start, digest, node): the node that remains of each group
    links: DataFrame | None  # (node, up, path, level) of nodes above the lowest level given


def _climb(nodes: DataFrame, tree: int, level: int, most: int, fanout: int) -> _Tree:
    """Build the levels above ``nodes`` (first, start, n, digest), ``n`` being the leaves of its group, ``most`` the largest."""
    tops, links = [], []
    while True:
        width = fanout**level
        here = _node(tree, level, F.col("first"))
        tops.append(nodes.where(F.col("n") <= width).select("start", "digest", here.alias("node")))
        if most <= width:
            return _Tree(reduce(DataFrame.union, tops), reduce(DataFrame.union, links) if links else None)
        run = F.sort_array(F.collect_list(F.struct("first", "digest")))  # at most ``fanout`` nodes
        runs = (
            nodes.where(F.col("n") > width)
            .groupBy(_cover(width * fanout).alias("above"), "start", "n")
            .agg(run.alias("run"))
            .select(F.col("above").alias("first"), "start", "n", "run", F.sha2(F.array_join("run.digest", ""), 256).alias("digest"))
        )
        parents = materialised(runs, "level")
        child = parents.select("first", "run", F.posexplode("run").alias("at", "child"))
        links.append(
            child.select(
                _node(tree, level, F.col("child.first")).alias("node"), _node(tree, level + 1, F.col("first")).alias("up"),
                _segments(F.col("run.digest"), F.col("at")).alias("path"), F.lit(level + 32 * tree).alias("level"),
            )
        )
        nodes, level = parents.drop("run"), level + 1


def _jumped(pointers: DataFrame, hops: int) -> DataFrame:
    """All pointers moved to the root: (node, up, path, subroot, level)."""
    distance = 1
    while distance < hops:
        # What is pointed to lies so many levels above a run of leaves, or above the groups.
        above = pointers.where(F.col("level") > distance).select(
            F.col("node").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"), F.col("subroot").alias("_subroot")
        )
        joined = attach(pointers, above, "up")
        pointers = materialised(
            joined.select(
                "node", F.col("_up").alias("up"),
                F.concat("path", F.coalesce("_path", F.lit(""))).alias("path"),
                F.coalesce("subroot", "_subroot").alias("subroot"), "level",
            ),
            "pointers",
        )
        distance *= 2
    return pointers


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    key: str = "doc_id",
    group: str = "source",
    changed: dict[str, Column] | None = None,
    when: Column | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """Per row key, leaf, other_leaf, subroot, root and ``proof``, the segments from the leaf to the root."""
    spark = docs.sparkSession
    # Hashed once: numbering samples its input.
    hashed_rows = materialised(leaves(docs, fields, key, group, changed, when), "leaves")
    ranked = number_rows(hashed_rows, ["group", "key", "leaf"], "rank")
    extents = materialised(
        ranked.groupBy("group").agg((F.min("rank") - 1).alias("start"), F.count(F.lit(1)).alias("n")), "groups"
    )
    groups, most = extents.agg(F.count(F.lit(1)), F.max("n")).first()
    placed = attach(ranked, extents, "group").withColumn("first", F.col("rank") - 1)
    # Runs of leaves: neighbours by rank, which are in one task already but for its ends.
    holder = F.when(F.col("n") > 1, _node(0, 1, _cover(fanout))).otherwise(_node(0, 0, F.col("first")))
    first = F.when(F.col("n") > 1, _cover(fanout)).otherwise(F.col("first"))
    runs = materialised(
        placed.groupBy(holder.alias("node"), first.alias("first"), "start", "n")
        .agg(F.sort_array(F.collect_list(F.struct("first", "key", "leaf", "other_leaf"))).alias("run"))
        .withColumn("digest", F.when(F.col("n") > 1, F.sha2(F.array_join("run.leaf", ""), 256)).otherwise(F.col("run")[0]["leaf"])),
        "runs",
    )
    lone = runs.where("n = 1").select("start", "digest", "node")
    upper = _climb(runs.where("n > 1").select("first", "start", "n", "digest"), 0, 1, most or 0, fanout)
    tops = number_rows(upper.tops.union(lone), ["start"], "rank")
    subroots = tops.select((F.col("rank") - 1).alias("first"), F.lit(0).cast("long").alias("start"),
                           F.lit(groups).cast("long").alias("n"), "digest")
    over = _climb(subroots, 1, 0, groups, fanout)
    top = over.tops.first()
    root = top["digest"] if top else None
    nothing = F.lit(None).cast("string").alias("subroot")
    links = [f.links.select("node", "up", "path", nothing, "level") for f in (upper, over) if f.links is not None]
    # A subroot goes on as a leaf of the upper tree, and the root points nowhere.
    named = tops.select("node", _node(1, 0, F.col("rank") - 1).alias("up"), F.lit("").alias("path"),
                        F.col("digest").alias("subroot"), F.lit(32).alias("level"))
    end = spark.createDataFrame([(top["node"],)] if top else [], "node long").select(
        "node", F.lit(None).cast("long").alias("up"), F.lit("").alias("path"), nothing, F.lit(64).alias("level"))
    pointers = materialised(reduce(DataFrame.union, [*links, named, end]), "pointers")
    hops = _depth(most or 0, fanout) + 1 + _depth(groups, fanout)
    proofs = _jumped(pointers, hops).select("node", "path", "subroot")
    # One row on either side.
    rows = attach(runs, proofs, "node", reduced=True)
    at = rows.select("n", "run", "path", "subroot", F.posexplode("run").alias("at", "own"))
    own = F.when(F.col("n") > 1, _segments(F.col("run.leaf"), F.col("at"))).otherwise(F.lit(""))
    return at.select(
        F.col("own.key").alias("key"), "own.leaf", "own.other_leaf", "subroot", F.lit(root).cast("string").alias("root"),
        F.concat(own, "path").alias("proof"),
    )


def _depth(leaves_: int, fanout: int) -> int:
    """Levels above the leaves of a tree."""
    depth, width = 0, 1
    while width < leaves_:
        depth, width = depth + 1, width * fanout
    return depth


def siblings_digest(proof: Column) -> Column:
    """SHA-256 of all siblings, from the leaf's to the root's children, left to right."""
    return F.sha2(F.translate(proof, MARK + BREAK, ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    levels = F.filter(F.split(proof, BREAK), lambda s: s != "")
    return F.aggregate(levels, leaf, lambda found, s: F.sha2(F.replace(s, F.lit(MARK), found), 256))


def tampering(doc_id: str = "doc_id", text: str = "text") -> tuple[dict[str, Column], Column]:
    """Changed fields and where they hold, for a check of proofs: text in lower case where 5 divides the CRC-32 of the id.

    A null id is left alone.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    divided = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 5 == 0
    return {text: F.translate(F.col(f"`{text}`"), upper, lower)}, F.coalesce(divided, F.lit(False))


def verified(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
             fields: Sequence[str] = FIELDS) -> DataFrame:
    """The manifest of ``docs`` checked against tampered rows: folding their leaves must not lead to the root."""
    changed, when = tampering(doc_id, text)
    found = manifest(docs, fields, doc_id, source, changed, when)
    checked = found.withColumn("folded_root", folded(F.coalesce("other_leaf", "leaf"), F.col("proof")))
    return checked.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", siblings_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "proof",
    )
