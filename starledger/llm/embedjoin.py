"""Near-duplicate vectors by an epsilon grid order join.

Cosine at least ``c`` between vectors is Euclidean distance at most ``sqrt(2 - 2c)``, epsilon, between
their unit vectors. Unit vectors are sorted by their grid cells (epsilon wide) on the leading principal dimensions and
numbered in that order, and the sequence is cut into intervals. Starting from the whole sequence,
pairs of intervals are split into pairs of their parts, and a pair goes as soon as the boxes around
its vectors (leading dimensions and what is left of the norm) lie further apart than epsilon. The pairs of
blocks that remain are joined one by one in tasks, where the same recursion goes on in memory down to small intervals.

A task reports, per vector, how many vectors it is linked with there and one vector of its local component,
so links inside a large group of near copies are counted but never listed. Equal vectors are one row with a
count from the start. The principal dimensions come from ``SAMPLE`` vectors chosen by hash; they
only decide how much can be skipped, not what is found.

Defined cases: a vector that is null, empty, zero or has a null or non-finite component links with nothing and is
its own component; vectors of different lengths never link; repeated rows are linked with each other; a
null id never names a component unless all its ids are null; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from starledger.llm.components import attach_weighed, components
from starledger.operators.keys import number_rows
from starledger.session import materialised

#: Vectors that the principal dimensions are fitted on.
SAMPLE = 4096
#: Leading dimensions that order the vectors, and those that bound the boxes.
ORDER_DIMENSIONS = 8
BOX_DIMENSIONS = 16
BLOCK = 4096
LEAF = 512
FAN_OUT = 8


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _by_length(vectors: pa.Array):
    """Rows and matrix of the vectors of each length."""
    flat = np.asarray(vectors.flatten(), dtype=np.float64)
    lengths = np.asarray(vectors.value_lengths(), dtype=np.int64)
    ends = np.cumsum(lengths)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield int(length), rows, flat[(ends[rows] - length)[:, None] + np.arange(length)]


def _valid(vector: str) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _axes(classes: DataFrame) -> tuple[int, np.ndarray]:
    """The most common length in the sample and the leading principal dimensions of its vectors."""
    sample = classes.select("embedding").orderBy(F.xxhash64("embedding")).limit(SAMPLE).toArrow()
    found = [(len(rows), length, matrix) for length, rows, matrix in _by_length(sample.column(0).combine_chunks())]
    if not found:
        return 0, np.zeros((0, 0))
    _, length, matrix = max(found, key=lambda x: x[:2])
    units = unit_rows(matrix)
    _, vectors = np.linalg.eigh(np.cov(units.T.reshape(length, -1), bias=True).reshape(length, length))
    return length, vectors[:, ::-1][:, :BOX_DIMENSIONS]


def _coordinates(units: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Leading coordinates and the norm of the rest, padded with zeros to a fixed width."""
    out = np.zeros((len(units), BOX_DIMENSIONS + 1))
    if axes.shape[0] == units.shape[1]:
        lead = units @ axes
        out[:, : lead.shape[1]] = lead
        out[:, -1] = np.sqrt(np.maximum(1 - (lead**2).sum(axis=1), 0))
    return out


def _with_coordinates(classes: DataFrame, axes: np.ndarray) -> DataFrame:
    added = T.StructField("coordinates", T.ArrayType(T.DoubleType()))
    out = T.StructType([*classes.schema.fields, added])

    def run(batches):
        for batch in batches:
            found = np.zeros((batch.num_rows, BOX_DIMENSIONS + 1))
            for _, rows, matrix in _by_length(batch.column("embedding")):
                found[rows] = _coordinates(unit_rows(matrix), axes)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * found.shape[1])
            column = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=out.names)

    return classes.mapInArrow(run, out)


def _boxes(blocks: DataFrame, level: int) -> DataFrame:
    """Boxes around the intervals of ``level``: each holds ``FAN_OUT ** level`` blocks."""
    part = F.floor(F.col("block") / FAN_OUT**level).cast("long")
    return blocks.groupBy(part.alias("part")).agg(
        *[F.min(f"low_{i}").alias(f"low_{i}") for i in range(BOX_DIMENSIONS + 2)],
        *[F.max(f"high_{i}").alias(f"high_{i}") for i in range(BOX_DIMENSIONS + 2)],
    )


def _box_pairs(blocks: DataFrame, count: int, epsilon: float) -> DataFrame:
    """Pairs of blocks (a, b), a <= b, whose boxes are not provably apart, from the whole sequence down."""
    pairs = blocks.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    top = 0
    while FAN_OUT**top < count:
        top += 1
    for level in reversed(range(top)):
        boxes = _boxes(blocks, level)
        up = F.floor(F.col("part") / FAN_OUT).cast("long")
        left = boxes.select(up.alias("a"), *[F.col(c).alias(f"a_{c}") for c in boxes.columns])
        right = boxes.select(up.alias("b"), *[F.col(c).alias(f"b_{c}") for c in boxes.columns])

        def gap(i: int) -> Column:
            return F.greatest(
                F.lit(0.0), F.col(f"a_low_{i}") - F.col(f"b_high_{i}"), F.col(f"b_low_{i}") - F.col(f"a_high_{i}")
            )

        squares = sum((gap(i) * gap(i) for i in range(BOX_DIMENSIONS + 1)), F.lit(0.0))
        # The last bound is the vector length: different lengths never link.
        near = (squares <= (epsilon + 1e-9) ** 2) & (gap(BOX_DIMENSIONS + 1) == 0) & (F.col("a_part") <= F.col("b_part"))
        halves = pairs.join(left, "a").withColumnRenamed("b", "of_b")
        pairs = halves.join(right, (F.col("of_b") == F.col("b")) & near).select(
            F.col("a_part").alias("a"), F.col("b_part").alias("b")
        )
        pairs = materialised(pairs, "pairs")
    return pairs


class _Joiner:
    """Joins two sorted intervals in memory and adds up links and local components."""

    def __init__(self, cosine: float):
        self.cosine, self.epsilon = cosine, math.sqrt(2 - 2 * cosine)

    def join(self, a: dict, b: dict | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links and smallest local relative of the vectors of ``a`` and then of ``b``; ``b`` None: ``a`` with itself."""
        self.a, self.b, self.shift = a, b or a, len(a["pos"]) if b else 0
        pos = np.concatenate([a["pos"], b["pos"]]) if b else a["pos"]
        self.links = np.zeros(len(pos), dtype=np.int64)
        self.low = np.arange(len(pos))
        self._split(0, len(self.a["pos"]), 0, len(self.b["pos"]))
        return pos, self.links, pos[self._roots(np.arange(len(pos)))]

    def _split(self, a0: int, a1: int, b0: int, b1: int) -> None:
        if a0 == a1 or b0 == b1 or (not self.shift and a0 >= b1):
            return
        one, two = self.a["at"][a0:a1], self.b["at"][b0:b1]
        gap = np.maximum(0, np.maximum(one.min(0) - two.max(0), two.min(0) - one.max(0)))
        if (gap * gap).sum() > (self.epsilon + 1e-9) ** 2:
            return
        if a1 - a0 <= LEAF and b1 - b0 <= LEAF:
            return self._leaf(a0, a1, b0, b1)
        am, bm = (a0 + a1) // 2, (b0 + b1) // 2
        if not self.shift and a0 == b0:
            parts = [(a0, am, a0, am), (a0, am, am, a1), (am, a1, am, a1)]
        elif a1 - a0 >= b1 - b0:
            parts = [(a0, am, b0, b1), (am, a1, b0, b1)]
        else:
            parts = [(a0, a1, b0, bm), (a0, a1, bm, b1)]
        for part in parts:
            self._split(*part)

    def _leaf(self, a0: int, a1: int, b0: int, b1: int) -> None:
        one, two = self.a["unit"][a0:a1], self.b["unit"][b0:b1]
        rough = self.a["rough"][a0:a1] @ self.b["rough"][b0:b1].T
        margin = max(1e-4, one.shape[1] * 2.4e-7)
        linked = rough >= self.cosine
        # What single precision cannot decide is decided in double precision.
        i, j = np.nonzero(np.abs(rough - self.cosine) <= margin)
        if len(i):
            linked[i, j] = np.einsum("ij,ij->i", one[i], two[j]) >= self.cosine
        same = not self.shift and a0 == b0
        if same:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return
        self.links[a0:a1] += linked @ self.b["n"][b0:b1]
        if not same:
            self.links[self.shift + b0 : self.shift + b1] += self.a["n"][a0:a1] @ linked
        i, j = np.nonzero(linked)
        self._unite(i + a0, j + b0 + self.shift)

    def _roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.low[x]
            if (up == x).all():
                return x
            x = up

    def _unite(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            i, j = self._roots(i), self._roots(j)
            apart = i != j
            if not apart.any():
                return
            i, j = i[apart], j[apart]
            np.minimum.at(self.low, np.maximum(i, j), np.minimum(i, j))


def _pair_kernel(cosine: float, axes: np.ndarray):
    def kernel(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side, pos, n = (table.column(c).to_numpy() for c in ("side", "pos", "n"))
        out = []
        for _, rows, matrix in _by_length(table.column("embedding").combine_chunks()):
            units = unit_rows(matrix)
            places = _coordinates(units, axes)
            order = np.lexsort((pos[rows], side[rows]))
            parts = []
            for which in (0, 1):
                chosen = order[side[rows][order] == which]
                parts.append({
                    "pos": pos[rows][chosen], "n": n[rows][chosen], "unit": units[chosen], "at": places[chosen],
                    "rough": units[chosen].astype(np.float32),
                })
            alone = table.column("a")[0].as_py() == table.column("b")[0].as_py()
            if alone or (len(parts[0]["pos"]) and len(parts[1]["pos"])):
                out.append(_Joiner(cosine).join(parts[0], None if alone else parts[1]))
        found = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        some = found[1] > 0
        return pa.table({k: pa.array(v[some].astype(np.int64)) for k, v in zip(("pos", "links", "low"), found)})

    return kernel


def near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = 0.9
) -> DataFrame:
    """Per row ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    ``n_links`` counts the other rows with a cosine of at least ``cosine``; ``component_id`` is
    the smallest id reachable through such links.
    """
    rows = materialised(
        vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").alias("embedding")).withColumn(
            "valid", _valid("embedding")
        ),
        "vectors",
    )
    valid = rows.where("valid").select("vec_id", "embedding")
    classes = materialised(
        valid.groupBy("embedding").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id")), "classes"
    )
    length, axes = _axes(classes)
    epsilon = math.sqrt(2 - 2 * cosine)
    placed = _with_coordinates(classes, axes).withColumn("size", F.size("embedding"))
    cells = [f"cell_{i}" for i in range(ORDER_DIMENSIONS)]
    placed = placed.withColumns(
        {c: F.floor(F.col("coordinates")[i] / epsilon).cast("int") for i, c in enumerate(cells)}
    )
    numbered = number_rows(placed, ["size", *cells], "pos").withColumn(
        "block", F.floor((F.col("pos") - 1) / BLOCK).cast("long")
    )
    bounds = [*[F.col("coordinates")[i] for i in range(BOX_DIMENSIONS + 1)], F.col("size").cast("double")]
    blocks = materialised(
        numbered.groupBy("block").agg(
            *[F.min(b).alias(f"low_{i}") for i, b in enumerate(bounds)],
            *[F.max(b).alias(f"high_{i}") for i, b in enumerate(bounds)],
        ),
        "boxes",
    )
    pairs = _box_pairs(blocks, blocks.count(), epsilon)
    both = pairs.select("a", "b", F.lit(0).alias("side"), F.col("a").alias("block")).union(
        pairs.where("a != b").select("a", "b", F.lit(1).alias("side"), F.col("b").alias("block"))
    )
    sent = numbered.select("block", "pos", "n", "embedding").join(both, "block")
    # A group is two blocks.
    found = sent.select("a", "b", "side", "pos", "n", "embedding").groupBy("a", "b").applyInArrow(
        _pair_kernel(cosine, axes), "pos long, links long, low long"
    )
    found = materialised(found, "linked")
    links = found.groupBy("pos").agg(F.sum("links").alias("links"))
    joined = components(found.where("pos != low").select(F.col("pos").alias("a"), F.col("low").alias("b")).distinct())
    named = (
        numbered.select("pos", "n", "first_id", "embedding")
        .join(links, "pos", "left")
        .join(joined.withColumnRenamed("node", "pos"), "pos", "left")
        .withColumn("component", F.coalesce("component", "pos"))
    )
    named = materialised(named, "named")
    # A component may hold a large part of the vectors.
    smallest = materialised(
        named.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("members")), "smallest"
    )
    named = materialised(
        attach_weighed(named, smallest, "component", "members").select(
            "embedding", F.col("n").alias("copies"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id",
        ),
        "results",
    )
    linked = attach_weighed(valid, named, "embedding", "copies").select("vec_id", "n_links", "component_id")
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
