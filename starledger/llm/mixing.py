"""Mixing sources to target weights by a min-cost flow over membership patterns.

A document belongs to one source or, where sources overlap, to several. Documents with the same set of
sources form a *pattern*, and only patterns (their words and rows) enter the flow. There word capacity
flows from patterns to the quotas of the sources; the first use of a pattern's words is free, each
repetition costs more than the one before (``REPEAT_COSTS``), so repetition is spread before it is
deepened. A source that occurs in one pattern only, and alone there, has nothing to choose: its pattern gives what the
quota asks for. Sources that overlap, directly or over others, are a component, and every component's flow is one task.
No list of sources or patterns comes to the driver, however many there are.

A pattern's flow then becomes whole documents: every document the same number of
times, and a seeded choice of them once more. The choice is a prefix in the order of a seeded hash, found
through sums per hash bucket; around its end, whole documents are chosen so that they fill the gap, and
where very long documents leave it open, further rounds go on with those that still fit.

Targets: weights share all words; no target is above ``len(REPEAT_COSTS)`` times its source's
words, and what is over is shared again by weight. The level at which that comes to rest rises from round to round, each
being one aggregation over the sources.

Defined cases: a null text has no words; a null source is a source of its own and comes last; a document
without any source is not taken; repeated rows (same id, size and text) are taken together; an
empty table gives an empty result; a table without words takes nothing; other columns, whatever
their names, are kept by ``expanded`` and ignored by ``mixed``.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from starledger.llm.components import components
from starledger.operators.keys import number_rows
from starledger.operators.skew import KeyProfile, attach, measured_small, salted_join
from starledger.session import materialised

#: Cost of using a word once, twice, three times; its length is how often a document may be used.
REPEAT_COSTS = (0, 1, 3)
SEED = 20240607
WEIGHTS = (1, 2, 3)
#: Rows that a hash bucket holds on average, and rows on either side of the prefix's end that may fill the gap.
BUCKET_ROWS = 256
FILL_ROWS = 256
MAX_BUCKETS = 1 << 20
#: A gap above this share of what a pattern gives is filled in a further round, up to so many.
GAP = 0.0005
ROUNDS = 5

Source = str | None
#: Adds ``weight`` to the sources (source, size).
Weights = Callable[[DataFrame], DataFrame]


def cycled_weights(sources: DataFrame) -> DataFrame:
    """Weights 1, 2, 3, repeating, by code point, null last."""
    last = sources.withColumn("_last", F.col("source").isNull())
    numbered = number_rows(last, ["_last", "source"], "_number").drop("_last")
    cycle = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    return numbered.withColumn("weight", F.get(cycle, F.pmod(F.col("_number") - 1, len(WEIGHTS)))).drop("_number")


def with_targets(sources: DataFrame, total: int) -> DataFrame:
    """``sources`` (a written table with size and weight) with ``target``: ``total`` by weight, held at the most a source can give."""
    most = (len(REPEAT_COSTS) * F.col("size")).cast("double")
    level, held = 0.0, -1
    while True:
        over = F.col("weight") * level > most
        count, given, free = sources.agg(
            F.count_if(over), F.coalesce(F.sum(F.when(over, most)), F.lit(0.0)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if count == held or not free:
            return sources.withColumn("target", F.when(over, most).otherwise(F.col("weight") * level))
        level, held = (total - given) / free, count


@dataclass
class _Arc:
    to: int
    room: int
    cost: int
    back: int


class _Network:
    """Min-cost flow by cheapest paths with potentials, all paths of one length at a time."""

    def __init__(self, nodes: int):
        self.arcs: list[list[_Arc]] = [[] for _ in range(nodes)]

    def join(self, a: int, b: int, room: int, cost: int) -> _Arc:
        arc = _Arc(b, room, cost, len(self.arcs[b]))
        self.arcs[a].append(arc)
        self.arcs[b].append(_Arc(a, 0, -cost, len(self.arcs[a]) - 1))
        return arc

    def fill(self, source: int, sink: int) -> None:
        # Costs are small whole numbers, so paths have few lengths.
        height = [0] * len(self.arcs)
        while self._raise(height, source, sink):
            while (depth := self._layers(height, source, sink)) is not None:
                self._block(height, depth, source, sink)

    def _raise(self, height: list[int], source: int, sink: int) -> bool:
        """Add the lengths of the cheapest paths to the heights; whether the sink can be reached."""
        far, done, heap = {source: 0}, set(), [(0, source)]
        while heap:
            length, node = heapq.heappop(heap)
            if node in done:
                continue
            done.add(node)
            for arc in self.arcs[node]:
                if arc.room > 0 and arc.to not in done:
                    reach = length + arc.cost + height[node] - height[arc.to]
                    if reach < far.get(arc.to, reach + 1):
                        far[arc.to] = reach
                        heapq.heappush(heap, (reach, arc.to))
        end = max(far.values())
        for node in range(len(height)):
            height[node] += far.get(node, end)
        return sink in far

    def _layers(self, height: list[int], source: int, sink: int) -> list[int] | None:
        """Arcs from the source to each node along cheapest paths; None if the sink is not reached."""
        depth = [-1] * len(self.arcs)
        depth[source], layer = 0, [source]
        while layer and depth[sink] < 0:
            onward = []
            for node in layer:
                for arc in self.arcs[node]:
                    if arc.room > 0 and depth[arc.to] < 0 and arc.cost + height[node] == height[arc.to]:
                        depth[arc.to] = depth[node] + 1
                        onward.append(arc.to)
            layer = onward
        return depth if depth[sink] >= 0 else None

    def _block(self, height: list[int], depth: list[int], source: int, sink: int) -> None:
        """Fill paths from layer to layer until each has a full arc."""
        tried = [0] * len(self.arcs)
        path: list[_Arc] = []
        node = source
        while True:
            if node == sink:
                amount = min(arc.room for arc in path)
                for arc in path:
                    arc.room -= amount
                    self.arcs[arc.to][arc.back].room += amount
                full = next(n for n, arc in enumerate(path) if arc.room == 0)
                node = source if full == 0 else path[full - 1].to
                del path[full:]
            arcs = self.arcs[node]
            while tried[node] < len(arcs):
                arc = arcs[tried[node]]
                if arc.room > 0 and depth[arc.to] == depth[node] + 1 and arc.cost + height[node] == height[arc.to]:
                    break
                tried[node] += 1
            else:
                if node == source:
                    return
                path.pop()
                node = path[-1].to if path else source
                tried[node] += 1
                continue
            path.append(arc)
            node = arc.to


def route(words: dict[tuple[Source, ...], int], quotas: dict[Source, int]) -> dict[tuple[Source, ...], int]:
    """Words to take from each pattern so that sources meet their quotas as cheaply as can be."""
    sources = sorted({s for p in words for s in p})
    at = {s: 2 + len(words) + n for n, s in enumerate(sources)}
    net = _Network(2 + len(words) + len(sources))
    uses = {}
    for n, (pattern, most) in enumerate(words.items()):
        uses[pattern] = [net.join(0, 2 + n, most, cost) for cost in REPEAT_COSTS]
        for s in pattern:
            net.join(2 + n, at[s], len(REPEAT_COSTS) * most, 0)
    for s in sources:
        net.join(at[s], 1, quotas[s], 0)
    net.fill(0, 1)
    return {pattern: sum(words[pattern] - arc.room for arc in arcs) for pattern, arcs in uses.items()}


def _keyed(docs: DataFrame, doc_id: str, text: str, source: str, seed: int) -> DataFrame:
    """Columns of ``docs`` in ``row``, and its sources, their pattern as a text, size and seeded key."""
    body = F.col(f"`{text}`")
    sources = F.col(f"`{source}`")
    if dict(docs.dtypes)[source].startswith("array"):
        held = F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>"))))
    else:
        held = F.array(sources.cast("string"))
    # With their lengths no two lists of sources are written alike.
    written = F.transform(held, lambda s: F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        held.alias("held"),
        F.array_join(written, ",").alias("pattern"),
        F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), body).alias("key"),
    )


class _PerPattern:
    """Joins of rows with a table of a row per pattern: broadcast where the plan is small, else with heavy patterns salted."""

    def __init__(self, rows: DataFrame, plan: DataFrame):
        self._few = measured_small(plan.select("pattern", "goal", "copies", "rest", "buckets"))
        self._profile = KeyProfile(rows, "pattern")

    def __call__(self, left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        if self._few:
            return left.join(F.broadcast(right), "pattern", how)
        return salted_join(left, right, "pattern", how, self._profile)


@dataclass
class Mix:
    """What was decided: per pattern the copies and its sources with their targets, and the documents used once more."""

    plan: DataFrame
    taken: DataFrame
    chosen: DataFrame
    per_pattern: _PerPattern


def _source_key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("source_key")


def _route_component(rows: pd.DataFrame) -> pd.DataFrame:
    """Goals of the patterns of one component."""
    words = {tuple(keys): n for keys, n in zip(rows["keys"], rows["words"].tolist())}
    quotas = {k: q for keys, own in zip(rows["keys"], rows["quotas"]) for k, q in zip(keys, own.tolist())}
    flow = route(words, quotas)
    return pd.DataFrame({"pattern": rows["pattern"], "goal": [flow[tuple(keys)] for keys in rows["keys"]]})


def _goals(patterns: DataFrame) -> DataFrame:
    """(pattern, goal): words to take of each of the ``patterns`` (pattern, words, sources, keys, quotas), a written table."""
    most = len(REPEAT_COSTS) * F.col("words")
    alone = patterns.where(F.size("keys") == 1).withColumn("key", F.col("keys")[0])
    overlapping = patterns.where(F.size("keys") > 1)
    quota = F.least(F.col("quotas")[0], most).alias("goal")
    if overlapping.isEmpty():
        return alone.select("pattern", quota)
    links = overlapping.select(F.col("keys")[0].alias("a"), F.explode("keys").alias("b")).where("a != b")
    groups = components(links.distinct()).withColumnRenamed("node", "key")
    # A source is one row on either side; a pattern of several meets the component of its first.
    single = alone.join(groups, "key", "left")
    touching = single.where("component IS NOT NULL").unionByName(
        attach(overlapping.withColumn("key", F.col("keys")[0]), groups, "key")
    )
    flow = touching.select("component", "pattern", "words", "keys", "quotas").groupBy("component").applyInPandas(
        _route_component, "pattern string, goal long"
    )
    return single.where("component IS NULL").select("pattern", quota).union(flow)


def decide(narrow: DataFrame, weights: Weights) -> Mix:
    """``narrow`` is a written table of (held, pattern, size, key)."""
    counted = narrow.groupBy("pattern").agg(
        F.first("held").alias("held"), F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")
    )
    patterns = materialised(counted, "patterns")
    sizes = patterns.select(F.explode("held").alias("source"), "words").groupBy("source").agg(F.sum("words").alias("size"))
    weighed = materialised(weights(sizes).withColumn("source_key", _source_key("source")), "sources")
    total = patterns.where(F.size("held") > 0).agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    aimed = with_targets(weighed, total).select("source_key", F.col("size").alias("source_size"), "target")
    single = patterns.select("pattern", "words", "rows", F.posexplode("held").alias("n", "source"))
    listed = attach(single.withColumn("source_key", _source_key("source")), aimed, "source_key")
    listed = listed.groupBy("pattern", "words", "rows").agg(
        F.sort_array(F.collect_list(F.struct("n", "source", "source_size", "target", "source_key"))).alias("of")
    )
    known = materialised(
        listed.select(
            "pattern", "words", "rows", F.col("of.source_key").alias("keys"),
            F.transform("of", lambda s: F.rint(s["target"]).cast("long")).alias("quotas"),
            F.transform("of", lambda s: F.struct(s["source"].alias("source"), s["source_size"].alias("source_size"),
                                                 s["target"].alias("target"))).alias("sources"),
        ),
        "aims",
    )
    # Documents without a source are patterns without a goal.
    planned = known.join(_goals(known), "pattern").unionByName(
        patterns.where(F.size("held") == 0).select("pattern", "words", "rows"), allowMissingColumns=True
    )
    goal = F.coalesce("goal", F.lit(0)).cast("long")
    plan = materialised(
        planned.select(
            "pattern", goal.alias("goal"),
            F.when(F.col("words") > 0, F.floor(goal / F.col("words"))).otherwise(0).cast("int").alias("copies"),
            F.when(F.col("words") > 0, F.pmod(goal, "words")).otherwise(0).cast("long").alias("rest"),
            F.least(F.greatest(F.floor(F.col("rows") / BUCKET_ROWS), F.lit(1)), F.lit(MAX_BUCKETS)).cast("int").alias("buckets"),
            F.coalesce("sources", F.array().cast("array<struct<source:string,source_size:bigint,target:double>>")).alias("sources"),
        ),
        "plan",
    )
    per_pattern = _PerPattern(narrow, plan)
    return Mix(plan, *_once_more(narrow, plan, per_pattern), per_pattern)


def _bucketed(df: DataFrame, plan: DataFrame, per_pattern: _PerPattern) -> DataFrame:
    return per_pattern(df, plan).withColumn("bucket", F.pmod("key", F.col("buckets").cast("long")))


def _once_more(narrow: DataFrame, plan: DataFrame, per_pattern: _PerPattern) -> tuple[DataFrame, DataFrame]:
    """Which rows are used once more: ``taken`` (pattern, low, high, most), all rows up to the size
    ``most`` in the buckets from ``low`` to before ``high``, and the ``chosen`` rows beyond.

    A round takes a prefix of the rows that fit at all and fills the gap behind it. Where a very long
    document at the edge leaves more than ``GAP`` open, a further round goes on with the rows that still fit.
    """
    wanted = plan.where("rest > 0").select("pattern", "buckets")
    rows = _bucketed(narrow.select("pattern", "size", "key"), wanted, per_pattern).withColumn("chosen", F.xxhash64("pattern", "key"))
    left = plan.where("rest > 0").select("pattern", F.lit(0).cast("long").alias("low"), F.col("rest").alias("most"))
    taken, chosen = [], []
    for _ in range(ROUNDS):
        able = per_pattern(rows, left).where("size > 0 and size <= most and bucket >= low")
        if chosen:
            able = able.join(reduce(DataFrame.union, chosen), "chosen", "left_anti")
        prefix, found = _round(able, per_pattern)
        taken.append(prefix.select("pattern", "low", "high", "most"))
        chosen.append(found.select("chosen").distinct())
        filled = found.groupBy("pattern").agg(F.sum("words").alias("filled"))
        left = (
            prefix.join(filled, "pattern", "left")
            .withColumn("gap", F.col("most") - F.col("held") - F.coalesce("filled", F.lit(0)))
            .join(plan.select("pattern", "goal"), "pattern")
            .where(F.col("gap") > GAP * F.col("goal"))
            .select("pattern", F.col("high").alias("low"), F.col("gap").alias("most"))
        )
        left = materialised(left, "left")
        if left.isEmpty():
            break
    return reduce(DataFrame.union, taken), reduce(DataFrame.union, chosen).withColumn("is_chosen", F.lit(True))


def _round(able: DataFrame, per_pattern: _PerPattern) -> tuple[DataFrame, DataFrame]:
    """Per pattern its prefix (low, high, most, held), and the units (pattern, chosen, words) that fill the gap."""
    inside = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket: a pattern has at most MAX_BUCKETS.
    sums = (
        able.groupBy("pattern", "bucket", "low", "most")
        .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("count"))
        .withColumn("before", F.coalesce(F.sum("words").over(inside), F.lit(0)))
        .withColumn("rows_before", F.coalesce(F.sum("count").over(inside), F.lit(0)))
    )
    sums = materialised(sums, "buckets")
    over = F.col("before") + F.col("words") > F.col("most")
    at = F.struct("bucket", "before", "rows_before", "count")
    edges = sums.groupBy("pattern", "low", "most").agg(
        F.min(F.when(over, at)).alias("edge"), F.max("bucket").alias("last"),
        F.sum("words").alias("words"),
    )
    # Without an edge all of it fits.
    edges = edges.select(
        "pattern", "low", "most", "edge",
        F.coalesce("edge.bucket", F.col("last") + 1).alias("high"), F.coalesce("edge.before", "words").alias("held"),
    )
    reach = F.col("edge.rows_before") + F.col("edge.count") + FILL_ROWS
    until = (
        per_pattern(sums.select("pattern", "bucket", "rows_before"), edges.select("pattern", "edge"))
        .where(F.col("rows_before") <= reach).groupBy("pattern").agg(F.max("bucket").alias("until"))
    )
    edges = materialised(edges.join(until, "pattern", "left").drop("edge"), "edges")
    near = per_pattern(able, edges.select("pattern", "high", "held", "until"))
    # Equal rows are one unit.
    units = near.where("bucket between high and until").groupBy("pattern", "bucket", "chosen", "most", "held").agg(
        F.sum("size").alias("words")
    )
    along = Window.partitionBy("pattern").orderBy("bucket", "chosen")
    units = units.select(
        "pattern", "chosen", "words", (F.col("most") - F.col("held")).alias("gap"),
        F.sum("words").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("sum"),
        F.row_number().over(along).alias("n"),
    )
    units = materialised(units, "units")
    fits = F.col("sum") <= F.col("gap")
    edge = units.groupBy("pattern").agg(F.coalesce(F.max(F.when(fits, F.col("n"))), F.lit(0)).alias("edge"))
    units = per_pattern(units, edge)
    surely = F.col("n") <= F.col("edge") - FILL_ROWS
    # Around the edge FILL_ROWS units to either side are gathered: the longest first, each if it still fits.
    start = units.where(surely).groupBy("pattern").agg(F.max("sum").alias("start"))
    fill = (
        units.where(~surely & (F.col("n") <= F.col("edge") + FILL_ROWS))
        .groupBy("pattern", "gap")
        .agg(F.sort_array(F.collect_list(F.struct("words", "chosen")), asc=False).alias("units"))
        .join(start, "pattern", "left")
        .withColumn("gap", F.col("gap") - F.coalesce("start", F.lit(0)))
    )
    fitted = F.aggregate(
        "units",
        F.struct(F.col("gap").alias("gap"), F.array().cast("array<struct<words:bigint,chosen:bigint>>").alias("units")),
        lambda a, u: F.when(
            u["words"] <= a["gap"],
            F.struct((a["gap"] - u["words"]).alias("gap"), F.concat(a["units"], F.array(u)).alias("units")),
        ).otherwise(a),
    )
    found = units.where(surely).select("pattern", "chosen", "words").union(
        fill.select("pattern", F.explode(fitted["units"]).alias("u")).select("pattern", "u.chosen", "u.words")
    )
    return edges, materialised(found, "chosen")


def _with_copies(keyed: DataFrame, mix: Mix) -> DataFrame:
    """``keyed`` with ``copies``, how often each row is taken."""
    # One range per round.
    taken = mix.taken.groupBy("pattern").agg(F.collect_list(F.struct("low", "high", "most")).alias("taken"))
    plan = materialised(mix.plan.join(taken, "pattern", "left"), "taken")
    rows = _bucketed(keyed, plan, mix.per_pattern).withColumn("chosen", F.xxhash64("pattern", "key"))
    rows = attach(rows, mix.chosen, "chosen", reduced=True)  # a key is one row but for repeated rows
    once = F.exists(
        "taken", lambda t: (F.col("bucket") >= t["low"]) & (F.col("bucket") < t["high"]) & (F.col("size") <= t["most"])
    )
    once = (F.col("size") > 0) & (F.coalesce(once, F.lit(False)) | F.coalesce(F.col("is_chosen"), F.lit(False)))
    return rows.withColumn("copies", F.col("copies") + once.cast("int"))


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Weights = cycled_weights,
    seed: int = SEED,
) -> DataFrame:
    """Per document doc_id, size, copies, taken, and ``sources`` with the words and target of each."""
    narrow = materialised(_keyed(docs, doc_id, text, source, seed).drop("row"), "sizes")
    return _with_copies(narrow, decide(narrow, weights)).select(
        "doc_id", "size", "copies", (F.col("size") * F.col("copies")).alias("taken"), "sources"
    )


def expanded(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Weights = cycled_weights,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, as often as it takes them, with all their columns."""
    keyed = _keyed(docs, doc_id, text, source, seed)
    mix = decide(materialised(keyed.select("held", "pattern", "size", "key"), "sizes"), weights)
    rows = _with_copies(keyed.drop("held"), mix).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
