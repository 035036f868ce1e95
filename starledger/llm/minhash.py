"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and union-find.

A document is the set of its distinct word shingles. Equal sets are one *class* (their
fingerprint is taken over the whole set), and everything after the first pass works on classes, so
a text that is copied a million times is one row there.

SuperMinHash gives element ``i`` a random permutation of the signature positions and writes
``rank + uniform`` into them; the smallest value per position is the signature. All elements take
step ``rank`` together here, and a document stops as soon as no later step can lower
any of its positions, which for a long text is after one or two.

Bands of ``ROWS`` positions make buckets; the number of bands follows from the similarity asked for,
so that a pair at the limit is missed with a probability below ``MISS``. Inside a bucket members are not
paired with each other: all are compared with one *leader*, the member that shares most buckets with
most others (in a group of near copies that is the text they were copied from). A bucket is looked at again
only while it holds different components, and only those of its texts that share enough shingles
with any other one left to be linked at all. What is left is compared inside tasks, block by block and across
components only; a task reports one link per text and component. So no link that could join two
components goes untested, pairs are never listed, and every link is confirmed on the full sets.

Defined cases: null and empty texts have no shingles and are linked with nothing; a text of fewer
words than a shingle is one shingle; repeated rows and equal texts share a component whatever their
ids; a null id is never the name of a component unless all its ids are null; an empty table gives
an empty result; further columns are ignored by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starledger.llm.arrowtext import LOWER, WORD_BYTES, hash_runs, mix, owners, slices, windows, with_text_columns
from starledger.llm.bloom import key_filter, passes, thinned
from starledger.llm.components import attach_weighed, components, spread_join
from starledger.session import materialised

ROWS = 5
MISS = 1e-6
#: Shingles of the sets that a task compares with as many others, and what a set counts besides its shingles.
BLOCK_SHINGLES = 400_000
MEMBER_WEIGHT = 64
#: Elements that take their steps together; bounds the permutations held at once.
BLOCK = 1 << 16
_FRACTION = 24
_STEP = 0x9E3779B97F4A7C15


def bands_for(percent: int) -> int:
    """Bands that miss a pair of this similarity with a probability of at most ``MISS``."""
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** ROWS)))


def shingle_sets(data, offsets, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of the distinct shingles of each text, ordered by both."""
    starts, _, hashes = hash_runs(data, offsets, WORD_BYTES, LOWER)
    owner = owners(offsets, starts)
    first, found = windows(hashes, owner, width)
    held = owner[first]
    words = np.bincount(owner, minlength=len(offsets) - 1)
    short = np.flatnonzero((words > 0) & (words < width))
    if len(short):
        begin = np.searchsorted(owner, short)
        whole = []
        for a, n in zip(begin, words[short]):
            part = hashes[a : a + n] * (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
            whole.append(part.sum(dtype=np.uint64) + np.uint64(n))
        held = np.concatenate([held, short])
        found = np.concatenate([found, mix(mix(np.array(whole, dtype=np.uint64)))])
    order = np.lexsort((found, held))
    held, found = held[order], found[order]
    new = np.ones(len(held), dtype=bool)
    new[1:] = (held[1:] != held[:-1]) | (found[1:] != found[:-1])
    return held[new], found[new]


def signatures(owner: np.ndarray, elements: np.ndarray, n: int, size: int) -> np.ndarray:
    """SuperMinHash signatures, ``n`` rows of ``size`` numbers (rank in the high bits)."""
    best = np.full(n * size, np.iinfo(np.int32).max, dtype=np.int32)
    table = best.reshape(n, size)

    def draw(x, step):
        x = mix(x + np.uint64(_STEP * (step + 1) % (1 << 64)))
        value = ((x >> np.uint64(64 - _FRACTION)).astype(np.int32)) | np.int32(step << _FRACTION)
        place = ((x & np.uint64(0xFFFFFFFF)) * np.uint64(size - step)) >> np.uint64(32)
        return value, place.astype(np.int64) + step

    for at in range(0, len(elements), BLOCK):
        x, own = elements[at : at + BLOCK], owner[at : at + BLOCK]
        value, place = draw(x, 0)
        np.minimum.at(best, own * size + place, value)
        order, swapped = None, place
        for step in range(1, size):
            held = np.arange(own[0], own[-1] + 1)
            open_ = table[held].max(axis=1) >= (step << _FRACTION)
            active = np.flatnonzero(open_[own - own[0]])
            if not len(active):
                break
            x, own = x[active], own[active]
            rows = np.arange(len(active))
            if order is None:
                order = np.tile(np.arange(size, dtype=np.uint8), (len(active), 1))
                first = swapped[active]
                order[rows, first] = 0
                order[:, 0] = first
            elif len(active) < len(order):
                order = order[active]
            value, place = draw(x, step)
            chosen = order[rows, place]
            order[rows, place] = order[:, step]
            order[:, step] = chosen
            np.minimum.at(best, own * size + chosen, value)
    return table


def _fixed_bytes(values: np.ndarray, width: int) -> pa.Array:
    n = values.nbytes // width
    ends = pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(width))
    return pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(np.ascontiguousarray(values))])


def _classes(owner: np.ndarray, elements: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Set sizes and 128-bit fingerprints of the sets."""
    count = np.bincount(owner, minlength=n)
    print_ = np.zeros((n, 2), dtype=np.uint64)
    full = np.flatnonzero(count)
    if len(full):
        begin = np.concatenate([[0], np.cumsum(count[full])[:-1]])
        for k, salt in enumerate((0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)):
            print_[full, k] = np.add.reduceat(mix(elements ^ np.uint64(salt)), begin)
    return count.astype(np.int64), print_


def _signature_kernel(width: int, size: int):
    def kernel(texts: pa.Array) -> dict[str, pa.Array]:
        sizes, names, prints = [np.zeros(0, np.int64)], [np.zeros((0, 2), np.uint64)], [np.zeros((0, size), np.int32)]
        for at, to, data, offsets in slices(texts):
            owner, elements = shingle_sets(data, offsets, width)
            count, name = _classes(owner, elements, to - at)
            sizes.append(count)
            names.append(name)
            prints.append(signatures(owner, elements, to - at, size))
        return {
            "n_shingles": pa.array(np.concatenate(sizes)),
            "cls": _fixed_bytes(np.concatenate(names), 16),
            "signature": _fixed_bytes(np.concatenate(prints), 4 * size),
        }

    return kernel


def _set_kernel(width: int):
    def kernel(texts: pa.Array) -> dict[str, pa.Array]:
        sizes, names, sets = [np.zeros(0, np.int64)], [np.zeros((0, 2), np.uint64)], [np.zeros(0, np.uint64)]
        for at, to, data, offsets in slices(texts):
            owner, elements = shingle_sets(data, offsets, width)
            count, name = _classes(owner, elements, to - at)
            sizes.append(count)
            names.append(name)
            sets.append(elements)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
        values = np.concatenate(sets).view(np.int64)
        return {
            "cls": _fixed_bytes(np.concatenate(names), 16),
            "elements": pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
        }

    return kernel


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """Per document ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked when the Jaccard similarity of their sets of ``words``-word shingles is
    at least ``percent`` / 100; ``component_id`` is the smallest id reachable through links.
    """
    placed = _placed(_narrow(docs, doc_id, text), words, percent)
    return placed.select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each component, with all its columns.

    It is a row with the smallest id; rows without words all stay.
    """
    placed = _placed(_narrow(docs, doc_id, text), words, percent)
    named = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    kept = placed.where("n_shingles > 0").groupBy("component").agg(F.min(named).alias("one"))
    kept = kept.select(F.col("one.doc_id").alias("_kept_id"), F.col("one.text_hash").alias("_kept_hash"))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{doc_id}`").alias("_id"),
        F.xxhash64(F.col(f"`{text}`")).alias("_hash"),
        F.coalesce(F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("_wordy"),
    )
    same = F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_hash") == F.col("_kept_hash"))
    chosen = keyed.where("_wordy").join(kept, same, "left_semi").dropDuplicates(["_id", "_hash"])
    return chosen.select("row.*").union(keyed.where(~F.col("_wordy")).select("row.*"))


def _narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))


def _placed(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Every document with its component (a class) and the smallest id of the component."""
    size = bands_for(percent) * ROWS
    found = with_text_columns(
        docs.withColumn("text_hash", F.xxhash64("text")), "text", _signature_kernel(words, size),
        {"n_shingles": "long", "cls": "binary", "signature": "binary"},
    )
    rows = materialised(found.select("row.doc_id", "row.text_hash", "n_shingles", "cls", "signature"), "signed")
    classes = materialised(
        rows.where("n_shingles > 0").groupBy("cls").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "text_hash")).alias("one"),
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n"), F.first("signature").alias("signature"),
        ),
        "classes",
    )
    members = _members(classes)
    links = _links(docs, classes, members, words, percent)
    if links is None:
        named = classes.withColumn("component", F.col("cls"))
    else:
        named = classes.join(components(links).withColumnRenamed("node", "cls"), "cls", "left").withColumn(
            "component", F.coalesce("component", "cls")
        )
    named = materialised(named.select("cls", "copies", "doc_id", "component"), "components")
    # A component may hold a large part of the classes.
    smallest = materialised(
        named.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("classes")), "smallest"
    )
    named = materialised(
        attach_weighed(named, smallest, "component", "classes").select("cls", "copies", "component", "component_id"), "named"
    )
    rows = rows.drop("signature")
    without = rows.where("n_shingles = 0").select(
        "cls", "doc_id", "text_hash", "n_shingles", F.lit(None).cast("binary").alias("component"),
        F.col("doc_id").alias("component_id"),
    )
    placed = attach_weighed(rows.where("n_shingles > 0"), named, "cls", "copies")
    return placed.unionByName(without)


def _members(classes: DataFrame) -> DataFrame:
    """(key, cls, n, central): the classes of all buckets with two members or more."""
    width = 4 * ROWS
    bands = F.expr(
        f"transform(sequence(0, cast(octet_length(signature) / {width} as int) - 1), "
        f"b -> xxhash64(substring(signature, b * {width} + 1, {width}), b))"
    )
    keys = classes.select("cls", F.col("n").cast("int").alias("n"), F.explode(bands).alias("key"))
    full = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialised(keys.join(full, "key"), "buckets")
    central = members.groupBy("cls").agg(F.sum("size").alias("central"))
    return materialised(members.drop("size").join(central, "cls").select("key", "cls", "n", "central"), "members")


def _key(doc_id: str, text_hash: str | Column) -> Column:
    return F.xxhash64(doc_id, text_hash)


def _sets(docs: DataFrame, classes: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """(cls, elements) of all classes in ``members``, from the text of one document each.

    The documents are read again and, by a filter of fixed size, mostly passed over where they lie, so no
    text is shuffled. What the filter lets through by chance does no harm: sets are looked up by class.
    """
    one = classes.join(members.select("cls").distinct(), "cls", "left_semi")
    filter_ = key_filter(one, _key("one.doc_id", "one.text_hash"))
    kernel = _set_kernel(words)

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column(0).to_numpy()
            rows = []
            for row in np.flatnonzero(passes(filter_, keys)).tolist():
                if keys[row] not in seen:
                    seen.add(keys[row])
                    rows.append(row)
            found = kernel(batch.column(1).take(pa.array(rows, pa.int64())))
            yield pa.RecordBatch.from_arrays([found["cls"], found["elements"]], ["cls", "elements"])

    keyed = docs.select(_key("doc_id", F.xxhash64("text")).alias("key"), "text")
    return materialised(keyed.mapInArrow(run, "cls binary, elements array<long>"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    pairs = materialised(pairs, "candidates")
    # b is a leader and may have a large part of the pairs; a has few leaders.
    of_b, of_a = (
        thinned(sets, F.xxhash64("cls"), key_filter(pairs, F.xxhash64(side))).toDF(side, f"set_{side}") for side in "ba"
    )
    return (
        spread_join(pairs, of_b, "b").join(of_a, "a")
        .where(100 * common >= percent * union)
        .select("a", "b")
    )


def _links(docs, classes, members, words: int, percent: int) -> DataFrame | None:
    """Confirmed links that connect the same classes as all links do."""
    if members.isEmpty():
        return None
    sets = _sets(docs, classes, members, words)
    leaders = members.groupBy("key").agg(F.max(F.struct("central", "cls", "n")).alias("top")).select(
        "key", F.col("top.cls").alias("b"), F.col("top.n").alias("n_b")
    )
    led = members.join(leaders, "key").where("cls != b")
    near = led.where(100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b"))
    links = materialised(_confirmed(near.select(F.col("cls").alias("a"), "b").distinct(), sets, percent), "links")
    named = led.select("key", "cls", "n").join(components(links).withColumnRenamed("node", "cls"), "cls", "left")
    open_ = _undecided(materialised(named.withColumn("component", F.coalesce("component", "cls")), "led"))
    if open_.isEmpty():
        return links
    open_ = _undecided(materialised(_with_shared(open_, sets, percent), "possible"))
    return links.union(materialised(_compared(open_, sets, percent), "links"))


def _compared(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of a bucket that belong to different components, at least one for each two components.

    A bucket is cut by hash into blocks of about ``BLOCK_SHINGLES``; a task compares two blocks in memory.
    """
    weight = F.col("n") + MEMBER_WEIGHT
    blocks = members.groupBy("key").agg(F.ceil(F.sum(weight) / BLOCK_SHINGLES).cast("int").alias("blocks"))
    dealt = members.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "cls", "component",
    )

    def kernel(table: pa.Table) -> pa.Table:
        return _cross_links(table.combine_chunks(), percent)

    wanted = thinned(sets, F.xxhash64("cls"), key_filter(members, F.xxhash64("cls")))
    sent = dealt.join(wanted, "cls").select("key", "low", "high", "block", "cls", "component", "elements")
    return sent.groupBy("key", "low", "high").applyInArrow(kernel, "a binary, b binary").distinct()


def _cross_links(table: pa.Table, percent: int) -> pa.Table:
    """Links across components within a table of sets; of two blocks, only from the first to the second."""
    n = table.num_rows
    names = table.column("cls").to_pylist()
    _, component = np.unique(np.array(table.column("component").to_pylist(), dtype=object), return_inverse=True)
    block = table.column("block").to_numpy()
    lists = table.column("elements").combine_chunks()
    sizes = np.asarray(lists.value_lengths(), dtype=np.int64)
    _, words = np.unique(np.asarray(lists.flatten()), return_inverse=True)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    holder = np.repeat(np.arange(n), sizes)
    by_word = np.argsort(words, kind="stable")
    held = holder[by_word]
    first = np.concatenate([[0], np.cumsum(np.bincount(words))])
    # The largest component need not be compared with itself.
    outer = np.flatnonzero(component != np.bincount(component).argmax())
    two = block.min() != block.max()
    out_a, out_b = [], []
    for u in outer:
        own = words[begin[u] : begin[u + 1]]
        low, count = first[own], first[own + 1] - first[own]
        at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        common = np.bincount(held[at], minlength=n)
        linked = (100 + percent) * common >= percent * (sizes[u] + sizes)
        linked &= component != component[u]
        if two:
            linked &= block != block[u]
        rows = np.flatnonzero(linked)
        # One link to each component is enough.
        for v in rows[np.unique(component[rows], return_index=True)[1]]:
            out_a.append(names[u])
            out_b.append(names[v])
    return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})


def _with_shared(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``members`` with how many of its shingles any other undecided class has, without those that have too few.

    A shingle of one class only cannot be in an intersection, so a text with many changes of its own
    is out of reach of all others, however large the group of copies around it is.
    """
    tag = F.xxhash64("cls")
    # A set more than wanted only makes shingles look shared.
    wanted = thinned(sets, tag, key_filter(members, tag))
    open_ = wanted.select(tag.alias("tag"), F.explode("elements").alias("e"))
    single = open_.groupBy("e").agg(F.count(F.lit(1)).alias("classes"), F.min("tag").alias("tag")).where("classes = 1")
    single = materialised(single.groupBy("tag").agg(F.count(F.lit(1)).cast("int").alias("alone")), "alone")
    known = members.withColumn("tag", tag).join(single, "tag", "left").drop("tag")
    known = known.withColumn("shared", F.col("n") - F.coalesce("alone", F.lit(0))).drop("alone")
    least = known.groupBy("key").agg(F.min("n").alias("least"))
    enough = (100 + percent) * F.col("shared") >= percent * (F.col("n") + F.col("least"))
    return known.join(least, "key").where(enough).drop("least")


def _undecided(members: DataFrame) -> DataFrame:
    """The members of the buckets that hold more than one component."""
    open_ = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return materialised(members.join(open_.where("low != high").select("key"), "key"), "open")
