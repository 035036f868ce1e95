"""Words that differ by one edit, found by probing generated edits against Bloom filters.

The vocabulary is held in blocked Bloom filters, one per word length (a *shard*; long lengths share one), sized
by its number of words. Every word's edits are generated as hashes, in numpy: a character replaced by a later one, or
deleted. The other edits are the same pairs seen from the other word. An edit is looked up in the shard of its length only, in one
block of 512 bits; what the filters let through, a few hashes a word, is shuffled to an exact join with the
vocabulary's hashes, and the pairs that are left are compared by their texts. So false positives of the filters
and collisions of the hashes are both removed, and no pair is lost.

What the tasks are sent is bounded: filters larger than ``FILTER_BYTES`` are split by hash into slices, and the
edits are probed slice after slice, each edit in the one slice it belongs to.

A word's *form* is its commonest near word, if that is at least twice as common; forms are followed by pointer
doubling, in rounds up to the logarithm of the logarithm of the largest count.

Defined cases: null and empty texts have no words; a null id is an empty one in what is hashed; repeated rows count again; an empty table,
or one without words that are long and common enough, gives an empty result; further columns are ignored. Words
of any length are handled: edits are generated for some positions at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from starledger.llm.arrowtext import mix
from starledger.operators.keys import number_rows
from starledger.operators.skew import attach
from starledger.session import materialised

#: Runs of these are words; all have one byte in Latin-1.
LETTERS = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A form is at least so many times as common as its word.
RATIO = 2
#: One of so many occurrences loses a character.
DAMAGE = 97
#: Words of this length and longer share a shard.
LONGEST = 64
#: A block is so many 64-bit numbers; bits per word and bits set per word.
BLOCK = 8
BITS = 16
PROBES = 6
#: Bytes of filters that tasks are sent at a time, and of filter that one task builds.
FILTER_BYTES = 64 << 20
CHUNK_BYTES = 64 << 10
#: Edits generated at a time.
EDITS = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_UNBASE = np.uint64(pow(_BASE, -1, 1 << 64))
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of the texts, one occurrence in ``DAMAGE`` without one of its characters, that are long and common enough.

    Counted with partial sums before the shuffle.
    """
    lower = F.translate(F.col(f"`{text}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    identity = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    runs = docs.select(identity.alias("id"), F.explode(F.regexp_extract_all(lower, F.lit(LETTERS), 0)).alias("run"))
    summed = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    # Also what is too short by now is left out before the shuffle.
    at = F.pmod(summed, F.length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = runs.select(F.when(summed % DAMAGE == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _powers(length: int) -> np.ndarray:
    out = np.full(length, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of each row of a matrix of characters: values times powers of a base, modulo 2**64; rows of a length only."""
    return (_VALUES[words] * _powers(words.shape[1])).sum(axis=1, dtype=np.uint64)


def edits(words: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Hashes of the words with one character deleted, and replaced by a later one of the alphabet.

    Yields the length of the edits, the row each belongs to and its hash, for some positions at a time. ``words`` have
    one length.
    """
    rows, length = words.shape
    powers = _powers(length)
    parts = _VALUES[words] * powers
    whole = parts.sum(axis=1, dtype=np.uint64)
    # Deleting shifts what follows by one place. Of equal neighbours the last is deleted.
    after = whole[:, None] - np.cumsum(parts, axis=1, dtype=np.uint64)
    before = whole[:, None] - after - parts
    differs = np.ones(words.shape, dtype=bool)
    differs[:, :-1] = words[:, :-1] != words[:, 1:]
    row, at = np.nonzero(differs)
    yield length - 1, row, before[row, at] + after[row, at] * _UNBASE
    values = _VALUES[alphabet]
    step = max(1, EDITS // (rows * len(alphabet)))
    for first in range(0, length, step):
        some = words[:, first : first + step]
        row, at, to = np.nonzero(some[:, :, None] < alphabet)
        at += first
        yield length, row, whole[row] - parts[row, at] + values[to] * powers[at]


class Layout:
    """Where each shard's blocks lie, one after the other; a shard has blocks in proportion to its words."""

    def __init__(self, words_by_shard: dict[int, int]):
        self.starts = np.zeros(LONGEST + 1, dtype=np.uint64)
        self.blocks = np.zeros(LONGEST + 1, dtype=np.uint64)
        self.total = 0
        for shard, words in sorted(words_by_shard.items()):
            self.starts[shard], self.blocks[shard] = self.total, -(-words * BITS // (64 * BLOCK))
            self.total += int(self.blocks[shard])

    def block(self, length: int, hashes: np.ndarray) -> np.ndarray:
        shard = min(length, LONGEST)
        return self.starts[shard] + ((mix(hashes) >> np.uint64(32)) * self.blocks[shard] >> np.uint64(32))

    def holds(self, length: int) -> bool:
        return length >= 0 and bool(self.blocks[min(length, LONGEST)])


def _places(hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number in the block and bit in the number, ``PROBES`` times."""
    bits = mix(hashes ^ np.uint64(_BASE))
    for k in range(PROBES):
        place = (bits >> np.uint64(9 * k)) & np.uint64(64 * BLOCK - 1)
        yield place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63))


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of characters of the words of each length."""
    texts = np.array(words.to_pylist(), dtype=object)
    lengths = np.array([len(w) for w in texts], dtype=np.int64)
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        # Long words a few at a time.
        some = max(1, EDITS // max(1, length))
        for at in range(0, len(rows), some):
            part = rows[at : at + some]
            body = "".join(texts[part]).encode("latin-1")
            yield part, np.frombuffer(body, dtype=np.uint8).reshape(len(part), length)


def hashed(words: DataFrame) -> DataFrame:
    """(number, word, n) with ``hash``."""
    names = ["number", "word", "n", "hash"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, dtype=np.uint64)
            for rows, matrix in _by_length(batch.column("word")):
                found[rows] = word_hashes(matrix)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=names)

    return words.select(names[:3]).mapInArrow(run, "number long, word string, n long, hash long")


def filters(words: DataFrame, layout: Layout) -> DataFrame:
    """(chunk, bits): the filters of all words in chunks, each built by one task from the words that fall into it."""
    chunk_blocks = CHUNK_BYTES // (8 * BLOCK)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy().view(np.uint64)
            lengths = batch.column("length").to_numpy()
            blocks = np.zeros(len(hashes), dtype=np.uint64)
            for length in np.unique(lengths).tolist():
                rows = lengths == length
                blocks[rows] = layout.block(length, hashes[rows])
            blocks = blocks.astype(np.int64)
            arrays = [pa.array(blocks // chunk_blocks), pa.array(blocks % chunk_blocks), batch.column("hash")]
            yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "block", "hash"])

    def build(group: pa.Table) -> pa.Table:
        bits = np.zeros((chunk_blocks, BLOCK), dtype=np.uint64)
        blocks = group.column("block").to_numpy()
        for number, bit in _places(group.column("hash").to_numpy().view(np.uint64)):
            np.bitwise_or.at(bits, (blocks, number.astype(np.int64)), bit)
        return pa.table({"chunk": group.column("chunk").slice(0, 1), "bits": pa.array([bits.tobytes()])})

    placed = words.select("hash", F.length("word").alias("length")).mapInArrow(place, "chunk long, block long, hash long")
    return placed.groupBy("chunk").applyInArrow(build, "chunk long, bits binary")


def probed(words: DataFrame, layout: Layout, alphabet: np.ndarray, sent: Broadcast, first: int) -> DataFrame:
    """(number, hash): edits of the words that the filters from block ``first`` on let through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        last = first + len(held) // BLOCK
        for batch in batches:
            numbers = batch.column("number").to_numpy()
            for rows, matrix in _by_length(batch.column("word")):
                for length, row, hashes in edits(matrix, alphabet):
                    if not layout.holds(length):
                        continue
                    block = layout.block(length, hashes).astype(np.int64)
                    if first or last < layout.total:
                        inside = np.flatnonzero((block >= first) & (block < last))
                        block, row, hashes = block[inside], row[inside], hashes[inside]
                    at = (block - first) * BLOCK
                    left = np.arange(len(hashes))
                    # Most edits fall at the first bits that are looked at.
                    for number, bit in _places(hashes):
                        left = left[held[at[left] + number[left].astype(np.int64)] & bit[left] != 0]
                    if len(left):
                        arrays = [pa.array(numbers[rows[row[left]]]), pa.array(hashes[left].view(np.int64))]
                        yield pa.RecordBatch.from_arrays(arrays, names=["number", "hash"])

    return words.select("number", "word").mapInArrow(run, "number long, hash long")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): numbers of words that differ by one edit, each pair once. ``words`` is a written (number, word, n, hash)."""
    spark = words.sparkSession
    shard = F.least(F.length("word"), F.lit(LONGEST)).alias("shard")
    # One row per length, and one per character.
    layout = Layout({r["shard"]: r["count"] for r in words.groupBy(shard).count().collect()})
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct().collect()
    alphabet = np.array(sorted(ord(r["letter"]) for r in letters if r["letter"]), dtype=np.uint8)
    chunks = materialised(filters(words, layout), "filters")
    chunk_blocks = CHUNK_BYTES // (8 * BLOCK)
    per_slice = max(1, FILTER_BYTES // CHUNK_BYTES)
    found = []
    for low in range(0, -(-layout.total // chunk_blocks), per_slice):
        # At most FILTER_BYTES come to the driver and are sent to the tasks.
        held = chunks.where((F.col("chunk") >= low) & (F.col("chunk") < low + per_slice)).toArrow()
        size = min(layout.total - low * chunk_blocks, per_slice * chunk_blocks)
        bits = np.zeros(-(-size // chunk_blocks) * chunk_blocks * BLOCK, dtype=np.uint64)
        for number, part in zip(held.column("chunk").to_pylist(), held.column("bits")):
            at = (number - low) * chunk_blocks * BLOCK
            bits[at : at + chunk_blocks * BLOCK] = np.frombuffer(part.as_buffer(), dtype=np.uint64)
        sent = spark.sparkContext.broadcast(bits)
        found.append(materialised(probed(words, layout, alphabet, sent, low * chunk_blocks), "probed"))
        sent.destroy()
    if not found:
        return words.select(F.col("number").alias("a"), F.col("number").alias("b")).limit(0)
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.union(more)
    # Hashes of words are all but unique, and a word has no more edits than its length and the alphabet allow.
    others = words.select("hash", F.col("number").alias("b"), F.col("word").alias("other"))
    met = candidates.join(others, "hash").select(F.col("number").alias("a"), "b", "other")
    own = words.select(F.col("number").alias("a"), "word")
    return met.join(own, "a").where(F.levenshtein("word", "other", 1) == 1).select("a", "b").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(number, root): where following (number, form) ends, by pointer doubling."""
    here = materialised(forms.select("number", F.col("form").alias("root")), "roots")
    while True:
        onward = here.select(F.col("number").alias("root"), F.col("root").alias("_onward"))
        # The commonest words end the ways of many others.
        moved = materialised(
            attach(here, onward, "root").select("number", F.coalesce("_onward", "root").alias("root"),
                                                F.col("_onward").isNotNull().alias("moved")),
            "roots",
        )
        here = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return here


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per word its form, root, n, n_near and form_n."""
    counted = materialised(vocabulary(docs, doc_id, text), "words")
    # Numbers go from the commonest word on, ties by code points, so that a form is the smallest number.
    ordered = number_rows(counted.withColumn("order", -F.col("n")), ["order", "word"], "number").drop("order")
    words = materialised(hashed(ordered.select("number", "word", "n")), "vocabulary")
    pairs = materialised(near_pairs(words), "pairs")
    both = pairs.union(pairs.select("b", "a")).toDF("number", "other")
    near = both.groupBy("number").agg(F.count(F.lit(1)).alias("n_near"), F.min("other").alias("form"))
    own = words.select("number", "word", "n").join(near, "number", "left")
    named = words.select(F.col("number").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    # As a form a word has no more words than it has edits.
    judged = own.join(named, "form", "left").withColumn("is_form", F.coalesce(F.col("form_n") >= RATIO * F.col("n"), F.lit(False)))
    judged = materialised(
        judged.select("number", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                      *[F.when(F.col("is_form"), F.col(c)).alias(c) for c in ("form", "form_word", "form_n")]),
        "judged",
    )
    roots = _roots(judged.where("form IS NOT NULL"))
    ends = roots.join(judged.select(F.col("number").alias("root"), F.col("word").alias("root_word")), "root", "left")
    with_root = judged.join(ends.select("number", "root_word"), "number", "left")
    return with_root.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
