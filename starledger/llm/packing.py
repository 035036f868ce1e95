"""Best-fit packing of documents into sequences, planned on the histogram of lengths.

Documents become pieces of at most ``capacity`` tokens. The driver sees how many pieces have each length,
``capacity`` numbers at most, and packs these counts best-fit decreasing: the longest
lengths first, each into the open sequences with the least room that still holds it. Sequences that are
in the same state are handled together, so the plan is a short list of runs: the next so many pieces of a
length go into consecutive sequences, so many in each. Pieces are ranked within their length by one range
shuffle of narrow rows and join the runs on length and rank.

Token ids are those that ``tokenizers`` gives with its defaults for the byte-level BPE vocabulary file named by the
caller, so the name of an added token in a text becomes that token. ``tiktoken`` computes them
from that file's own vocabulary; texts that name an added token or have very long runs of white space go to
``tokenizers``. Both give the same ids.

Defined cases: a null text is an empty one, and an empty text is the end mark alone; repeated rows are packed
one by one; a null id is carried along; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from starledger.operators.keys import number_rows
from starledger.session import materialised

CAPACITY = 2048
END = 0
# Fixed value: how byte-level BPE vocabularies of this kind cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The fast encoder's pattern goes back over white space character by character, on a stack of bounded depth.
_LONG_BLANK = re.compile(r"\s{2000}")


def _byte_of_character() -> dict[str, int]:
    """How the vocabulary writes bytes: printable ones as themselves, the others from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Encoder:
    """Ids of texts by the vocabulary in a ``tokenizers`` file."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        self._added = [t["content"] for t in held.get("added_tokens", [])]
        of = _byte_of_character()
        ranks = {
            bytes(of[c] for c in token): n for token, n in held["model"]["vocab"].items() if token not in self._added
        }
        self._fast = tiktoken.Encoding("vocabulary", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self._plain = Tokenizer.from_file(path)

    def ids(self, text: str) -> np.ndarray:
        if any(name in text for name in self._added) or _LONG_BLANK.search(text):
            return np.array(self._plain.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(self._fast.encode_ordinary(text), dtype="<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces: all full but the first, which takes what is over."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    starts = [0, *range(first, length, capacity)] if first else list(range(0, length, capacity))
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length])]


def pieces(docs: DataFrame, doc_id: str, text: str, tokenizer: str, capacity: int, tokens: bool) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    id_type = docs.select(F.col(f"`{doc_id}`").alias("doc_id")).schema["doc_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, piece int, start long, length int, ids_crc32 long"
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if tokens:
        schema, names = schema + ", ids array<int>", [*names, "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        for batch in batches:
            rows, numbers, starts, lengths, sums, parts = [], [], [], [], [], []
            for row, body in enumerate(batch.column(1)):
                found = np.append(encode(body.as_py() or ""), np.uint32(END)).astype("<u4")
                for number, (start, length) in enumerate(cut(len(found), capacity)):
                    part = found[start : start + length]
                    rows.append(row)
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(part.tobytes()))
                    if tokens:
                        parts.append(part.astype(np.int32))
            columns = [
                pc.take(batch.column(0), pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                pa.array(starts, pa.int64()), pa.array(lengths, pa.int32()), pa.array(sums, pa.int64()),
            ]
            if tokens:
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, pieces per sequence, first sequence, offset), best-fit decreasing.

    A sequence that takes one piece of a length and has room for another is the tightest fit for
    that, so it takes as many as fit before the next one does.
    """
    open_: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, sequences)
    runs, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = min((r for r, held in open_.items() if r >= length and held), default=None)
            if room is None:
                room = capacity
                first, count = sequences, -(-left // (capacity // length))
                sequences += count
            else:
                first, count = open_[room].pop()
            each = room // length
            whole = min(count, left // each)
            used = [(whole, each)] if whole else []
            if whole < count and 0 < left - whole * each < each:
                used.append((1, left - whole * each))
            for number, per in used:
                runs.append((length, rank, number * per, per, first, capacity - room))
                open_.setdefault(room - per * length, []).append((first, number))
                rank, left = rank + number * per, left - number * per
                first, count = first + number, count - number
            if count:
                open_.setdefault(room, []).append((first, count))
    return runs


def packed(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    tokens: bool = False,
) -> DataFrame:
    """Per piece its document, place in the document, checksum of ids, sequence and offset there.

    With ``tokens`` the ids themselves are a further column, see ``sequences``.
    """
    # Written first: ranking samples its input, and texts should be tokenized once.
    cut_up = materialised(pieces(docs, doc_id, text, tokenizer, capacity, tokens), "pieces")
    numbered = number_rows(cut_up, ["length"], "_rank")
    counts = numbered.groupBy("length").agg(F.count(F.lit(1)).alias("pieces"))
    histogram = {r["length"]: r["pieces"] for r in counts.collect()}  # at most ``capacity`` rows
    before, total = {}, 0
    for length in sorted(histogram):
        before[length], total = total, total + histogram[length]
    runs = [
        (length, before[length] + rank, before[length] + rank + number, per, first, offset)
        for length, rank, number, per, first, offset in plan(histogram, capacity)
    ]
    # The plan depends on the lengths that occur, not on how many documents have them.
    runs = docs.sparkSession.createDataFrame(
        runs, "length int, from_rank long, to_rank long, per int, first long, at int"
    )
    rank = F.col("_rank") - 1
    joined = numbered.join(F.broadcast(runs), "length").where((rank >= F.col("from_rank")) & (rank < F.col("to_rank")))
    item = rank - F.col("from_rank")
    return joined.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("first") + F.floor(item / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(item, F.col("per")) * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if tokens else []),
    )


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of ``packed(..., tokens=True)``; a sequence holds ``capacity`` ids at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )
