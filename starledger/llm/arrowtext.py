"""Texts of an Arrow batch as bytes, and their words as 64-bit hashes, without a Python loop over words.

A word's hash is a sum of random numbers per byte times powers of one odd base, modulo 2**64, so
prefix sums give all words of a piece at once and a word that crosses two pieces can be put
together. Memory per step is bounded by the piece; what is kept is a few numbers per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

PIECE = 1 << 18
#: Texts are taken together up to this many bytes; a longer text goes alone.
SLICE = 1 << 20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTES = np.arange(256, dtype=np.uint8)
#: Byte tables: what belongs to a word, and what it counts as.
WORD_BYTES = ~_SPACES
LINE_BYTES = _BYTES != 0x0A
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    out = np.full(PIECE, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_RANDOM = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def hash_runs(
    data: np.ndarray, offsets: np.ndarray, member: np.ndarray, fold: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each maximal run of ``member`` bytes inside one text.

    ``offsets`` are the borders of the texts in ``data``; ``fold`` maps bytes before hashing.
    """
    values = _RANDOM if fold is None else _RANDOM[fold]
    starts, ends, hashes = [], [], []
    inner = offsets[1:-1]
    was_in = False
    for a in range(0, len(data), PIECE):
        piece = data[a : a + PIECE]
        inside = member[piece]
        fresh = np.empty(len(piece), dtype=bool)
        fresh[0] = not was_in
        np.logical_not(inside[:-1], out=fresh[1:])
        borders = inner[np.searchsorted(inner, a) : np.searchsorted(inner, a + len(piece))] - a
        fresh[borders] = True
        first = np.flatnonzero(inside & fresh)
        carried = bool(inside[0]) and not fresh[0]
        if carried:
            first = np.concatenate([[0], first])
        # A run ends where the next byte is outside or starts a run of its own.
        stop = np.empty(len(piece), dtype=bool)
        stop[:-1] = ~inside[1:] | fresh[1:]
        stop[-1] = True
        last = np.flatnonzero(inside & stop) + 1
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(values[piece] * _UP[: len(piece)], out=sums[1:])
        found = (sums[last] - sums[first]) * _DOWN[first] if len(first) else np.zeros(0, np.uint64)
        first, last = first + a, last + a
        if carried:
            before = int(ends[-1][-1] - starts[-1][-1])
            joined = (int(hashes[-1][-1]) + pow(_BASE, before, 1 << 64) * int(found[0])) & _MASK
            hashes[-1][-1], ends[-1][-1] = joined, last[0]
            first, last, found = first[1:], last[1:], found[1:]
        if len(first):
            starts.append(first)
            ends.append(last)
            hashes.append(found)
        was_in = bool(inside[-1])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start, end, found = (np.concatenate(x) for x in (starts, ends, hashes))
    return start, end, _finished(found, end - start)


def _finished(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hash_heads(data: np.ndarray, starts: np.ndarray, width: int, fold: np.ndarray | None = None) -> np.ndarray:
    """Hash of the first ``width`` bytes of runs that are at least so long, equal to that of a run of these bytes."""
    values = _RANDOM if fold is None else _RANDOM[fold]
    total = np.zeros(len(starts), dtype=np.uint64)
    for k in range(width):
        total += values[data[starts + k]] * _UP[k]
    return _finished(total, np.full(len(starts), width))


def owners(offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The index of the text that holds each start."""
    return np.searchsorted(offsets, starts, side="right") - 1


def windows(hashes: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``width`` consecutive words of one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        total += hashes[k : k + n] * np.uint64(pow(_BASE, k + 1, 1 << 64))
    first = np.flatnonzero(owner[:n] == owner[width - 1 :])
    return first, mix(total[first])


def slices(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, bytes and borders of consecutive texts, up to ``limit`` bytes; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    raw = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(raw, raw[at] + limit, side="right")) - 1)
        yield at, to, data[raw[at] : raw[to]], raw[at : to + 1] - raw[at]
        at = to


def with_text_columns(
    df: DataFrame,
    text: str,
    kernel: Callable[[pa.Array], dict[str, pa.Array]],
    columns: dict[str, str],
    keep: str = "row",
) -> DataFrame:
    """``df`` as a struct column ``keep``, and next to it the ``columns`` that ``kernel`` finds in ``text``.

    The struct keeps the names of the table and of the results apart, whatever they are.
    """
    names = list(columns)
    row_type = df.schema
    schema = T.StructType([T.StructField(keep, row_type)]).jsonValue()
    out = T.StructType.fromJson(schema)
    for name, kind in columns.items():
        out = out.add(name, T._parse_datatype_string(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = kernel(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[found[n] for n in names]], names=[keep, *names]
            )

    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(keep), F.col(f"`{text}`").alias("text"))
    return packed.mapInArrow(run, out)
