"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

In byte-pair encoding a run of tokens is what the encoder gives if, and only if, every two neighbours are
what it gives for their bytes together. So the encoding of a prefix ends with the one token that fits behind the
encoding of the shorter prefix it leaves, and its count is that prefix's count plus one. The programme runs over the
prefixes of a *segment*, a run of white space with the letters, digits or signs behind it, where the
vocabulary's word pattern never looks across; segments that come again are looked up.

``prefix_tables`` stores, per document, by how much the count changes with every code point (one byte each, two
where a change does not fit). ``truncations``, ``counts_at`` and ``within_budget`` answer from the stored tables how much of
a text fits a limit, how many tokens a prefix has, and what a token budget pays for, without encoding again.
A count may fall as a prefix grows, because a longer prefix can end in a longer token.

Counts are those of the ``tokenizers`` library with its defaults: the name of an added token inside a text is
that one token once it is complete, and plain text before. Vocabulary files are byte-level pair encodings without
normalizer or prefix space; others are refused.

Defined cases: a null text is an empty one and has 0 tokens and an empty table; a null id is carried along; repeated rows
are rows of their own; an empty table gives an empty result; further columns, whatever their names, are ignored.
Texts of any length are taken in windows, so only the table of one text is held at a time beside its text.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import sub

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from starledger.operators.keys import number_rows
from starledger.session import materialised

#: Code points of a text that are cut into segments at a time.
WINDOW = 1 << 18
#: Bytes of short texts that are taken together.
PART = 1 << 20
#: Segments and pairs of tokens remembered per Python worker; longer segments are not remembered.
SEGMENTS = 400_000
PAIRS = 1_000_000
SEGMENT_LONGEST = 48
#: Rows whose totals are added up together; one block of them comes to the driver.
BLOCK = 10_000
#: Contractions are words of their own where no blank stands before them.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_SHORT = "|".join(CONTRACTIONS)
_SEGMENT = regex.compile(rf"(?:\s*[^\S\x20])?(?:{_SHORT})|\s*(?:\p{{L}}+|\p{{N}}+|[^\s\p{{L}}\p{{N}}]+)|\s+")
_BLANKS = regex.compile(r"\s*")
_WORD_END = regex.compile(r"\S(?=\s)")
# The same for texts of the first 256 code points, whose classes can be written out; ``re`` is faster then.
_RARE = re.compile(r"[^\x00-\xFF]")
_L, _N, _S = r"A-Za-z\xAA\xB5\xBA\xC0-\xD6\xD8-\xF6\xF8-\xFF", r"0-9\xB2\xB3\xB9\xBC-\xBE", r"\t-\r \x85\xA0"
_SEGMENT_256 = re.compile(
    rf" ?[{_L}]+|(?:[{_S}]*[\t-\r\x85\xA0])?(?:{_SHORT})|[{_S}]*(?:[{_L}]+|[{_N}]+|[^{_S}{_L}{_N}]+)|[{_S}]+"
)
#: Segments of these and ASCII letters behind are one word.
_BEFORE_WORD = frozenset(" abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: What characters of a class share a word with, one to stand in for them, and how ``regex`` tells the class.
_CLASSES = (("a", "ª", r"\p{L}"), ("1", "²", r"\p{N}"), ("!", "§", r"[^\s\p{L}\p{N}]"), (None, " ", r"\s"))


def _byte_of_character() -> dict[str, int]:
    """How the vocabulary writes bytes: printable ones as themselves, the others from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class PrefixCounter:
    """Token counts of all prefixes of texts, by the vocabulary in a ``tokenizers`` file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, before = held["model"], held.get("pre_tokenizer") or {}
        added = held.get("added_tokens") or []
        plain_bytes = (
            model.get("type") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and not held.get("normalizer") and not model.get("ignore_merges")
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        )
        plain_names = not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip"))
        if not (plain_bytes and plain_names):
            raise ValueError(f"{path} is no plain byte-level pair encoding")
        of = _byte_of_character()

        def as_bytes(token: str) -> bytes:
            return bytes(of[c] for c in token)

        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._ranks = {(as_bytes(a), as_bytes(b)): n for n, (a, b) in enumerate(pairs)}
        tokens = {b"", *[bytes([b]) for b in range(256)], *[a + b for a, b in self._ranks]}
        self._numbers = {token: n for n, token in enumerate(sorted(tokens))}
        self._backs = range(2, max(map(len, tokens)) + 1)
        self._names = [t["content"] for t in added]
        names = sorted(self._names, key=len, reverse=True)
        self._added = regex.compile("|".join(regex.escape(n) for n in names)) if names else None
        self._words = Tokenizer.from_file(path).pre_tokenizer
        self._fits: dict[int, bool] = {}
        # The piece worked out last: the token that ends each prefix, and the counts.
        self._body, self._last, self._counts = b"", [b""], [0]
        self._stand_in: dict[str, str] = {}
        self._steps: dict[str, bytes] = {}

    def _merged(self, body: bytes) -> list[bytes]:
        """The encoding of a few bytes by its definition: the earliest merge first, from left to right."""
        parts = [body[k : k + 1] for k in range(len(body))]
        while len(parts) > 1:
            ranked = [(self._ranks.get(pair, len(self._ranks)), k) for k, pair in enumerate(zip(parts, parts[1:]))]
            rank, at = min(ranked)
            if rank == len(self._ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _follows(self, left: bytes, token: bytes) -> bool:
        """Whether the encoder gives these two for their bytes together; ``left`` may be empty."""
        if len(self._fits) >= PAIRS:
            self._fits.clear()
        found = self._merged(left + token) == ([left, token] if left else [token])
        self._fits[self._numbers[left] << 32 | self._numbers[token]] = found
        return found

    def piece_counts(self, piece: str) -> list[int]:
        """Tokens of each prefix, by code points, of a text that the encoder takes as one word.

        What the piece before has in common with this one at its start is not worked out again.
        """
        body, before = piece.encode(), self._body
        last, counts, numbers, fits = self._last, self._counts, self._numbers, self._fits
        same, most = 0, min(len(body), len(before))
        while same < most and body[same] == before[same]:
            same += 1
        del last[same + 1 :], counts[same + 1 :]
        self._body = body
        for end in range(same + 1, len(body) + 1):
            # One token fits; most often a single byte, or the token before with one byte more, so these are tried first.
            for back in chain((1, len(last[-1]) + 1), self._backs):
                start = end - back
                token = body[start:end]
                number = numbers.get(token)
                if number is None or start < 0:
                    continue
                fit = fits.get(numbers[last[start]] << 32 | number)
                if self._follows(last[start], token) if fit is None else fit:
                    break
            last.append(token)
            counts.append(counts[start] + 1)
        if len(body) == len(piece):
            return counts[1:]
        ends = np.flatnonzero((np.frombuffer(body, np.uint8) & 0xC0) != 0x80)[1:]
        return [counts[k] for k in [*ends.tolist(), len(body)]]

    def _segment_counts(self, segment: str) -> list[int]:
        """Tokens of each prefix of a segment."""
        if segment[0] in _BEFORE_WORD and segment.isascii() and segment[1:].isalpha():
            return self.piece_counts(segment)
        blank = _BLANKS.match(self._seen(segment)).end()
        core = segment[blank:]
        if core and (segment[:blank] == " " or not blank and core not in CONTRACTIONS):
            return self.piece_counts(segment)
        counts = self.piece_counts(segment[:blank])
        if not core:
            return counts
        # The blanks but the last are one word; the last goes with what follows if it is a plain blank.
        base = counts[blank - 2] if blank > 1 else 0
        if blank and segment[blank - 1] == " ":
            return counts + [base + n for n in self.piece_counts(" " + core)[1:]]
        base += self.piece_counts(segment[blank - 1])[0] if blank else 0
        inner = self.piece_counts(core)
        if core in CONTRACTIONS:
            # An incomplete contraction is a sign with letters behind it.
            sign = self.piece_counts(core[0])[0]
            inner[:-1] = [sign, *[sign + n for n in self.piece_counts(core[1:-1])]]
        return counts + [base + n for n in inner]

    def _segment_steps(self, segment: str) -> bytes:
        """How the count changes with each code point of a segment, as 16-bit numbers."""
        counts = self._segment_counts(segment)
        return array("h", map(sub, counts, [0, *counts[:-1]])).tobytes()

    def _seen(self, text: str) -> str:
        """``text`` with characters replaced that this module's patterns class otherwise than the library does."""
        if not _RARE.search(text):
            return text
        for character in set(text) - self._stand_in.keys():
            if len(self._stand_in) > 0x20000:
                self._stand_in.clear()
            for beside, stand_in, known in _CLASSES:
                if beside is None or len(self._words.pre_tokenize_str(beside + character)) == 1:
                    self._stand_in[character] = character if regex.match(known, character) else stand_in
                    break
        replaced = {ord(c): s for c in set(text) if (s := self._stand_in.get(c, c)) != c}
        return text.translate(replaced) if replaced else text

    def _segments(self, text: str) -> Iterator[list[str]]:
        """Segments of a text without added tokens, window by window; windows end where a word does."""
        seen, at = self._seen(text), 0
        pattern = _SEGMENT if _RARE.search(text) else _SEGMENT_256
        while at < len(text):
            cut = _WORD_END.search(seen, at + WINDOW) if len(text) - at > 2 * WINDOW else None
            end = cut.end() if cut else len(text)
            segments = _SEGMENT.findall(seen if end - at == len(text) else seen[at:end])
            if seen is not text:
                ends = np.cumsum([len(s) for s in segments]).tolist()
                segments = [text[at + a : at + b] for a, b in zip([0, *ends], ends)]
            yield segments
            at = end

    def _segments(self, text: str) -> Iterator[list[str]]:
        """Segments of a text without added tokens, window by window; windows end where a word does."""
        seen, at = self._seen(text), 0
        pattern = _SEGMENT if _RARE.search(text) else _SEGMENT_256
        while at < len(text):
            cut = _WORD_END.search(seen, at + WINDOW) if len(text) - at > 2 * WINDOW else None
            end = cut.end() if cut else len(text)
            segments = pattern.findall(seen[at:end])
            if seen is not text:
                ends = np.cumsum([len(s) for s in segments]).tolist()
                segments = [text[at + a : at + b] for a, b in zip([0, *ends], ends)]
            yield segments
            at = end

    def _joined(self, parts: list[list[str]]) -> list[bytes]:
        """Steps of each list of segments. New segments are worked out in order: many begin alike."""
        new = sorted(s for s in set().union(*parts) if s not in self._steps)
        for segment in new:
            self._steps[segment] = self._segment_steps(segment)
        found = [b"".join(map(self._steps.__getitem__, segments)) for segments in parts]
        if len(self._steps) > SEGMENTS:
            self._steps.clear()
        else:
            for segment in new:
                if len(segment) > SEGMENT_LONGEST:
                    del self._steps[segment]
        return found

    def _plain(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self._joined([part])[0] for part in self._segments(text)), dtype=np.int16)

    def _named(self, text: str) -> np.ndarray:
        """Steps of a text with names of added tokens."""
        parts, at = [], 0
        for name in self._added.finditer(text):
            # Up to its last code point the name is plain text behind what stands before it.
            part = self._plain(text[at : name.end()]).copy()
            part[-1] = 1 - int(part[name.start() - at : -1].sum(dtype=np.int64))
            parts.append(part)
            at = name.end()
        return np.concatenate([*parts, self._plain(text[at:])])

    def steps(self, texts: list[str]) -> list[np.ndarray]:
        """Per text how the token count changes with each of its code points. Short texts are taken together."""
        found: list[np.ndarray | None] = [None] * len(texts)
        together, parts = [], []
        for n, text in enumerate(texts):
            if self._added and self._added.search(text):
                found[n] = self._named(text)
            elif len(text) > WINDOW:
                found[n] = self._plain(text)
            else:
                together.append(n)
                parts.append(next(self._segments(text), []))
        for n, joined in zip(together, self._joined(parts)):
            found[n] = np.frombuffer(joined, dtype=np.int16)
        return found


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def packed_steps(steps: np.ndarray) -> bytes:
    """One byte a code point, or two where a step does not fit into one."""
    small = steps.astype(np.int8)
    return small.tobytes() if np.array_equal(small, steps) else steps.astype("<i2").tobytes()


def counts_of(stored: bytes, n_chars: int) -> np.ndarray:
    """Token count of the prefixes of 1, 2, ... code points."""
    return np.cumsum(np.frombuffer(stored, dtype=np.int8 if len(stored) == n_chars else "<i2"), dtype=np.int64)


def prefix_tables(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_chars, n_tokens, steps): the prefix table of every document."""
    id_type = docs.select(F.col(f"`{doc_id}`").alias("doc_id")).schema["doc_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, n_bytes long, n_chars long, n_tokens long, steps binary"
    names = ["doc_id", "n_bytes", "n_chars", "n_tokens", "steps"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            bodies = pc.fill_null(batch.column(1), "")
            sizes = pc.binary_length(bodies).to_numpy(zero_copy_only=False).astype(np.int64)
            first = 0
            while first < len(bodies):
                # As many texts as have PART bytes together, one at least.
                taken = max(1, int(np.searchsorted(np.cumsum(sizes[first:]), PART, side="right")))
                texts = bodies.slice(first, taken).to_pylist()
                rows = [
                    (n_bytes, len(text), int(steps.sum(dtype=np.int64)), packed_steps(steps))
                    for n_bytes, text, steps in zip(sizes[first : first + taken].tolist(), texts, count.steps(texts))
                ]
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, taken), *columns], names=names)
                first += taken

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)


def _longest_within(stored: bytes, n_chars: int, n_tokens: int, limit: int) -> tuple[int, int]:
    """The longest prefix of at most ``limit`` tokens: its code points and its tokens."""
    if n_tokens <= limit:
        return n_chars, n_tokens
    counts = counts_of(stored, n_chars)
    fitting = np.flatnonzero(counts <= limit)
    return (int(fitting[-1]) + 1, int(counts[fitting[-1]])) if len(fitting) else (0, 0)


def truncations(tables: DataFrame, limit: int | Column) -> DataFrame:
    """``tables`` without steps, with ``cut_chars`` and ``cut_tokens``: the longest prefix within ``limit`` tokens.

    ``limit`` may be a column of ``tables``; below 0 it counts as 0, and null leaves the text whole.
    """
    kept = [c for c in tables.columns if c != "steps"]
    wanted = limit if isinstance(limit, Column) else F.lit(limit)
    asked = tables.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "steps", "n_chars", "n_tokens",
                          wanted.cast("long").alias("limit"))
    out = asked.select("row").schema.add("cut_chars", "long").add("cut_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, steps, chars, tokens, limits = batch.columns
            over = pc.fill_null(pc.greater(tokens, pc.max_element_wise(limits, 0)), False)
            over = pc.and_(over, pc.is_valid(limits)).to_numpy(zero_copy_only=False)
            cut, count = chars.to_numpy().copy(), tokens.to_numpy().copy()
            for n in np.flatnonzero(over).tolist():
                most = max(0, limits[n].as_py())
                cut[n], count[n] = _longest_within(steps[n].as_py(), int(cut[n]), int(count[n]), most)
            yield pa.RecordBatch.from_arrays([row, pa.array(cut), pa.array(count)], names=["row", "cut_chars", "cut_tokens"])

    return asked.mapInArrow(run, out).select("row.*", "cut_chars", "cut_tokens")


def counts_at(tables: DataFrame, position: Column) -> DataFrame:
    """``tables`` without steps, with ``position`` and ``tokens_before``, the count of the prefix that ends there.

    ``position`` counts code points; it is held between 0 and the length of the text, and null gives null.
    """
    kept = [c for c in tables.columns if c != "steps"]
    inside = F.when(position.isNotNull(), F.least(F.greatest(position.cast("long"), F.lit(0)), "n_chars"))
    asked = tables.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "steps", "n_chars", inside.alias("position"))
    out = asked.select("row", "position").schema.add("tokens_before", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, steps, chars, positions = batch.columns
            found = []
            for stored, length, at in zip(steps, chars.to_pylist(), positions.to_pylist()):
                counts = counts_of(stored.as_py(), length) if at else None
                found.append(int(counts[at - 1]) if at else at)
            yield pa.RecordBatch.from_arrays([row, positions, pa.array(found, pa.int64())], names=["row", "position", "tokens_before"])

    return asked.mapInArrow(run, out).select("row.*", "position", "tokens_before")


def within_budget(tables: DataFrame, budget: int, order_by: str = "doc_id") -> DataFrame:
    """The documents that ``budget`` tokens pay for, in order; the last one is cut to what is left.

    Running totals come from one range shuffle of narrow rows and one row per partition; the tables stay where they are
    but for that of the document at the edge. Rows that tie in ``order_by`` come in the order of a hash.
    """
    named = tables.select("doc_id", "n_bytes", "n_chars", "n_tokens", F.xxhash64("steps").alias("sum"), *(
        [] if order_by in ("doc_id", "n_bytes", "n_chars", "n_tokens") else [order_by]))
    ranked = materialised(number_rows(named, [order_by], "rank"), "ranked")
    # Totals of blocks of ranks first: a block has BLOCK rows, and a table so many rows fewer of them.
    block = F.floor((F.col("rank") - 1) / BLOCK)
    totals = _running(ranked.groupBy(block.alias("block")).agg(F.sum("n_tokens").alias("tokens")))
    edge = totals.where(F.col("before") <= budget).agg(F.max("block").alias("block"), F.max("before").alias("before")).first()
    if edge["block"] is None:
        return ranked.limit(0).select("doc_id", "n_bytes", "n_chars", "n_tokens").withColumns(
            {"cut_chars": F.lit(0).cast("long"), "cut_tokens": F.lit(0).cast("long")})
    whole = ranked.where(block < edge["block"]).withColumns({"cut_chars": F.col("n_chars"), "cut_tokens": F.col("n_tokens")})
    left, rows, cut = budget - edge["before"], [], None
    for r in ranked.where(block == edge["block"]).orderBy("rank").collect():  # at most BLOCK narrow rows
        if r["n_tokens"] > left:
            cut = (r["rank"], left)
            break
        rows.append(r["rank"])
        left -= r["n_tokens"]
    last = rows[-1] if rows else edge["block"] * BLOCK
    inside = ranked.where((block == edge["block"]) & (F.col("rank") <= last))
    paid = whole.drop("rank", "sum").unionByName(
        inside.drop("rank", "sum").withColumns({"cut_chars": F.col("n_chars"), "cut_tokens": F.col("n_tokens")}))
    names = ["doc_id", "n_bytes", "n_chars", "n_tokens", "cut_chars", "cut_tokens"]
    if cut is None or cut[1] <= 0:
        return paid.select(names)
    at = ranked.where(F.col("rank") == cut[0]).select(F.col("doc_id").alias("_id"), F.col("sum").alias("_sum")).limit(1)
    found = tables.join(F.broadcast(at), tables["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64("steps") == F.col("_sum"))).limit(1)
    one = truncations(found.select("doc_id", "n_bytes", "n_chars", "n_tokens", "steps"), cut[1]).where("cut_chars > 0")
    return paid.select(names).unionByName(one.select(names))


def _running(blocks: DataFrame) -> DataFrame:
    """(block, tokens, before): what all earlier blocks hold. One row per ``BLOCK`` documents is sorted in one task."""
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
