"""Secrets in texts: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Three base kinds are found by pattern (``assign``, ``access``, ``hex``). Beyond them, a run of at least
``LEAST`` characters of the kind that keys are written in is reported as ``random`` when the first model
explains it better than the second: its log-likelihood ratio per character has to exceed a limit learned
from ordinary words, and its total ``TOTAL``. Runs without a digit have a limit of their own, learned from
ordinary words without one, since those are what long names and joined words look like. Both models are tables of character pairs. They learn from a
bounded sample of ``SAMPLE`` documents: the values of base spans, and strings drawn from
the usual key alphabets, are labelled random; the other words of those documents, but for long ones
of letters and digits, are labelled ordinary (``WORDS_PER_DOCUMENT`` of each, spread over the text).

Defined cases: a null text is an empty one and has no spans; repeated rows are judged row by
row; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starledger.llm.arrowtext import slices, with_text_columns
from starledger.llm.samples import per_label

LEAST = 20
TOTAL = 12.0
SAMPLE = 4000
WORDS_PER_DOCUMENT = 40
DRAWN = 4000
SEED = 41
#: Share of ordinary words whose ratio stays below the limit, and the bounds of that limit.
ORDINARY_BELOW = 0.999
LIMITS = (0.3, 1.0)
LIMITS_WITHOUT_DIGIT = (0.8, 2.0)

# The base kinds, in the order in which they are listed.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ASSIGN_LEAST = 6
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_ACCESS_LEAST = 20
_HEX = re.compile(r"[0-9a-f]+")
_HEX_LEAST = 24

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_KEY_BYTE = np.isin(np.arange(256), list(_ALPHABET.encode()))
_CODE = np.full(256, 0, dtype=np.int64)
_CODE[list(_ALPHABET.encode())] = np.arange(1, len(_ALPHABET) + 1)
_WIDTH = len(_ALPHABET) + 1  # 0 stands for the start

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of runs of key characters, ``LEAST`` or longer, inside one text."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _KEY_BYTE[data]
    change = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = change[0::2], change[1::2]
    crossing = np.searchsorted(offsets, ends) - np.searchsorted(offsets, starts, side="right")
    if (crossing > 0).any():
        # Runs that go on over the border of texts are cut there.
        cut = np.unique(np.concatenate([starts, offsets[:-1][inside[1:][np.minimum(offsets[:-1], len(data))]]]))
        stops = np.unique(np.concatenate([ends, offsets[1:][inside[offsets[1:]]]]))
        starts, ends = cut, stops
    long_ = ends - starts >= LEAST
    return starts[long_], ends[long_]


def base_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int, str, str]]:
    """(start, kind number, ...) of the base kinds; ``runs`` are the long runs of key characters in the text.

    Whatever is a hex or access span lies inside such a run.
    """
    found = []
    lowered = text.lower()
    if any(word in lowered for word in _KEYWORDS):
        for m in _ASSIGN.finditer(text):
            if len(m[1]) >= _ASSIGN_LEAST:
                found.append((m.start(), 0, m.end(), m[1]))
    for start, end in runs:
        part = text[start:end]
        for number, pattern, least in ((1, _ACCESS, _ACCESS_LEAST), (2, _HEX, _HEX_LEAST)):
            for m in pattern.finditer(part):
                if len(m[0]) >= least:
                    found.append((start + m.start(), number, start + m.end(), m[0]))
    return sorted(found)


def _codes(value: str) -> np.ndarray:
    return _CODE[np.frombuffer(value.encode(), dtype=np.uint8)]


def _pairs(values: list[str]) -> np.ndarray:
    counts = np.zeros(_WIDTH * _WIDTH)
    for value in values:
        codes = _codes(value)
        counts += np.bincount(np.concatenate([[0], codes[:-1]]) * _WIDTH + codes, minlength=_WIDTH * _WIDTH)
    return counts.reshape(_WIDTH, _WIDTH)


@dataclass
class Models:
    """Log-likelihood ratio of each pair of characters, and the limit per character."""

    ratio: np.ndarray
    limit: float
    limit_without_digit: float

    def judge(self, value: str) -> tuple[float, float]:
        """The ratio in total and per character."""
        codes = _codes(value)
        total = float(self.ratio[np.concatenate([[0], codes[:-1]]), codes].sum())
        return total, total / len(value)

    def is_random(self, value: str) -> bool:
        total, each = self.judge(value)
        limit = self.limit if any(c.isdigit() for c in value) else self.limit_without_digit
        return total > TOTAL and each > limit


def train(random: list[str], ordinary: list[str]) -> Models:
    def chances(values: list[str]) -> np.ndarray:
        counts = _pairs(values) + 0.05
        counts[:, 0] = 0
        return counts / counts.sum(axis=1, keepdims=True)

    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.nan_to_num(np.log(chances(random)) - np.log(chances(ordinary)), posinf=0.0, neginf=0.0)
    models = Models(ratio, 0.0, 0.0)

    def limit(words: list[str], bounds: tuple[float, float]) -> float:
        # A secret that no pattern finds counts as ordinary here; the upper bound keeps it from hiding others.
        seen = [models.judge(w)[1] for w in words if len(w) >= LEAST // 2]
        return float(np.clip(np.quantile(seen, ORDINARY_BELOW), *bounds)) if seen else bounds[0]

    models.limit = limit(ordinary, LIMITS)
    models.limit_without_digit = limit([w for w in ordinary if not any(c.isdigit() for c in w)], LIMITS_WITHOUT_DIGIT)
    return models


def drawn(seed: int = SEED) -> list[str]:
    """Random strings in the usual alphabets of keys."""
    rng = np.random.default_rng(seed)
    out = []
    for n in range(DRAWN):
        raw = rng.bytes(int(rng.integers(15, 40)))
        forms = (raw.hex(), base64.b64encode(raw).decode().rstrip("="), base64.b32encode(raw).decode().rstrip("="))
        out.append(forms[n % 3] if n % 4 else "".join(_ALPHABET[:62][b % 62] for b in raw))
    return out


def _may_be_key(word: str) -> bool:
    """Long words of letters and digits are what is to be judged, so they are no examples of ordinary ones."""
    return len(word) >= LEAST and any(c.isdigit() for c in word) and any(c.isalpha() for c in word)


def learned(docs: DataFrame, doc_id: str, text: str) -> Models:
    body = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.lit(0).alias("every")
    ).where("text is not null")
    sample = per_label(body, "every", ["doc_id", "text"], ["text"], SAMPLE, None, 0, SEED).select("text")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, value = [], []
            for at, to, data, offsets in slices(batch.column(0)):
                for row in range(at, to):
                    body = batch.column(0)[row].as_py()
                    own = data[offsets[row - at] : offsets[row - at + 1]]
                    spans = base_spans(body, _points(own, *_runs(own, np.array([0, len(own)]))))
                    for start, _, end, secret in spans[:WORDS_PER_DOCUMENT]:
                        label.append(1)
                        value.append(secret[:200])
                    words = [
                        w[:200] for w in re.findall(r"[A-Za-z0-9+/_=-]{4,}", body)
                        if not any(w in s[3] or s[3] in w for s in spans) and not _may_be_key(w)
                    ]
                    some = words[:: max(1, len(words) // WORDS_PER_DOCUMENT)][:WORDS_PER_DOCUMENT]
                    label += [0] * len(some)
                    value += some
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(value, pa.string())], ["label", "value"])

    found = sample.mapInArrow(collect, "label int, value string").toArrow().to_pydict()
    keys = [re.sub(r"[^A-Za-z0-9+/_=-]", "", v) for v in found["value"]]
    ordinary = sorted(k for k, label in zip(keys, found["label"]) if label == 0 and k)
    random = sorted(k for k, label in zip(keys, found["label"]) if label == 1 and len(k) >= _ASSIGN_LEAST)
    return train(random + drawn(), ordinary or ["ordinary"])


def _points(own: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Byte positions of one text as code points."""
    if not len(starts):
        return []
    before = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
    return list(zip(before[starts].tolist(), before[ends].tolist()))


def _kernel(models: Models):
    def kernel(texts: pa.Array) -> dict[str, pa.Array]:
        base, every = [], []
        for at, to, data, offsets in slices(texts):
            starts, ends = _runs(data, offsets)
            first = np.searchsorted(starts, offsets[:-1])
            last = np.searchsorted(starts, offsets[1:])
            for row in range(to - at):
                text = texts[at + row].as_py() or ""
                low = offsets[row]
                own = slice(first[row], last[row])
                runs = _points(data[low : offsets[row + 1]], starts[own] - low, ends[own] - low)
                found = base_spans(text, runs)
                spans = [(s, k, e, KINDS[k], models.judge(re.sub(r"[^A-Za-z0-9+/_=-]", "", v) or "=")[1]) for s, k, e, v in found]
                extra = []
                for start, end in runs:
                    value = text[start:end]
                    free = all(e <= start or end <= s for s, _, e, *_ in found)
                    if free and models.is_random(value):
                        extra.append((start, len(KINDS), end, "random", models.judge(value)[1]))
                base.append([_span(x) for x in spans])
                every.append([_span(x) for x in sorted([*spans, *extra])])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        return {"base": pa.array(base, kind), "spans": pa.array(every, kind)}

    return kernel


def _span(found) -> dict:
    return {"kind": found[3], "start": found[0], "end": found[2], "score": found[4]}


def found(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", models: Models | None = None) -> DataFrame:
    """Per document ``doc_id``, ``base`` and ``spans``: arrays of (kind, start, end, score) by start, then kind.

    Positions are code points and the end is exclusive; the score is the log-likelihood ratio per character.
    """
    models = models or learned(docs, doc_id, text)
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = with_text_columns(narrow, "text", _kernel(models), {"base": SPANS, "spans": SPANS})
    return out.select("row.doc_id", "base", "spans")


def digest(spans: str | Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")
