"""Language of texts by a bidirectional gated recurrent network over their bytes.

The network reads windows of ``WINDOW`` bytes in both directions, gives every byte a distribution over the
languages, and a document's probabilities are the mean over all its bytes. It is trained here, in numpy, by
backpropagation through time, on snippets of a bounded sample: every language with a labelled document to learn from
is learned, ``SAMPLE`` documents are shared out to them, to each ``SAMPLE_PER_LANGUAGE`` at most and, however many
languages there are, ``LEAST_PER_LANGUAGE`` as far as it has them; ``SNIPPETS`` snippets each, from
places all over the text. Units and steps of training grow with the number of languages. Prediction reads whole
texts, window by window, with thousands of windows in step (fewer with more languages), so memory does not depend
on the length of a text.

Defined cases: a null id counts as an empty one and is held out; a null text and one without a letter are ``und`` with score 0;
repeated rows are
judged row by row; with nothing to learn from, every text is ``und``; an empty table gives an
empty result; further columns are ignored. Language, source and id of a row are not looked at
when it is judged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starledger.llm.arrowtext import slices, with_text_columns
from starledger.llm.samples import held_out, per_label

WINDOW = 128
UNITS = 8
SAMPLE = 38_400
SAMPLE_PER_LANGUAGE = 600
LEAST_PER_LANGUAGE = 20
SNIPPETS = 6
STEPS = 260
#: ``UNITS`` and ``STEPS`` are for so many languages, ``TOGETHER`` for four times as many.
FEW = 4
BATCH = 192
LENGTH = 56
RATE = 0.012
TOGETHER = 2048
SEED = 11
_SPACE = 0x20


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


class Direction:
    """One gated recurrent layer; states are (units, windows), so gates are rows."""

    names = ("table", "inner", "bias")

    def __init__(self, rng: np.random.Generator, units: int = UNITS):
        self.table = (rng.normal(size=(3 * units, 256)) * 0.3).astype(np.float32)
        self.inner = (rng.normal(size=(3 * units, units)) / np.sqrt(units)).astype(np.float32)
        self.bias = np.zeros((units, 1), dtype=np.float32)

    def read(self, steps: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States after each row of ``steps`` (time, windows)."""
        time, windows = steps.shape
        units = len(self.bias)
        h = np.zeros((units, windows), dtype=np.float32)
        out = np.empty((time, units, windows), dtype=np.float32)
        for t in range(time):
            x = np.take(self.table, steps[t], axis=1)
            inner = self.inner @ h
            gates = x[: 2 * units]
            gates += inner[: 2 * units]
            gates *= np.float32(0.5)
            np.tanh(gates, out=gates)
            gates *= np.float32(0.5)
            gates += np.float32(0.5)
            keep, reset = gates[:units], gates[units:]
            held = inner[2 * units :] + self.bias
            new = x[2 * units :]
            new += reset * held
            np.tanh(new, out=new)
            before = h
            h = np.subtract(before, new, out=out[t])
            h *= keep
            h += new
            if trace is not None:
                trace.append((before, keep, reset, held, new))
        return out

    def learn(self, steps: np.ndarray, trace: list, errors: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients, given those of the states, from the last step back to the first."""
        table = np.zeros_like(self.table)
        inner = np.zeros_like(self.inner)
        bias = np.zeros_like(self.bias)
        carried = np.zeros_like(errors[0])
        for t in reversed(range(len(steps))):
            before, keep, reset, held, new = trace[t]
            dh = errors[t] + carried
            dnew = dh * (1 - keep) * (1 - new * new)
            dkeep = dh * (before - new) * keep * (1 - keep)
            dreset = dnew * held * reset * (1 - reset)
            dheld = dnew * reset
            through = np.concatenate([dkeep, dreset, dheld])
            inner += through @ before.T
            bias += dheld.sum(axis=1, keepdims=True)
            direct = np.concatenate([dkeep, dreset, dnew])
            np.add.at(table.T, steps[t], direct.T)
            carried = dh * keep + self.inner.T @ through
        return {"table": table, "inner": inner, "bias": bias}


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    weight: np.ndarray
    offset: np.ndarray

    def probabilities(self, windows: np.ndarray, traces: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Of every byte, (time, languages, windows), and the states (time, 2 units, windows)."""
        steps = np.ascontiguousarray(windows.T)
        one = self.forward.read(steps, traces[0] if traces else None)
        two = self.backward.read(steps[::-1], traces[1] if traces else None)[::-1]
        states = np.concatenate([one, two], axis=1)
        scores = self.weight @ states + self.offset
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores, states


def _windows(snippets: list[bytes], starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.full((len(snippets), length), _SPACE, dtype=np.uint8)
    inside = np.zeros((len(snippets), length), dtype=np.float32)
    for row, (body, start) in enumerate(zip(snippets, starts)):
        part = body[start : start + length]
        out[row, : len(part)] = np.frombuffer(part, dtype=np.uint8)
        inside[row, : len(part)] = 1
    return out, inside


def train(snippets: list[bytes], languages: list[str], seed: int = SEED) -> Network:
    """Adam on the mean cross-entropy of all bytes; every batch has the languages in equal parts."""
    rng = np.random.default_rng(seed)
    by_name: dict[str, list[bytes]] = {}
    for snippet, name in zip(snippets, languages):
        by_name.setdefault(name, []).append(snippet)
    names = sorted(by_name)
    of = [by_name[n] for n in names]
    growth = np.sqrt(max(1.0, len(names) / FEW))
    units, count = round(UNITS * np.sqrt(growth)), round(STEPS * growth)
    net = Network(
        names, Direction(rng, units), Direction(rng, units),
        (rng.normal(size=(len(names), 2 * units)) * 0.3).astype(np.float32), np.zeros((len(names), 1), np.float32),
    )
    slots = [(net.forward, k) for k in Direction.names] + [(net.backward, k) for k in Direction.names]
    slots += [(net, "weight"), (net, "offset")]
    first = [np.zeros_like(getattr(o, k)) for o, k in slots]
    second = [np.zeros_like(getattr(o, k)) for o, k in slots]
    for step in range(count):
        truth = rng.integers(len(names), size=BATCH)
        chosen = [of[n][rng.integers(len(of[n]))] for n in truth]
        # A part of the examples is cut short, as short texts are.
        chosen = [c[: rng.integers(4, 40)] if rng.random() < 0.25 else c for c in chosen]
        starts = np.array([rng.integers(max(1, len(c) - LENGTH + 1)) for c in chosen])
        windows, inside = _windows(chosen, starts, LENGTH)
        traces = ([], [])
        found, states = net.probabilities(windows, traces)
        errors = found
        errors[:, truth, np.arange(BATCH)] -= 1
        errors *= (inside.T / inside.sum())[:, None, :]
        weight = np.einsum("tlb,tsb->ls", errors, states)
        back = np.einsum("ls,tlb->tsb", net.weight, errors)
        steps = np.ascontiguousarray(windows.T)
        one = net.forward.learn(steps, traces[0], back[:, :units])
        two = net.backward.learn(steps[::-1], traces[1], back[::-1, units:])
        slopes = [one[k] for k in Direction.names] + [two[k] for k in Direction.names]
        slopes += [weight, errors.sum(axis=(0, 2))[:, None]]
        rate = RATE * min(1.0, 2.5 * (1 - step / count))
        for n, ((owner, name), slope) in enumerate(zip(slots, slopes)):
            slope = np.clip(slope, -1, 1)
            first[n] = 0.9 * first[n] + 0.1 * slope
            second[n] = 0.99 * second[n] + 0.01 * slope * slope
            change = (first[n] / (1 - 0.9 ** (step + 1))) / (np.sqrt(second[n] / (1 - 0.99 ** (step + 1))) + 1e-8)
            setattr(owner, name, (getattr(owner, name) - rate * change).astype(np.float32))
    return net


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probabilities (texts, languages) over all bytes of each text."""
    lengths = np.diff(offsets)
    count = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(lengths)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    starts = offsets[owner] + place * WINDOW
    sizes = np.minimum(WINDOW, offsets[owner + 1] - starts)
    total = np.zeros((len(lengths), len(net.languages)))
    padded = np.concatenate([data, np.full(WINDOW, _SPACE, np.uint8)])
    # Windows of like size go together, so that short ones take few steps.
    order = np.argsort(-sizes, kind="stable")
    together = max(16, min(TOGETHER, TOGETHER * 4 * FEW // len(net.languages)))
    for at in range(0, len(order), together):
        rows = order[at : at + together]
        width = int(sizes[rows[0]])
        outside = np.arange(width) >= sizes[rows][:, None]
        windows = padded[starts[rows][:, None] + np.arange(width)]
        windows[outside] = _SPACE
        found, _ = net.probabilities(windows)
        if outside.any():
            found *= ~outside.T[:, None, :]
        np.add.at(total, owner[rows], found.sum(axis=0).T)
    return total / np.maximum(lengths, 1)[:, None]


def learned(docs: DataFrame, doc_id: str, text: str, language: str, seed: int = SEED) -> Network | None:
    """A network trained on the documents that are not held out; None if there are none."""
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{language}`").alias("language")
    ).where(F.col("language").isNotNull() & ~held_out("doc_id") & F.col("text").rlike(r"\p{L}"))
    # Cut before they are reduced and shuffled.
    room = F.greatest(F.length("text") - LENGTH, F.lit(1))
    places = [F.pmod(F.xxhash64(F.lit(seed), "doc_id", F.lit(k)), room).cast("int") + 1 for k in range(1, SNIPPETS + 1)]
    rows = rows.withColumn("snippets", F.array(*[F.substr("text", place, F.lit(2 * LENGTH)) for place in places]))
    chosen = per_label(
        rows, "language", ["doc_id", "text"], ["snippets"], SAMPLE, SAMPLE_PER_LANGUAGE, LEAST_PER_LANGUAGE, seed
    )
    found = sorted((r["language"], snippet) for r in chosen.collect() for snippet in r["snippets"])
    if not found:
        return None
    return train([s.encode() for _, s in found], [name for name, _ in found], seed)


def identified(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", language: str = "lang", net: Network | None = None
) -> DataFrame:
    """Per document doc_id, held_out, lang_pred and score, the pooled probability of that language."""
    net = net or learned(docs, doc_id, text, language)
    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), held_out(doc_id).alias("held_out"),
        F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False)).alias("wordy"),
    )
    if net is None:
        return narrow.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))

    def kernel(texts: pa.Array) -> dict[str, pa.Array]:
        best, score = [], []
        for _, _, data, offsets in slices(texts):
            found = pooled(net, data, offsets)
            best += [net.languages[n] for n in found.argmax(axis=1)]
            score += found.max(axis=1).tolist()
        return {"lang_pred": pa.array(best, pa.string()), "score": pa.array(score, pa.float64())}

    found = with_text_columns(narrow, "text", kernel, {"lang_pred": "string", "score": "double"})
    wordy = F.col("row.wordy")
    return found.select(
        "row.doc_id", "row.held_out",
        F.when(wordy, F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(wordy, F.least(F.col("score"), F.lit(1.0))).otherwise(0.0).alias("score"),
    )
