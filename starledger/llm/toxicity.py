"""Toxicity scores from gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: densities of a lexicon, common insults and words learned from the labelled sample (words and words with
digits or signs in place of letters), lexicon words near a second-person pronoun, rates of capitals,
punctuation, repeated signs and obfuscated words, and length. The labelled sample is bounded
(``SAMPLE`` documents by hash, half of them toxic; what one label has too few documents for goes to the other)
and each label is cut in three by hash: one part gives the lexicon, one grows the
trees, one calibrates them, so that no step learns from what an earlier one has fitted. Rows weigh by the
inverse of their label's share in the sample, so scores are shares of the whole table.
Only ids, word counts and feature rows of the sample come to the driver.

Defined cases: a null text is an empty one and is scored like any text; with fewer than ``FEWEST`` labelled documents
of either kind every score is the share of toxic labels (0 without any); labels without a document teach nothing;
of several labels of one id the highest
counts; repeated rows are scored row by row; an empty table gives an empty result; further columns
are ignored. Labels, language, source and id of a row are not looked at when it is scored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from starledger.llm.arrowtext import LOWER, hash_heads, hash_runs, owners, slices, with_text_columns
from starledger.llm.samples import held_out, share_of_hash, shares

SAMPLE = 24_000
#: Labelled documents of each kind, so that each third of the sample has some.
FEWEST = 10
LEXICON = 600
#: A strong entry has this share of the largest weight.
STRONG = 0.7
#: An entry is in this share of the toxic documents at least, and in three.
SUPPORT = 0.01
#: Bytes of the heads of words that may be entries.
HEADS = (4, 5, 6)
NEAR = 5
SEED = 29
TREES = 60
DEPTH = 3
RATE = 0.2
BINS = 32
# Second-person pronouns of the languages at hand.
SECOND_PERSON = "you your yours u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted vosotros"
# Common insults; the learned words add to them.
INSULTS = (
    "idiot idiots moron morons stupid dumb dumbass loser losers trash garbage scum worthless pathetic disgusting clown "
    "jerk creep fool imbecile cretin bastard bitch asshole retard ugly filthy "
    "dummkopf trottel arschloch depp abschaum wertlos widerlich connard imbécile abruti crétin ordure minable "
    "idiota imbécil estúpido estúpida tonto basura escoria asqueroso"
)
INSULT_WEIGHT = 3.0

_BYTES = np.arange(256)
_LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) & (_BYTES < 128) | (_BYTES >= 128)
_CAPITAL = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_MARK = np.isin(_BYTES, list(b"!?"))
_SIGN = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER & ~_DIGIT
# Signs that stand for letters.
_STANDS_FOR = {b"0": b"o", b"1": b"i", b"3": b"e", b"4": b"a", b"5": b"s", b"7": b"t", b"@": b"a", b"$": b"s", b"!": b"i"}
_PLAIN = LOWER.copy()
for _sign, _letter in _STANDS_FOR.items():
    _PLAIN[ord(_sign)] = ord(_letter)
_DISGUISED = _LETTER | np.isin(_BYTES, [ord(s) for s in _STANDS_FOR])

FEATURES = [
    "strong", "strong_rate", "lexicon", "lexicon_rate", "disguised", "near_person", "person_rate", "weight_rate",
    "heaviest", "capital_rate", "mark_rate", "sign_rate", "digit_rate", "mixed_rate", "long_run_rate", "words",
]


def _hash_of(words: list[str]) -> np.ndarray:
    texts = pa.array(words or [""])
    found = [hash_runs(data, offsets, _LETTER, LOWER)[2] for _, _, data, offsets in slices(texts)]
    return np.concatenate(found)


def _tokens(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
    """Words, and the heads of longer words: row of the word and hash, one array pair each."""
    yield np.arange(len(starts)), hashes
    for width in HEADS:
        rows = np.flatnonzero(ends - starts > width)
        yield rows, hash_heads(data, starts[rows], width, LOWER) ^ np.uint64(width)


@dataclass
class Lexicon:
    """Hashes of words, sorted, with their weights."""

    hashes: np.ndarray
    weights: np.ndarray
    strong: np.ndarray

    @classmethod
    def of(cls, weighted: dict[int, float]) -> "Lexicon":
        hashes = np.array(sorted(weighted), dtype=np.uint64)
        weights = np.array([weighted[int(h)] for h in hashes])
        return cls(hashes, weights, weights >= STRONG * weights.max(initial=0.0))

    def weigh(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
        """Per word the largest weight of itself and its heads, and whether that is a strong one."""
        weight, strong = np.zeros(len(starts)), np.zeros(len(starts), dtype=bool)
        for rows, found in _tokens(data, starts, ends, hashes):
            own, is_strong = self.look_up(found)
            weight[rows] = np.maximum(weight[rows], own)
            strong[rows] |= is_strong
        return weight, strong

    def look_up(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight (0: not a word of it) and whether it is a strong one."""
        if not len(self.hashes):
            return np.zeros(len(found)), np.zeros(len(found), dtype=bool)
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        hit = self.hashes[at] == found
        return np.where(hit, self.weights[at], 0.0), hit & self.strong[at]


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    persons = np.sort(_hash_of(SECOND_PERSON.split()))
    out = []
    for at, to, data, offsets in slices(texts):
        n = to - at
        starts, ends, hashes = hash_runs(data, offsets, _LETTER, LOWER)
        owner = owners(offsets, starts)

        def per_text(values, own=owner, n=n):
            return np.bincount(own, weights=values, minlength=n)

        def rate(table):
            marks = table[data]
            return np.array([np.count_nonzero(marks[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], dtype=float)

        weight, strong = lexicon.weigh(data, starts, ends, hashes)
        person = np.isin(hashes, persons)
        near = np.zeros(len(hashes), dtype=bool)
        hits, people = np.flatnonzero(weight > 0), np.flatnonzero(person)
        if len(hits) and len(people):
            after = np.minimum(np.searchsorted(people, hits), len(people) - 1)
            for other in (people[after], people[np.maximum(after - 1, 0)]):
                near[hits] |= (np.abs(other - hits) <= NEAR) & (owner[other] == owner[hits])
        begin, end, disguised = hash_runs(data, offsets, _DISGUISED, _PLAIN)
        held = owners(offsets, begin)
        disguise = lexicon.look_up(disguised)[0] > 0
        letters = rate(_LETTER)
        digits = rate(_DIGIT)
        # Words with a digit or sign between their letters, and runs of one character.
        mixed = np.bincount(held, minlength=n) * 1.0
        mixed = np.maximum(np.bincount(owner, minlength=n) - mixed, 0)
        same = np.zeros(len(data), dtype=bool)
        if len(data) > 2:
            same[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
        runs = np.array([np.count_nonzero(same[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], dtype=float)
        words = np.bincount(owner, minlength=n).astype(float)
        size = np.maximum(np.diff(offsets), 1).astype(float)
        per_word = np.maximum(words, 1)
        plain_hits = per_text((weight > 0) * 1.0)
        heaviest = np.zeros(n)
        np.maximum.at(heaviest, owner, weight)
        out.append(np.column_stack([
            per_text(strong * 1.0), per_text(strong * 1.0) / per_word, plain_hits, plain_hits / per_word,
            np.maximum(np.bincount(held, weights=disguise, minlength=n) - plain_hits, 0),
            per_text(near * 1.0), per_text(person * 1.0) / per_word, per_text(weight) / per_word, heaviest,
            rate(_CAPITAL) / np.maximum(letters, 1), rate(_MARK) / size, rate(_SIGN) / size, digits / size,
            mixed / per_word, runs / size, np.log1p(words),
        ]))
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


@dataclass
class Trees:
    """Boosted trees of ``DEPTH`` levels; node k has the children 2k + 1 and 2k + 2."""

    start: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    limit: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += leaf[node - (2**DEPTH - 1)]
        return total


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Trees:
    """Second-order boosting of the logistic loss on binned features.

    Each label gives borders of bins, as rows of a rare one fill no bin of all rows.
    """
    weight = np.ones(len(y)) if weight is None else weight
    parts = [x[y == label] for label in np.unique(y)]
    at = np.linspace(0, 1, BINS)[1:-1]
    edges = [np.unique(np.concatenate([np.quantile(part[:, f], at) for part in parts])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T)])
    mean = np.clip(np.average(y, weights=weight), 1e-9, 1 - 1e-9)
    model = Trees(float(np.log(mean / (1 - mean))))
    raw = np.full(len(y), model.start)
    inner = 2**DEPTH - 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        slope, curve = weight * (p - y), weight * p * (1 - p)
        feature, limit = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for k in range(inner):
            rows = np.flatnonzero(node == k)
            if len(rows) >= 10:
                feature[k], limit[k] = _best_split(binned[rows], slope[rows], curve[rows], edges)
            node[rows] = 2 * k + 1 + (x[rows, feature[k]] > limit[k])
        at = node - inner
        g = np.bincount(at, weights=slope, minlength=inner + 1)
        h = np.bincount(at, weights=curve, minlength=inner + 1)
        leaf = -RATE * g / (h + 1.0)
        model.feature.append(feature)
        model.limit.append(limit)
        model.leaf.append(leaf)
        raw += leaf[at]
    return model


def _best_split(binned, slope, curve, edges) -> tuple[int, float]:
    best = (1e-6, 0, np.inf)
    g, h = slope.sum(), curve.sum()
    for f, e in enumerate(edges):
        if not len(e):
            continue
        left_g = np.cumsum(np.bincount(binned[:, f], weights=slope, minlength=len(e) + 1))[:-1]
        left_h = np.cumsum(np.bincount(binned[:, f], weights=curve, minlength=len(e) + 1))[:-1]
        left_n = np.cumsum(np.bincount(binned[:, f], minlength=len(e) + 1))[:-1]
        gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1)
        gain[(left_n < 3) | (len(slope) - left_n < 3)] = 0
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], f, e[k])
    return best[1], float(best[2])


def isotonic(raw: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rising curve of label shares over raw scores (pool adjacent violators), as points to interpolate.

    Rows of one raw score are one pool from the start. One row of the overall share in each pool keeps shares off 0 and 1.
    """
    weight = np.ones(len(y)) if weight is None else weight
    mean = np.average(y, weights=weight)
    scores, at = np.unique(raw, return_inverse=True)
    pools: list[list[float]] = []  # labels, rows, sum of raw
    for r, label, rows in zip(scores, np.bincount(at, weights=weight * y), np.bincount(at, weights=weight)):
        pools.append([label, rows, r * rows])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    points = np.array([p[2] / p[1] for p in pools])
    found = np.array([(p[0] + mean) / (p[1] + 1) for p in pools])
    return points, np.maximum.accumulate(found)


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees
    points: np.ndarray
    shares: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.trees.raw(x)
        calibrated = np.interp(raw, self.points, self.shares)
        # A trace of the raw score keeps the order inside a flat part of the curve.
        return np.clip(0.999 * calibrated + 0.001 / (1 + np.exp(-raw)), 0.0, 1.0)


def _lexicon(sample: DataFrame) -> Lexicon:
    """Words and heads of words whose share among toxic documents is surely above that among the others."""
    counts = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)

    def kernel(texts: pa.Array) -> dict[str, pa.Array]:
        parts = []
        for at, to, data, offsets in slices(texts):
            starts, ends, hashes = hash_runs(data, offsets, _LETTER, LOWER)
            owner = owners(offsets, starts)
            tokens = [(owner[rows], found) for rows, found in _tokens(data, starts, ends, hashes)]
            held, found = (np.concatenate(x) for x in zip(*tokens))
            borders = np.searchsorted(np.sort(held), np.arange(1, to - at))
            parts += [np.unique(part) for part in np.split(found[np.argsort(held, kind="stable")], borders)]
        ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
        values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        return {"tokens": pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))}

    found = with_text_columns(sample, "text", kernel, {"tokens": "array<long>"})
    counted = found.select("row.toxic", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n")
    )
    weight = F.log((F.col("p") + 0.5) / (toxic + 1)) - F.log((F.col("n") + 0.5) / (clean + 1))
    sure = weight - 1.64 * F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("n") + 0.5))
    often = (F.col("p") >= max(3.0, SUPPORT * toxic)) & (F.col("sure") > 1)
    best = counted.withColumn("sure", sure).where(often).orderBy(F.desc("sure"), "token").limit(LEXICON)
    insults = {int(h): INSULT_WEIGHT for h in _hash_of(INSULTS.split())}
    return Lexicon.of(insults | {r["token"] % (1 << 64): r["sure"] + 1 for r in best.collect()})


def learned(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str = "toxic") -> Model | float:
    """The model, or the share of toxic labels where there is too little to learn from."""
    known = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic is not null").where(~held_out("doc_id"))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = known.join(docs.select(F.col(f"`{doc_id}`").alias("doc_id")).distinct(), "doc_id", "left_semi")
    counts = {0: 0, 1: 0} | {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(counts.values()) < FEWEST:
        return counts[1] / max(1, sum(counts.values()))
    share = shares(counts, SAMPLE)
    # At most SAMPLE rows of an id and two numbers, one per id.
    near = known.where(share_of_hash(SEED, "doc_id") < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    most = F.when(F.col("toxic") == 1, round(share[1] * counts[1])).otherwise(round(share[0] * counts[0]))
    in_order = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id"))
    chosen = near.withColumn("place", in_order).where(F.col("place") <= most).drop("place")
    sample = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    sample = sample.join(F.broadcast(_in_parts(chosen)), "doc_id")
    # Of an id that repeats one text is learned from, the first by hash.
    sample = sample.groupBy("doc_id", "toxic", "part").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    lexicon = _lexicon(sample.where("part = 0"))
    found = _with_features(sample.where("part > 0"), "text", lexicon).select("row.doc_id", "row.toxic", "row.part", "features")
    table = found.toArrow().to_pandas().sort_values("doc_id")
    x = np.stack(table["features"])
    y, part = table["toxic"].to_numpy(dtype=float), table["part"].to_numpy()
    # The label that is sampled less thinly has the weight 1.
    weight = np.where(y == 1, max(share.values()) / share[1], max(share.values()) / share[0])
    trees = grow(x[part == 1], y[part == 1], weight[part == 1])
    return Model(lexicon, trees, *isotonic(trees.raw(x[part == 2]), y[part == 2], weight[part == 2]))


def _in_parts(chosen: DataFrame) -> DataFrame:
    """``chosen`` with a part from 0 to 2, each having a third of each label's documents."""
    table = chosen.withColumn("part", F.xxhash64(F.lit(SEED + 1), "doc_id")).toArrow().combine_chunks()
    toxic, order = table["toxic"].to_numpy(), table["part"].to_numpy()
    part = np.zeros(len(toxic), dtype=np.int32)
    for label in (0, 1):
        rows = np.flatnonzero(toxic == label)
        part[rows[np.argsort(order[rows], kind="stable")]] = np.arange(len(rows)) % 3
    parts = table.set_column(table.schema.get_field_index("part"), "part", pa.array(part))
    return chosen.sparkSession.createDataFrame(parts)


def _with_features(df: DataFrame, text: str, lexicon: Lexicon) -> DataFrame:
    def kernel(texts: pa.Array) -> dict[str, pa.Array]:
        found = features(texts, lexicon)
        ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES))
        return {"features": pa.ListArray.from_arrays(ends, pa.array(found.ravel()))}

    return with_text_columns(df, text, kernel, {"features": "array<double>"})


def scored(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """Per document doc_id, held_out, score and predicted."""
    model = learned(docs, labels, doc_id, text, label)
    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), held_out(doc_id).alias("held_out")
    )
    if isinstance(model, Model):
        def kernel(texts: pa.Array) -> dict[str, pa.Array]:
            return {"score": pa.array(model.score(features(texts, model.lexicon)))}

        found = with_text_columns(narrow, "text", kernel, {"score": "double"}).select("row.doc_id", "row.held_out", "score")
    else:
        found = narrow.select("doc_id", "held_out", F.lit(float(model)).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
