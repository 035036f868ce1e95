"""Host-level quality rules.

Each document is held against a few rules on its whole text. The failures are added up by host
(the ``source`` of a document), each host's failure rate is shrunk towards the corpus by a beta
prior fitted to the hosts themselves, and the host's verdict is joined back to its documents:

* a *trusted* host (low shrunk rate) keeps documents that fail a single soft rule;
* an *ordinary* host loses every document that fails a rule;
* a *rejected* host (most of its documents fail) loses all of them.

A document that fails a base rule (too few words, too many repeated words) always goes.

Defined cases: a null text is an empty one and fails; a null host is a host of its own; repeated
rows are judged row by row; an empty table gives an empty result; further columns of the input,
whatever their names, are kept by ``keep_good`` and ignored by ``judged``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starledger.llm.arrowtext import (
    LINE_BYTES, WORD_BYTES, hash_runs, mix, owners, slices, windows, with_text_columns,
)
from starledger.operators.skew import KeyProfile, attach
from starledger.session import materialised

MIN_WORDS = 20
REPEAT_WIDTH = 8
REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
#: Shares above which the soft rules fail.
SYMBOLS_PER_WORD = 0.25
CAPITALS_SHARE = 0.4
DUPLICATE_LINES_SHARE = 0.5
STUTTERS_SHARE = 0.5
#: Limits of the shrunk failure rate of a host.
TRUSTED_BELOW = 0.02
REJECTED_FROM = 0.6

COUNTS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_lines": "long",
    "n_dup_lines": "long", "n_repeat_words": "long", "n_capitals": "long",
    "n_stutters": "long",
}

_BYTES = np.arange(256)
_SYMBOL = np.isin(_BYTES, list(SYMBOLS))
_CAPITAL = (_BYTES >= 65) & (_BYTES <= 90)
#: Bytes of words that begin a code point.
_POINT = WORD_BYTES & ((_BYTES & 0xC0) != 0x80)


def _per_text(marks: np.ndarray, offsets: np.ndarray) -> list[int]:
    return [int(np.count_nonzero(marks[a:b])) for a, b in zip(offsets[:-1], offsets[1:])]


def _repeated_words(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Per text, the words that lie in a window of words found twice or more in it."""
    first, found = windows(hashes, owner, REPEAT_WIDTH)
    if not len(first):
        return np.zeros(n, dtype=np.int64)
    keys = mix(found ^ (owner[first].astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes) + 1, dtype=np.int32)
    np.add.at(covered, first[twice], 1)
    np.add.at(covered, first[twice] + REPEAT_WIDTH, -1)
    return np.bincount(owner[np.cumsum(covered[:-1]) > 0], minlength=n)


def _duplicate_lines(data, offsets, word_starts, n) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the lines with a word, and those of them equal to an earlier line."""
    starts, ends, hashes = hash_runs(data, offsets, LINE_BYTES)
    wordy = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    owner, hashes = owners(offsets, starts[wordy]), hashes[wordy]
    lines = np.bincount(owner, minlength=n)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    again = (owner[1:] == owner[:-1]) & (hashes[1:] == hashes[:-1])
    return lines, np.bincount(owner[1:][again], minlength=n)


def count_texts(texts: pa.Array) -> dict[str, pa.Array]:
    """The counts named in ``COUNTS`` of each text."""
    parts: dict[str, list] = {name: [] for name in COUNTS}
    for at, to, data, offsets in slices(texts):
        n = to - at
        starts, _, hashes = hash_runs(data, offsets, WORD_BYTES)
        owner = owners(offsets, starts)
        lines, again = _duplicate_lines(data, offsets, starts, n)
        found = {
            "n_words": np.bincount(owner, minlength=n),
            "word_chars": _per_text(_POINT[data], offsets),
            "n_symbols": _per_text(_SYMBOL[data], offsets),
            "n_lines": lines,
            "n_dup_lines": again,
            "n_repeat_words": _repeated_words(hashes, owner, n),
            "n_capitals": _per_text(_CAPITAL[data], offsets),
            "n_stutters": np.bincount(owner[1:][(hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])], minlength=n),
        }
        for name, values in found.items():
            parts[name].append(np.asarray(values, dtype=np.int64))
    return {k: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64)) for k, v in parts.items()}


def _base_failed() -> Column:
    words = F.col("n_words")
    return (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * words)


def _soft_failures() -> Column:
    rules = [
        F.col("n_symbols") > SYMBOLS_PER_WORD * F.col("n_words"),
        F.col("n_capitals") > CAPITALS_SHARE * F.col("word_chars"),
        F.col("n_dup_lines") > DUPLICATE_LINES_SHARE * F.col("n_lines"),
        F.col("n_stutters") > STUTTERS_SHARE * F.col("n_words"),
    ]
    return sum((r.cast("int") for r in rules), F.lit(0))


def _host(source: str | Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source) if isinstance(source, str) else source), F.lit(""))


def host_verdicts(counted: DataFrame) -> DataFrame:
    """One row per host: rows, failures, the shrunk rate and how many soft failures it is allowed.

    ``counted`` has host, base_failed and soft_failures. The prior is fitted by moments: the
    spread of the host rates beyond what chance gives for hosts of their sizes. Its three
    sums are all that comes to the driver.
    """
    failed = F.col("base_failed") | (F.col("soft_failures") > 0)
    hosts = materialised(
        counted.groupBy("host").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(failed.cast("long")).alias("failures")
        ),
        "hosts",
    )
    rate = F.col("failures") / F.col("rows")
    n, fails, squares, count = hosts.agg(
        F.sum("rows"), F.sum("failures"), F.sum(F.col("rows") * rate * rate), F.count(F.lit(1))
    ).first()
    alpha, beta = _prior(n or 0, fails or 0, squares or 0.0, count)
    shrunk = (F.col("failures") + alpha) / (F.col("rows") + alpha + beta)
    allowed = F.when(F.col("host_rate") >= REJECTED_FROM, -1).when(F.col("host_rate") < TRUSTED_BELOW, 1)
    return hosts.withColumn("host_rate", shrunk).withColumn("allowed", allowed.otherwise(0))


def _prior(n: float, fails: float, squares: float, hosts: int) -> tuple[float, float]:
    """Alpha and beta of the prior; between one and a million documents strong."""
    if not n or fails in (0, n):
        return (0.5, 0.5)
    mean = fails / n
    binomial = mean * (1 - mean)
    spread = max(squares / n - mean * mean - binomial * hosts / n, 1e-9)
    strength = min(max(binomial / spread - 1, 1.0), 1e6)
    return mean * strength, (1 - mean) * strength


def _counted(docs: DataFrame, text: str, source: str) -> DataFrame:
    return (
        with_text_columns(docs, text, count_texts, COUNTS)
        .withColumn("host", _host(F.col("row")[source]))
        .withColumn("base_failed", _base_failed())
        .withColumn("soft_failures", _soft_failures())
    )


def _with_verdict(counted: DataFrame, hosts: DataFrame, keys: DataFrame) -> DataFrame:
    """``keys`` has the host of every row and is cheap to read; many hosts make a shuffled join that asks for it."""
    kept = ~F.col("base_failed") & (F.col("soft_failures") <= F.col("allowed"))
    verdicts = hosts.select("host", "host_rate", "allowed")
    return attach(counted, verdicts, "host", profile=KeyProfile(keys, "host")).withColumn("kept", kept)


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per document its counts, ``base_failed``, the host's shrunk rate and ``kept``.

    The narrow counts are written once: the hosts are summed from them and joined back.
    """
    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{source}`").cast("string").alias("source")
    )
    counted = _counted(narrow, "text", "source")
    counted = materialised(
        counted.select(F.col("row.doc_id").alias("doc_id"), "host", *COUNTS, "base_failed", "soft_failures"),
        "counts",
    )
    return _with_verdict(counted, host_verdicts(counted), counted).select(
        "doc_id", *COUNTS, "base_failed", "soft_failures", "host_rate", "kept"
    )


def keep_good(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The texts are read twice, for the hosts and for the filter, rather than written in between.
    """
    hosts = host_verdicts(_counted(docs.select(f"`{text}`", f"`{source}`"), text, source))
    keys = docs.select(_host(F.col(f"`{source}`")).alias("host"))
    return _with_verdict(_counted(docs, text, source), hosts, keys).where("kept").select("row.*")
