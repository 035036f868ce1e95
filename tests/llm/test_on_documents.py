"""The registered corpus queries over ``documents`` against brute force, and every operator and stage on an odd table."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from starledger.llm import langid, minhash, mixing, packing, pii, quality, secretscan, sharding, toxicity
from starledger.llm.queries import QUERIES, TOKEN_LIMIT, tokenizer_path
from starledger.session import materialised
from tests.llm.helpers import (
    ODD_TEXTS, WORD, cycled_weights, documents, pii_spans, prose, quality_counts, secret_spans, shingles, targets,
)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def table(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def run(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


def sha(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def is_held_out(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 == 0


def test_op1_base_columns(spark, table):
    rows = run(spark, "op1_pii")
    assert len(rows) == len(table)
    for r in rows:
        spans = pii_spans(table[r.doc_id].text)
        kinds = Counter(s.split(":")[0] for s in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in ("email", "ip", "card", "phone"))
        assert r.base_sha256 == sha(spans) and set(spans) <= set(r.spans.split(","))
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows)


def test_op10_base_columns(spark):
    sf_dir = "/root/testdata/sf0.01"
    table = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op10_markov_secrets"](spark, sf_dir).collect()
    assert len(rows) == len(table)
    for r in rows:
        spans = secret_spans(table[r.doc_id].text)
        kinds = Counter(s.split(":")[0] for s in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds[k] for k in ("assign", "access", "hex"))
        assert r.base_sha256 == sha(spans) and set(spans) <= set(r.spans.split(","))
    assert sum(r.n_assign + r.n_access + r.n_hex for r in rows)


def test_op5_sizes_and_places(spark, table):
    rows = run(spark, "op5_virtual_slot_sharding")
    places, after = defaultdict(list), defaultdict(list)
    for r in rows:
        body = (table[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(body) + 8, zlib.crc32(body), "bytes", None)
        assert 0 <= r.shard < 24 and 0 <= r.next_shard < 25 and (r.map_version, r.next_version) == (1, 2)
        places[r.shard].append(r.slot)
        after[r.next_shard].append(r.next_place)
    assert len(rows) == len(table)
    assert all(sorted(p) == list(range(len(p))) for held in (places, after) for p in held.values())


def test_op6_sums(spark, table):
    rows = run(spark, "op6_mix_min_cost_flow")
    size = {n: len(WORD.findall(r.text or "")) for n, r in table.items()}
    total, taken = defaultdict(int), defaultdict(int)
    for n, r in table.items():
        total[r.source] += size[n]
    goal = targets(dict(total), cycled_weights(total), sum(size.values()))
    for r in rows:
        source = table[r.doc_id].source
        assert (r.size, r.source_size, r.target) == (size[r.doc_id], total[source], goal[source])
        assert r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
        taken[source] += r.taken
    assert len(rows) == len(table)
    # The longest documents of a source of few of them leave a gap.
    assert all(abs(taken[s] - goal[s]) <= 0.05 * goal[s] + 50 for s in goal)


def check_packed(rows, texts_by_id, tokenizer, capacity=2048):
    """Pieces of each text (a list of texts per id, for ids that repeat) and the sequences they lie in."""
    pieces, sequences = defaultdict(Counter), defaultdict(list)
    for r in rows:
        pieces[r.doc_id][r.piece, r.start, r.length, r.ids_crc32] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    expected = defaultdict(Counter)
    for doc_id, texts in texts_by_id.items():
        for text in texts:
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
            cuts = packing.cut(len(ids), capacity)
            expected[doc_id].update((n, a, k, zlib.crc32(ids[a : a + k].tobytes())) for n, (a, k) in enumerate(cuts))
    assert pieces == expected
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity


def test_op9_ids(spark, table, tokenizer):
    check_packed(run(spark, "op9_best_fit_packing"), {n: [r.text] for n, r in table.items()}, tokenizer)


def test_op13_counts(spark, table, tokenizer):
    rows = run(spark, "op13_prefix_token_counts")
    assert len(rows) == len(table)
    for r in rows:
        text = table[r.doc_id].text or ""
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), len(ids), len(ids) > TOKEN_LIMIT)
        cut = tokenizer.encode(text[: r.cut_chars], add_special_tokens=False).ids
        assert len(cut) == r.cut_tokens <= TOKEN_LIMIT and (r.over_limit or r.cut_chars == len(text))


def test_op2_tells_held_out_languages(spark, table):
    rows = run(spark, "op2_bigru_language")
    assert len(rows) == len(table) and all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    judged = [r.lang_pred == table[r.doc_id].lang for r in rows if r.held_out and table[r.doc_id].lang and any(map(str.isalpha, table[r.doc_id].text or ""))]
    assert len(judged) > 20 and sum(judged) >= 0.9 * len(judged)


def test_op8_ranks_held_out_toxic_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = QUERIES["op8_toxicity_trees"](spark, sf_dir).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    bad = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 1]
    good = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 0]
    above = sum((b > g) + (b == g) / 2 for b in bad for g in good)
    assert bad and good and above >= 0.95 * len(bad) * len(good)


# A table with missing and repeated ids, rows that repeat, odd texts, and one of five million characters whose finds lie at its end.

KEY = "f0ddae3b09ae356cbefecdd3232fa5489bb400d6"


@pytest.fixture(scope="module")
def odd(spark):
    made = random.Random(17)
    words = prose(1, 21, 4000)[0].split()
    long = " ".join(made.choices(words, k=800_000)) + f" mail x@y.org or 4111111111111111 and token = \"{KEY}\""
    assert len(long) > 5_000_000
    plain = prose(40, 23, 40)
    texts = [*plain, plain[0], plain[0], plain[0], plain[1], *ODD_TEXTS, long, "a <|endoftext|> b", None]
    ids = [*range(40), 0, 0, None, None, *range(100, 100 + len(ODD_TEXTS)), 7, None, None]
    langs = ["en", "de"] * (len(texts) // 2) + ["en"] * (len(texts) % 2)
    docs = documents(spark, texts, doc_id=ids, lang=langs, source=[f"s{n % 4}" if n % 9 else None for n in range(len(texts))])
    # Exact repeated rows too.
    rows = list(zip(ids, texts)) + list(zip(ids, texts))[:5]
    return materialised(docs.union(docs.where("doc_id < 5 AND n_chars > 0").dropDuplicates(["doc_id"])), "odd").repartition(3), rows


def by_row(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_odd_rows_of_op1(odd):
    docs, rows = odd
    found = pii.found(docs).select("doc_id", pii.digest("base").alias("b")).collect()
    assert by_row((r.doc_id, r.b) for r in found) == by_row((i, ",".join(pii_spans(t))) for i, t in rows)


def test_odd_rows_of_op10(odd):
    docs, rows = odd
    found = secretscan.found(docs).select("doc_id", secretscan.digest("base").alias("b")).collect()
    assert by_row((r.doc_id, r.b) for r in found) == by_row((i, ",".join(secret_spans(t))) for i, t in rows)


def test_odd_rows_of_op4(odd):
    docs, rows = odd
    found = quality.judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert by_row(map(tuple, found)) == by_row((i, *quality_counts(t)) for i, t in rows)


def test_odd_rows_of_op2(odd, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 20)
    docs, rows = odd
    found = langid.identified(docs).collect()
    assert by_row((r.doc_id, r.held_out) for r in found) == by_row((i, is_held_out(i)) for i, _ in rows)
    assert {r.lang_pred for r in found} <= {"en", "de", "und"}
    assert sum(r.lang_pred == "und" for r in found) == sum(not any(c.isalpha() for c in t or "") for _, t in rows)


def test_odd_rows_of_op8(spark, odd):
    docs, rows = odd
    labels = spark.createDataFrame([(n, n % 2) for n in range(40)] + [(None, 1), (3, None), (7, 1)], "doc_id long, toxic int")
    found = toxicity.scored(docs, labels).collect()
    assert by_row((r.doc_id, r.held_out) for r in found) == by_row((i, is_held_out(i)) for i, _ in rows)
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_rows_of_op5(odd):
    docs, rows = odd
    found = sharding.sharded(docs, 5, slots=64, then=6).collect()
    sizes = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows]
    assert by_row((r.doc_id, r.size, r.text_crc32) for r in found) == by_row(sizes)
    places = defaultdict(list)
    for r in found:
        places[r.shard].append(r.place)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_odd_rows_of_op6(odd):
    docs, rows = odd
    found = mixing.mixed(docs).collect()
    assert by_row((r.doc_id, r.size) for r in found) == by_row((i, len(WORD.findall(t or ""))) for i, t in rows)
    assert all(r.taken == r.copies * r.size <= 3 * r.size for r in found)
    assert mixing.expanded(docs).count() == sum(r.copies for r in found)


def test_odd_rows_of_op7(odd):
    docs, rows = odd
    found = minhash.near_duplicates(docs, words=3, percent=85).collect()
    assert by_row((r.doc_id, r.n_shingles) for r in found) == by_row((i, len(shingles(t, 3))) for i, t in rows)
    # Rows of one text share the smallest of their ids.
    assert {r.component_id for r in found if r.doc_id == 0} == {0} and {r.component_id for r in found if r.doc_id == 1} == {1}


def test_odd_rows_of_op9(odd, tokenizer):
    docs, rows = odd
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    check_packed(packing.packed(docs, tokenizer_path()).collect(), texts, tokenizer)


def test_odd_rows_in_the_pipeline(spark, odd, tokenizer):
    docs, rows = odd
    given = Counter(rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialised(stage(spark, docs, ""), name)
        if name == "pack":
            texts = defaultdict(list)
            for r in before.collect():
                texts[r.doc_id].append(r.text)
            check_packed(docs.collect(), texts, tokenizer)
            break
        assert docs.columns == columns
        kept = Counter((r.doc_id, r.text) for r in docs.collect())
        if name == "quality":
            assert not kept - given
            assert all(kept[n, t] == given[n, t] for n, t in given if t and len(quality_words(t)) > 30 and len(t) < 1000 and clean(t))
        elif name == "near_dedup":
            assert max(Counter(t for _, t in kept.elements()).values()) == 1 and (0, rows[0][1]) in kept
        elif name == "pii":
            assert all(not pii_spans(t) for _, t in kept) and any("[EMAIL]" in t for _, t in kept)
        else:
            assert kept and max(kept.values()) <= 3


def quality_words(text):
    return WORD.findall(text)


def clean(text):
    """No rule of quality speaks against the text."""
    n_words, _, symbols, again, repeated = quality_counts(text)
    words = quality_words(text)
    return not symbols and not again and not repeated and text.islower() and sum(a == b for a, b in zip(words, words[1:])) < n_words / 4
