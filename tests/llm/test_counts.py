"""Spelling groups, the manifest and token counts against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starledger.llm import merkle, spelling, tokencounts
from starledger.llm.queries import tokenizer_path
from starledger.session import materialised
from tests.llm.helpers import ODD_TEXTS, documents, empty, manifest, one_edit, prose, spelling as brute_spelling

COLUMNS = "doc_id", "source", "lang", "n_chars", "text"


def variants(seed=3):
    """Texts of words and their misspellings, with accents, long words and runs of one letter."""
    made = random.Random(seed)
    words = ["".join(made.choice("abeé×ÿ") for _ in range(made.randint(4, 8))) for _ in range(40)]
    words += ["x" * 70, "x" * 69 + "y", "x" * 71, "ab" * 40, "ab" * 40 + "c", "aaaaa", "aaaaaa", "aaaaaaa"]

    def changed(w):
        k = made.randrange(len(w))
        return made.choice([w[:k] + w[k + 1 :], w[:k] + made.choice("abé") + w[k + 1 :], w[:k] + made.choice("abÿ") + w[k:], w.upper()])

    pool = []
    for n, word in enumerate(words):
        pool += [word] * (60 // (n % 7 + 1))
        for _ in range(6):
            near = changed(word)
            pool += [near] * made.choice([2, 3, 5, 9]) + [changed(near)] * 3
    made.shuffle(pool)
    rows = [(made.choice([n, None, n]), made.choice([" ", "9", "_\n"]).join(pool[n : n + 20])) for n in range(0, len(pool), 20)]
    return rows + [(1, None), (2, ""), (3, "the cat sat"), (4, " ".join(["Wörter"] * 500))]


@pytest.mark.parametrize("small", [False, True])
def test_spelling_groups_match_brute_force(spark, monkeypatch, small):
    if small:
        # A slice of filters for every block, and edits a few at a time.
        for name, value in (("FILTER_BYTES", 1), ("CHUNK_BYTES", 1024), ("EDITS", 50)):
            monkeypatch.setattr(spelling, name, value)
    rows = variants()
    docs = documents(spark, [t for _, t in rows], doc_id=[i for i, _ in rows]).withColumn("word", F.lit(1)).repartition(5)
    found = spelling.grouped(docs)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute_spelling(rows)
    assert sorted(map(tuple, found.collect())) == expected
    assert any(r[1] for r in expected) and any(r[2] != (r[1] or r[0]) for r in expected)


def test_spelling_of_tables_without_words(spark):
    for docs in (empty(documents(spark, ["x"])), documents(spark, [None, "", "one two six", "longer words but once"])):
        assert spelling.grouped(docs).collect() == []


def test_edits_are_all_smaller_neighbours():
    made = random.Random(1)
    alphabet = np.array(sorted(b"abcd"), dtype=np.uint8)
    words = ["".join(made.choice("abcd") for _ in range(6)) for _ in range(40)]
    matrix = np.frombuffer("".join(words).encode(), np.uint8).reshape(len(words), 6)
    found = {(int(r), int(h)) for _, row, hashes in spelling.edits(matrix, alphabet) for r, h in zip(row, hashes)}
    hash_of = lambda w: int(spelling.word_hashes(np.frombuffer(w.encode(), np.uint8)[None, :])[0])
    assert found == {
        (n, hash_of(w[:k] + c + w[k + 1 :])) for n, w in enumerate(words) for k in range(6) for c in ["", *"abcd"] if not c or c > w[k]
    }
    assert one_edit("abc", "abcd") and one_edit("abc", "axc") and not one_edit("abc", "abc") and not one_edit("abc", "xbcd")


def table_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    return docs.select("*", F.lit(1).alias("leaf"), F.lit("x").alias("group"), F.lit(2).alias("rank")).repartition(3)


@pytest.mark.parametrize(("rows", "sources"), [(1, ["a"]), (1, [None]), (40, ["a"]), (700, ["a", "b", None, "ü", ""]), (500, None)])
def test_manifest_matches_brute_force(spark, rows, sources):
    made = random.Random(rows)
    table = []
    for n in range(rows):
        source = f"host{made.randrange(300)}" if sources is None else made.choice([*sources, *sources[:1] * 3])
        text = made.choice([None, "", f"Text A {n}", "lower", "ÀÉ Z", "a|b;c"])
        table.append((made.choice([n, n, n, None, n // 3]), source, made.choice(["en", None, "é"]), made.choice([None, n]), text))
    table += table[: rows // 10]
    found = merkle.verified(table_of(spark, table)).drop("proof").collect()
    assert sorted(map(tuple, found), key=str) == sorted(manifest(table), key=str)


def test_manifest_of_deep_trees(spark):
    """Seven levels with runs of three: rounds double, and pointers of the upper tree are met from below."""
    docs = spark.range(1500).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 4 > 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 90)).alias("source"),
        F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.concat(F.lit("T"), F.col("id")).alias("text"),
    )
    found = materialised(merkle.manifest(docs, fanout=3), "manifest")
    root = found.select("root").distinct().collect()
    assert len(root) == 1 and found.count() == 1500
    folds = found.select(merkle.folded(F.col("leaf"), F.col("proof")).alias("f"), F.size(F.split("proof", ";")).alias("n"))
    assert {r.f for r in folds.collect()} == {root[0].root}
    assert folds.agg(F.max("n")).first()[0] > 8
    wrong = found.select(merkle.folded(F.sha2("leaf", 256), F.col("proof")).alias("f")).distinct()
    assert wrong.where(F.col("f") == root[0].root).count() == 0


def test_manifest_of_an_empty_table(spark):
    assert merkle.verified(empty(documents(spark, ["x"]))).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


ATOMS = [
    "don't", "we're", " 're", "'ll", "'l", "'v", "'ve ", "\n", "\n\n", "  ", "   \t", " ", "\x1c", "\x85", " ", " ", "é",
    "ñandú", "日本語", "😀", "ª", "²", "1234", " 99", "!!", "<|endoftext|>", "<|endoftext", "|>", " word", "Hello", "====",
    "--------", "_", "'", "''", "\U0003fc3b", "՘", "࢏", "á", "‍", "हिन्दी", "x" * 30, " " * 20, "thththon", "\r\n", "’s",
]


def length(tokenizer, text):
    return len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_counts_of_all_prefixes(tokenizer):
    made = random.Random(5)
    counter = tokencounts.PrefixCounter(tokenizer_path())
    texts = ["".join(made.choices(ATOMS, k=made.randint(0, 12))) for _ in range(400)]
    for text, steps in zip(texts, counter.steps(texts)):
        expected = [length(tokenizer, text[:n]) for n in range(1, len(text) + 1)]
        assert np.cumsum(steps, dtype=np.int64).tolist() == expected


def test_characters_are_classed_as_the_library_does(tokenizer):
    counter = tokencounts.PrefixCounter(tokenizer_path())
    characters = [chr(c) for c in [*range(0x3000), *range(0x3000, 0x110000, 331)] if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{c}1{c}!{c} x{c}  {c}" for c in characters]
    expected = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [int(s.sum()) for s in counter.steps(texts)] == expected


def test_long_texts_are_counted_in_windows(tokenizer, monkeypatch):
    monkeypatch.setattr(tokencounts, "WINDOW", 50)
    made = random.Random(9)
    counter = tokencounts.PrefixCounter(tokenizer_path())
    texts = ["".join(made.choices(ATOMS, k=200)) for _ in range(10)] + ["y" * 3000, " " * 700 + "z"]
    assert [int(s.sum()) for s in counter.steps(texts)] == [length(tokenizer, t) for t in texts]


def tables(spark, texts, **columns):
    docs = documents(spark, texts, **columns).withColumn("steps", F.lit(1)).withColumn("n_bytes", F.lit("clash"))
    return materialised(tokencounts.prefix_tables(docs.repartition(4), tokenizer_path()), "tables")


def test_stored_tables_answer_truncations_and_positions(spark, tokenizer):
    made = random.Random(2)
    texts = [*ODD_TEXTS, *prose(20), *["".join(made.choices(ATOMS, k=30)) for _ in range(40)], "=" * 64 + "a"]
    stored = tables(spark, texts)
    rows = {r.doc_id: r for r in stored.collect()}
    assert len(rows) == len(texts)
    counts = {n: [0, *[length(tokenizer, (t or "")[:k]) for k in range(1, len(t or "") + 1)]] for n, t in enumerate(texts) if len(t or "") < 700}
    for n, text in enumerate(texts):
        text = text or ""
        assert (rows[n].n_bytes, rows[n].n_chars, rows[n].n_tokens) == (len(text.encode()), len(text), length(tokenizer, text))
    for limit in (-1, 0, 1, 7, 20):
        for r in tokencounts.truncations(stored, limit).collect():
            if r.doc_id in counts:
                fitting = [k for k, c in enumerate(counts[r.doc_id]) if c <= max(limit, 0)]
                assert (r.cut_chars, r.cut_tokens) == (fitting[-1], counts[r.doc_id][fitting[-1]])
    whole = tokencounts.truncations(stored, F.lit(None)).collect()
    assert all(r.cut_chars == r.n_chars and r.cut_tokens == r.n_tokens for r in whole)
    for r in tokencounts.counts_at(stored, F.col("doc_id") - 3).collect():
        if r.doc_id in counts:
            assert r.position == min(max(r.doc_id - 3, 0), r.n_chars) and r.tokens_before == counts[r.doc_id][r.position]


@pytest.mark.parametrize("block", [10_000, 7])
def test_a_budget_pays_for_documents_in_order(spark, tokenizer, monkeypatch, block):
    monkeypatch.setattr(tokencounts, "BLOCK", block)
    texts = [t + " x" * n for n, t in enumerate(prose(40, 6, 9))] + ["", None]
    stored = tables(spark, texts)
    sizes = [length(tokenizer, t or "") for t in texts]
    for budget in (-1, 0, 1, 50, sum(sizes[:20]), sum(sizes[:20]) + 5, sum(sizes) - 1, sum(sizes), 10**6):
        rows = sorted(tokencounts.within_budget(stored, budget).collect())
        left, expected = budget, []
        for n, text in enumerate(texts):
            if sizes[n] > left:
                if left > 0:
                    cut = max(k for k in range(len(text) + 1) if length(tokenizer, text[:k]) <= left)
                    expected += [(n, cut)] if cut else []
                break
            expected.append((n, len(text or "")))
            left -= sizes[n]
        if budget < 0:
            expected = []
        assert [(r.doc_id, r.cut_chars) for r in rows] == expected
        assert sum(r.cut_tokens for r in rows) <= max(budget, 0)


def test_counts_of_an_empty_table_and_of_odd_ids(spark):
    nothing = empty(documents(spark, ["x"]))
    assert tokencounts.prefix_tables(nothing, tokenizer_path()).count() == 0
    assert tokencounts.within_budget(tables(spark, ["x"]).limit(0), 5).count() == 0
    rows = tables(spark, ["one", "one", None], doc_id=[None, None, 3]).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in rows) == [(-1, 1), (-1, 1), (3, 0)]


def test_other_vocabularies_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError, match="no plain byte-level"):
        tokencounts.PrefixCounter(public_tokenizers.path("word_bpe_49k.json"))


def test_very_long_texts(spark, tokenizer):
    """Texts of five million characters, with words, without, and of one character."""
    made = random.Random(4)
    words = prose(1, 3, 2000)[0].split()
    texts = [" ".join(made.choices(words, k=900_000)), "".join(made.choices("abcdefgh", k=1_000_000)), "é" * 1_000_000]
    docs = documents(spark, texts)
    rows = {r.doc_id: r for r in tokencounts.prefix_tables(docs, tokenizer_path()).drop("steps").collect()}
    assert len(texts[0]) > 5_000_000
    assert rows[0].n_tokens == length(tokenizer, texts[0])
    assert all(rows[n].n_bytes == len(t.encode()) for n, t in enumerate(texts))
    leaves = {r.key: r.leaf for r in merkle.leaves(docs).collect()}
    from tests.llm.helpers import leaf

    assert leaves == {n: leaf(n, f"src{n % 3}", "en", len(t), t) for n, t in enumerate(texts)}
    docs = documents(spark, [t[:400_000] for t in texts] * 3)
    found = sorted(map(tuple, spelling.grouped(docs).collect()))
    assert found == brute_spelling([(n, t[:400_000]) for n, t in enumerate(texts * 3)])
