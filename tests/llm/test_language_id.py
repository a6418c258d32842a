"""Cross-parsing against plain greedy matching, and languages of held-out texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import common, language_id, suffix_automaton

D = "/root/testdata/sf0.01"


def greedy(text, reference):
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in reference:
            j += 1
        i, n = max(i + 1, j - 1), n + 1
    return n


def test_phrases_are_the_greedy_longest_matches():
    rng = random.Random(4)
    for width in (2, 3, 7):
        refs = [bytes(rng.randrange(width) for _ in range(n)) for n in (1, 30, 400)]
        texts = [b"", *[bytes(rng.randrange(width + 1) for _ in range(rng.randint(1, 90))) for _ in range(60)]]
        sizes = np.array([len(t) for t in texts])
        got = suffix_automaton.Parsers(refs, width + 1).phrases(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes)
        assert got.tolist() == [[greedy(t, r) for r in refs] for t in texts]


def test_automaton_holds_exactly_the_substrings():
    text = bytes([0, 1, 0, 0, 1, 2, 0, 1, 0])
    t = suffix_automaton.automaton(text, 3)
    assert len(t) <= 2 * len(text)

    def has(x):
        s = 0
        for c in x:
            s = t[s, c]
            if s < 0:
                return False
        return True

    every = [bytes(x) for n in range(1, 5) for x in np.ndindex(*[3] * n)]
    assert [has(x) for x in every] == [x in text for x in every]


def test_symbols():
    letters = "abcé"
    sym, starts, sizes = language_id.symbols_of(["Ab 12 c!", "", "  ", "é\n\nB漢", "\U0001F600x", "\U00010400"], letters)
    cut = [sym[a : a + n].tolist() for a, n in zip(starts, sizes, strict=True)]
    assert cut == [[2, 3, 0, 4], [], [], [5, 0, 3, 1], [1], [1]]


@pytest.fixture(scope="module")
def model(spark):
    common.prepare(spark)
    return language_id.fit(spark.read.parquet(f"{D}/documents.parquet"))


def test_bits_follow_from_counts_and_stretches(model):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdeé ñ.") for _ in range(n)) for n in (1, 40, 511, 512, 513, 2000)]
    bits, sizes = language_id.entropies(texts, model)
    sym, starts, _ = language_id.symbols_of(texts, model.letters)
    for k, (a, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
        own = sym[a : a + n].tobytes()
        for j, ref in enumerate(model.references):
            count = sum(greedy(own[i : i + language_id.STRETCH], ref) for i in range(0, n, language_id.STRETCH))
            assert np.isclose(bits[k, j], count * np.log2(len(ref) + 1) / max(n, 1))


def test_held_out_languages(spark, model):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    found = language_id.identify(docs, model).filter(common.fold(F.col("doc_id"), 4) == 2)
    right, n = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.count(F.lit(1))).first()
    assert n > 200 and right > 0.99
    assert found.filter("score < 0 or score > 1").count() == 0


def test_odd_rows(spark, model):
    rows = [(1, None, "own"), (2, "", "own"), (3, "123 !?", "own"), (None, "the of and " * 50_000, "own"), (4, "漢字", "own"), (4, "漢字", "own")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = language_id.identify(df, model)
    assert got.columns == ["doc_id", "text", "score", "lang_pred", "_score"]
    found = [(r.doc_id, r.lang_pred, r["_score"]) for r in got.collect()]
    assert [f for f in found if f[0] in (1, 2, 3)] == [(k, "und", 0.0) for k in (1, 2, 3)]
    assert len(found) == 6 and found[-1] == found[-2] and found[-1][1] in model.languages
    assert [f[1] for f in found if f[0] is None] == ["en"]
    assert language_id.identify(df.limit(0), model).count() == 0
    nothing = language_id.fit(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language_id.identify(df, nothing).collect()} == {"und"}


def test_a_repeated_text_is_taken_once():
    got = language_id.build({"x": ["ab ab", "ab ab", "cd"], "y": ["123", "ef"], "z": ["!"]})
    assert got.languages == ("x", "y") and len(got.references[0]) == len("ab ab cd")
