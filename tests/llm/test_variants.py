"""Spelling variants against comparing all words."""

import os
import random

import numpy as np
import pytest

from siltstone.llm import variants
from tests.llm import brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _found(frame, **given):
    return sorted((tuple(r) for r in variants.spelling_variants(frame, **given).collect()), key=str)


def _rows(n, seed):
    dice = random.Random(seed)
    words = ["analysis", "Straßen", "éclairé", "committee", "aaaaaaaa", "übermaß", "pattern"]

    def varied(word):
        at, kind = dice.randrange(len(word)), dice.randrange(12)
        letter = dice.choice("abcéÿ")
        return {0: word[:at] + letter + word[at + 1 :], 1: word[:at] + letter + word[at:], 2: word[:at] + word[at + 1 :]}.get(kind, word)

    return [(i, " ".join(varied(dice.choice(words)) for _ in range(40)) + " x1y×÷ short") for i in range(n)]


@pytest.mark.parametrize("symbols", [8, 2])
def test_equals_comparing_all_words(spark, documents, symbols):
    rows = _rows(60, symbols)
    found = _found(documents(rows), symbols=symbols)
    assert found == sorted(brute.word_variants(rows), key=str)
    assert sum(r[1] is not None for r in found) > 10


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert _found(docs) == sorted(brute.word_variants(rows), key=str)


def test_forms_are_followed_to_the_last(spark):
    chain = {"abcdefgh": 2, "abcdefghi": 30, "abcdefghij": 400, "abcdefghijk": 5000, "abcdefghijkl": 60000}
    rows = [(None, " ".join([word] * n)) for word, n in chain.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    roots = {r.word: r.root for r in variants.spelling_variants(docs).collect()}
    # The hash may shorten a word wherever it stands; what is left must lead to the top.
    assert set(roots.values()) <= {"abcdefghijkl"} | set(roots) and len(roots) >= 4
    assert _found(docs) == sorted(brute.word_variants(rows), key=str)


def test_nulls_empty_repeats_and_text_ids(spark, documents):
    rows = [(None, "Pattern pattern"), (1, None), (2, ""), (3, "patterns patterns"), (3, "patterns patterns"), (4, "PATTERN ÀÀÀÀÀÀÀ")]
    assert _found(documents(rows)) == sorted(brute.word_variants(rows), key=str)
    assert _found(documents([])) == []
    named = [(f"d{i}", t) for i, (_, t) in enumerate(rows)]
    assert _found(documents(named, "string")) == sorted(brute.word_variants(named), key=str)


def test_very_long_word(spark, documents):
    long = "ab" * 30_000
    rows = [(1, f"{long} {long}"), (2, f"{long}c {long}c"), (3, f"{long}c"), (5, "a" * 200_000)]
    assert _found(documents(rows)) == sorted(brute.word_variants(rows), key=str)


def test_neighbourhoods_are_full():
    matrix = np.array([[0, 1, 1, 2], [2, 2, 2, 2]], np.uint64)
    found = {}
    for rows, hashes in variants._edits(matrix, 3):
        for row, value in zip(rows.tolist(), hashes.tolist(), strict=True):
            found.setdefault(row, []).append(value)
    for row, word in enumerate(matrix.tolist()):
        expected = {tuple(word)} | {tuple(word[:i] + word[i + 1 :]) for i in range(4)}
        expected |= {tuple(word[:i] + [c] + word[i + 1 :]) for i in range(4) for c in range(word[i] + 1, 3)}
        hashed = []
        for edited in expected:
            symbols = np.array([edited], np.uint64)
            hashed.append(int(next(variants._edits(symbols, 3))[1][0]))
        assert sorted(found[row]) == sorted(hashed)
