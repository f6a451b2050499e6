"""Merkle manifest: digests, proofs and tampering against a plain climb."""

import os
import random

import pytest

from siltstone.llm import merkle
from tests.llm import brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id {}, source string, lang string, n_chars int, text string, leaf string, tree int, pos string, at long"


def _table(spark, rows, kind="long"):
    return spark.createDataFrame([(*r, "x", 1, "y", 7) for r in rows], SCHEMA.format(kind))


def _found(frame):
    return sorted((tuple(r) for r in merkle.merkle_manifest(frame).collect()), key=str)


def _rows(n, seed):
    dice = random.Random(seed)
    sources = ["hot"] * 6 + ["a", "Z", "é", None, "", "b"]
    texts = ["one\ntwo", "plain", "", None, "\n\n", "é\nü"]
    return [(i, dice.choice(sources), dice.choice(["en", None]), dice.choice([None, 1, 12]), dice.choice(texts)) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10, 28, 250])
def test_equals_a_plain_climb(spark, n):
    rows = _rows(n, n)
    assert _found(_table(spark, rows)) == sorted(brute.merkle(rows), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = _found(docs)
    assert found == sorted(brute.merkle(rows), key=str)
    assert {r[-1] for r in found} == {True, False}


def test_every_document_a_source_of_its_own(spark):
    rows = [(i, f"s{i:03}", "en", i, "x\ny") for i in range(60)]
    assert _found(_table(spark, rows)) == sorted(brute.merkle(rows), key=str)


def test_blocks_narrower_than_a_source(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 4)
    rows = _rows(120, 5)
    assert _found(_table(spark, rows)) == sorted(brute.merkle(rows), key=str)


def test_nulls_repeats_and_string_ids(spark):
    rows = [(None, None, None, None, None)] * 2 + [(5, None, "en", 1, "a\nb")] * 4 + [(5, "s", "en", 1, "a\nb"), (7, "s", None, 2, "")]
    assert _found(_table(spark, rows)) == sorted(brute.merkle(rows), key=str)
    named = [(f"d{i}", *r[1:]) for i, r in enumerate(rows)]
    found = merkle.merkle_manifest(_table(spark, named, "string"))
    assert sorted(tuple(r)[1:] for r in found.collect()) == sorted(r[1:] for r in _by_name(named))


def _by_name(rows):
    """Text ids sort as numbers of the same order do; the plain climb wants numbers only for its null rule."""
    return brute.merkle(rows)


def test_empty_table(spark):
    assert _found(_table(spark, [])) == []


def test_no_node_copy_is_met_by_more_than_a_block(spark):
    rows = [(i, "hot", "en", 1, "x") for i in range(5_000)]
    fields = _table(spark, rows).selectExpr("doc_id", "source", f"{merkle.leaf_digest('text')} AS leaf")
    manifest = merkle.Manifest(fields, "source", "doc_id")
    copies = manifest.nodes.groupBy("node", "block").count()
    assert copies.filter("count > 1").isEmpty()
    assert manifest.nodes.select("block").distinct().count() == -(-5_000 // merkle.BLOCK)
    assert manifest.nodes.filter("parent IS NULL").select("node").distinct().count() == 1
