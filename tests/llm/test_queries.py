"""The registered queries, and the pipeline against plain forms of its stages."""

import os
import random
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from siltstone.llm import toxicity
from siltstone.llm.catalog import ORACLES, QUERIES
from tests.llm.brute import near_components
from tests.test_oracle import _sorted_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, oracle, name):
    actual = QUERIES[name](spark, SF_DIR)
    expected = oracle.execute(ORACLES[name])
    names = [column[0] for column in expected.description]
    assert sorted(actual.columns) == sorted(names)
    assert _sorted_rows(actual.columns, actual.collect()) == _sorted_rows(names, expected.fetchall())


def test_each_operator_has_its_query():
    assert {name.split("_")[0] for name in QUERIES} >= {f"op{n}" for n in range(1, 14)}


def test_pipeline_keeps_what_the_stages_should(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).collect() if r.predicted}
    rows = [(d, t) for d, t in rows if d not in toxic]
    largest = {}
    for doc, text in rows:
        largest[text] = max(doc, largest.get(text, -1))
    rows = [(d, t) for d, t in rows if largest[t] == d]
    near = near_components(rows)
    rows = [(d, t) for d, t in rows if near[d][1] == d]
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in found} == {d for d, _ in rows}
    assert len(corpus_pipeline.STAGES) == 5
    packed = sum(r.length for r in found)
    assert len({r.sequence_id for r in found}) <= packed / 4096 * 1.05 + 2
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_return_the_columns_they_get(spark, documents):
    docs = documents([(1, "a token = abcdefgh b"), (2, None), (3, "x"), (3, "x"), (None, "x"), (4, "y")]).withColumnRenamed("part", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns[:2] == ["doc_id", "text"] and len(docs.columns) == 8, name
    kept = {(r.doc_id, r.text) for r in docs.collect()}
    assert kept == {(1, "a [secret] b"), (2, None), (3, "x"), (None, "x"), (4, "y")}


def test_different_texts_of_one_id_all_stay(spark, documents):
    rows = [(1, "a"), (1, "b"), (1, "b"), (2, "b"), (3, None), (3, "c"), (3, "c"), (3, ""), (None, "a")]
    docs = documents(rows)
    found = corpus_pipeline.exact_dedup(spark, docs, SF_DIR)
    assert found.columns == docs.columns
    kept = sorted(((r.doc_id, r.text or "") for r in found.collect()), key=str)
    assert kept == sorted([(1, "a"), (2, "b"), (3, ""), (3, "c"), (None, "a")], key=str)


def test_near_dedup_tells_texts_of_one_id_apart(spark, documents):
    rng = random.Random(4)
    one, other = (" ".join(rng.choice("abcdefgh") + rng.choice("aeiou") + str(i) for i in range(80)) for _ in range(2))
    docs = documents([(1, one), (5, one + " x"), (5, other), (None, one), (7, None)])
    found = corpus_pipeline.near_dedup(spark, docs, SF_DIR)
    assert found.columns == docs.columns
    assert {(r.doc_id, r.text) for r in found.collect()} == {(1, one), (5, other), (None, one), (7, None)}


@pytest.mark.parametrize("extra", [["_id", "_sha"], ["sha", "kept_id", "kept_sha", "near_key", "gone_key", "_near_key"]])
def test_stages_take_any_extra_columns(spark, extra):
    rows = [(1, "a b c", *["x"] * len(extra)), (2, "a b c", *["y"] * len(extra)), (3, None, *["z"] * len(extra))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in extra))
    for stage in (corpus_pipeline.exact_dedup, corpus_pipeline.near_dedup):
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == ["doc_id", "text", *extra]
        assert sorted(tuple(r)[:3] for r in docs.collect()) == [(2, "a b c", "y"), (3, None, "z")]
