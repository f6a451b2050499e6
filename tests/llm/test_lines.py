"""Line dedup by levelled runs against plain counting."""

import os
import random

import pytest
from pyspark.sql import functions as F

from siltstone.llm import lines
from tests.llm import brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LICENSE = "this line stands in very many documents"


def _found(frame, **given):
    found = lines.drop_repeated_lines(frame, **given)
    return sorted((tuple(r) for r in found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()), key=str)


def _rows(n, seed):
    dice = random.Random(seed)
    pool = [f"line number {i} of a pool of lines" for i in range(40)] + ["short", "", "  ", "nineteen characters"]
    pool += [LICENSE, LICENSE.upper(), f"\t {LICENSE}\r", "twenty characters é.", "TWENTY CHARACTERS É."]
    return [(i, dice.choice([None, ""]) if i % 17 == 0 else "\n".join(dice.choices(pool, k=dice.randrange(9)))) for i in range(n)]


@pytest.mark.parametrize("batches, fanout", [(8, 4), (1, 2), (7, 2)])
def test_equals_plain_counting(spark, documents, batches, fanout):
    rows = _rows(200, batches)
    found = _found(documents(rows), batches=batches, fanout=fanout)
    assert found == sorted(brute.kept_lines(rows), key=str)
    assert sum(r[2] for r in found) > 100


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in lines.line_report(docs).collect()), key=str) == sorted(brute.kept_lines(rows), key=str)


def test_ids_that_are_null_repeat_or_are_texts(spark, documents):
    one, two = "a line of more than twenty", "another line of more than twenty"
    rows = [(None, f"{one}\n{one}"), (None, two), (4, f"{one}\nx"), (4, f"{one}\nx"), (4, f"{two}\n{one}"), (2, two)]
    assert _found(documents(rows)) == sorted(brute.kept_lines(rows), key=str)
    nobody = [(None, one), (None, one), (None, one)]
    assert _found(documents(nobody)) == sorted(brute.kept_lines(nobody), key=str)
    named = [(f"d{i}", t) for i, (_, t) in enumerate(rows)]
    assert _found(documents(named, "string")) == sorted(brute.kept_lines(named), key=str)


def test_empty_table_and_long_text(spark, documents):
    assert _found(documents([])) == []
    long = "\n".join(f"line {i % 5000} of one very long text" for i in range(50_000))
    rows = [(1, long), (2, long), (3, long + "\nend")]
    assert _found(documents(rows)) == sorted(brute.kept_lines(rows), key=str)


def test_runs_hold_each_line_once_and_are_merged(spark):
    runs = lines.LineRuns(spark, fanout=2)
    first = spark.createDataFrame([(b"a", 9), (b"b", 9), (b"a", 8)], "hash binary, doc_id long")
    assert {(r.hash, r.keeper, r.n) for r in runs.add(first).collect()} == {(b"a", 9, 2), (b"b", 9, 1)}
    second = spark.createDataFrame([(b"b", 7), (b"c", 7)], "hash binary, doc_id long")
    assert {(bytes(r.hash), r.keeper, r.n) for r in runs.add(second).collect()} == {(b"c", 7, 1)}
    assert [len(level) for level in runs.levels] == [0, 1]
    third = spark.createDataFrame([(b"c", 5), (b"b", 4)], "hash binary, doc_id long")
    assert runs.add(third).isEmpty()
    assert {(bytes(r.hash), r.keeper, r.n) for r in runs.entries().collect()} == {(b"a", 9, 2), (b"b", 9, 1), (b"c", 7, 1)}
    assert {(bytes(r.hash), r.keeper, r.n) for r in runs.repeated(2).collect()} == {(b"a", 9, 2), (b"b", 9, 3), (b"c", 7, 2)}


def test_plan_has_no_python(spark, documents, capsys):
    lines.line_report(documents(_rows(30, 1))).explain("extended")
    plan = capsys.readouterr().out
    assert "Arrow" not in plan and "Python" not in plan
