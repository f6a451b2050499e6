"""Reports from stored states, and gated writes."""

import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators import reports
from siltstone.sources import quarantine, states

SCHEMA = "batch string, key int, wide string, price double"
ROWS = [
    ("a", 1, "x" * 100, 1.0), ("a", 1, "x" * 100, None), ("a", 2, None, -0.0), ("a", 2, None, 0.0), ("b", None, "y", 1.0),
    ("b", None, "y", 1.0), (None, 7, "", 2.0), (None, 7, None, None), ("c", 3, "-", 4.5), ("c", 4, "1:x", float("nan")),
]


def rows(df):
    return Counter(str(sorted(r.asDict().items())) for r in df.collect())


def appends(spark, n):
    return [spark.createDataFrame(ROWS[i::n], SCHEMA) for i in range(n)]


@pytest.mark.parametrize("by", [[], ["batch"]])
@pytest.mark.parametrize("key", [["key"], ["key", "wide"], ["price"]])
def test_three_appends_equal_one_report_over_all(spark, tmp_path, key, by):
    path = str(tmp_path / "states")
    whole = spark.createDataFrame(ROWS, SCHEMA)
    for run, part in enumerate(appends(spark, 3)):
        states.add_quality_state(part, path, str(run), key, by)
    states.add_quality_state(appends(spark, 3)[1], path, "1", key, by)
    assert rows(states.stored_quality_report(spark, path)) == rows(reports.quality_report(whole, key, by))


@pytest.mark.parametrize("by", [[], ["batch"]])
def test_rule_reports_add_up(spark, tmp_path, by):
    path = str(tmp_path / "states")
    for run, part in enumerate(appends(spark, 4)):
        states.add_rule_state(part, path, str(run), "wide", "price", by)
    whole = spark.createDataFrame(ROWS, SCHEMA)
    assert rows(states.stored_rule_report(spark, path)) == rows(reports.rule_report(whole, "wide", "price", by))


def test_older_rows_are_not_read_again(spark, tmp_path):
    path, data = str(tmp_path / "states"), tmp_path / "data"
    for run, part in enumerate(appends(spark, 3)):
        part.write.parquet(str(data / str(run)))
        states.add_quality_state(spark.read.parquet(str(data / str(run))), path, str(run), ["key"])
        # What is appended is gone before the next run and the report come.
        shutil.rmtree(data / str(run))
    whole = spark.createDataFrame(ROWS, SCHEMA)
    assert rows(states.stored_quality_report(spark, path)) == rows(reports.quality_report(whole, ["key"]))


def test_states_of_other_shapes_are_refused_and_empty_ones_are_not(spark, tmp_path):
    path = str(tmp_path / "states")
    whole = spark.createDataFrame(ROWS, SCHEMA)
    states.add_quality_state(whole.limit(0), path, "0", ["key"])
    assert rows(states.stored_quality_report(spark, path)) == rows(reports.quality_report(whole.limit(0), ["key"]))
    states.add_quality_state(whole, path, "1", ["key"])
    states.add_quality_state(whole, path, "2", ["wide"])
    with pytest.raises(ValueError, match="different shapes"):
        states.stored_quality_report(spark, path)


def test_many_columns_have_several_masks(spark, tmp_path):
    path = str(tmp_path / "states")
    wide = spark.range(3).select("id", *[F.when(F.col("id") != i % 3, F.lit(1)).alias(f"c{i}") for i in range(70)])
    for run in range(3):
        states.add_quality_state(wide.filter(f"id = {run}"), path, str(run), ["id"])
    found = states.stored_quality_report(spark, path)
    assert rows(found) == rows(reports.quality_report(wide, ["id"]))
    assert found.first()["columns_with_null"] == 70


def test_each_batch_goes_where_its_verdict_says(spark, tmp_path):
    path = str(tmp_path / "gated")
    whole = spark.createDataFrame(ROWS, SCHEMA)
    routed = quarantine.write_gated(whole, path, "1", ["key"], ["batch"], fail_on_nulls=True, fail_on_duplicates=True)
    assert routed == quarantine.Routed(2, 8)
    assert {r.batch for r in quarantine.read_loaded(spark, path).collect()} == {"c"}
    apart = quarantine.read_quarantined(spark, path)
    assert {(r.batch, r.violations) for r in apart.collect()} == {
        ("a", "nulls, duplicates"), ("b", "nulls, duplicates"), (None, "nulls, duplicates")
    }
    # The same run again, with nothing switched on: all of it is loaded and nothing stays apart.
    assert quarantine.write_gated(whole, path, "1", ["key"], ["batch"]) == quarantine.Routed(10, 0)
    assert quarantine.read_quarantined(spark, path).isEmpty()
    assert quarantine.write_gated(whole.limit(0), path, "2", ["key"], ["batch"]) == quarantine.Routed(0, 0)
    assert rows(quarantine.read_loaded(spark, path).drop("run_id")) == rows(whole)
    with pytest.raises(ValueError, match="columns of the write's own: violations"):
        quarantine.write_gated(whole.withColumn("violations", F.lit(1)), path, "3", ["key"], ["batch"])
    with pytest.raises(ValueError, match="needs batches"):
        quarantine.write_gated(whole, path, "3", ["key"], [])
