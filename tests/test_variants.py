"""Landing records as variants, and sorted writes."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.sources import layout, variants


def _landed(spark, tmp_path, *records):
    (tmp_path / "a.json").write_text("\n".join(json.dumps(r) for r in records))
    return variants.read_records(spark, str(tmp_path))


def test_drifted_records_keep_all_fields(spark, tmp_path):
    records = [
        {"id": 1, "a": {"b": 1}}, {"id": 2, "a": {"c": [1.5, 2]}, "odd name": "x"}, {"id": 3, "a": None, "none": None},
        {"id": 4, "mixed": 1}, {"id": 5, "mixed": "t"}, {},
    ]
    landed = _landed(spark, tmp_path, *records)
    assert landed.schema.simpleString() == "struct<record:variant>"
    found = variants.layout(landed)
    assert found.simpleString().startswith("struct<a:struct<b:bigint,c:array<decimal(21,1)>>,id:bigint,mixed:variant,")
    rows = {r.id: r for r in variants.typed(landed).collect()}
    assert rows[1].a.b == 1 and rows[2].a.c[0] == 1.5 and rows[2]["odd name"] == "x" and rows[3].a is None
    assert rows[4].mixed.toPython() == 1 and rows[5].mixed.toPython() == "t" and rows[None].a is None
    drift = variants.drift(landed, StructType.fromDDL("id bigint, a struct<b: string>, gone date")).collect()
    assert {(r.path, r.declared_type, r.found_type, r.n_records) for r in drift} == {
        ("a.b", "string", "bigint", 1), ("a.c", None, "array<decimal(21,1)>", 1), ("`odd name`", None, "string", 1),
        ("none", None, "variant", 0), ("mixed", None, "variant", 2), ("gone", "date", None, 0),
    }
    assert variants.drift(landed, found).isEmpty()


def test_no_records_and_no_objects(spark, tmp_path):
    landed = _landed(spark, tmp_path, {"id": 1})
    assert variants.layout(landed.limit(0)) == StructType()
    drift = variants.drift(landed.limit(0), StructType.fromDDL("id bigint")).collect()
    assert [tuple(r) for r in drift] == [("id", "bigint", None, 0)]
    (tmp_path / "a.json").write_text("[1, 2]\n")
    with pytest.raises(ValueError, match="no objects"):
        variants.layout(variants.read_records(spark, str(tmp_path)))
    (tmp_path / "a.json").write_text('{"id": \n')
    with pytest.raises(Exception, match="MALFORMED"):
        variants.read_records(spark, str(tmp_path)).collect()


def test_variants_are_stored_and_read_back(spark, tmp_path):
    landed = _landed(spark, tmp_path, {"id": 1, "a": [{"b": None}]}, {"id": 2})
    landed.write.parquet(str(tmp_path / "raw"))
    back = spark.read.parquet(str(tmp_path / "raw"))
    assert sorted(r.j for r in back.select(F.to_json("record").alias("j")).collect()) == ['{"a":[{"b":null}],"id":1}', '{"id":2}']


def test_files_follow_one_another_and_ranges_skip_them(spark, tmp_path):
    path = str(tmp_path / "sorted")
    df = spark.range(0, 40_000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 500, CAST(pmod(xxhash64(id), 1000) AS INT)) AS k", "IF(id % 50 = 0, NULL, id) AS v", "1 AS _tie"
    )
    layout.write_sorted(df, path, ["k", "v"], files=10)
    files = sorted(p.name for p in (tmp_path / "sorted").glob("*.parquet"))
    assert len(files) == 10
    in_order = [r for f in files for r in spark.read.parquet(f"{path}/{f}").select("k", "v").collect()]
    assert [(r.k, r.v) for r in in_order] == sorted(
        ((r.k, r.v) for r in df.collect()), key=lambda x: (x[0], x[1] is not None, x[1] or 0)
    )
    # A third of the rows has one key; no file has much more than its share.
    sizes = [spark.read.parquet(f"{path}/{f}").count() for f in files]
    assert max(sizes) < 6_500
    narrow = spark.read.parquet(path).filter("k BETWEEN 10 AND 20")
    assert Counter(narrow.collect()) == Counter(df.filter("k BETWEEN 10 AND 20").collect())
    read = narrow._jdf.queryExecution().executedPlan()
    narrow._jdf.queryExecution().toRdd().count()
    scanned = read.collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    assert 0 < scanned < 10_000


def test_large_files_are_sorted_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "SORTED_BYTES", 100_000)
    df = spark.range(0, 60_000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 500, CAST(pmod(xxhash64(id), 1000) AS INT)) AS k", "IF(id % 50 = 0, NULL, id) AS v",
        "repeat('x', CAST(id % 40 AS INT)) AS text", "array(id, k) AS nested",
    )
    path = str(tmp_path / "sorted")
    sizes = []
    in_order = layout._in_order

    def seen(session, scratch, schema):
        sizes.extend(r[0] for r in session.read.parquet(scratch).groupBy(F.input_file_name()).count().select("count").collect())
        return in_order(session, scratch, schema)

    monkeypatch.setattr(layout, "_in_order", seen)
    layout.write_sorted(df, path, ["k", "v"], files=3)
    # About 6 MB of values: no task sorted more than a small part of a file.
    assert len(sizes) > 30 and sum(sizes) == 60_000 and max(sizes) < 4_000
    files = sorted(p.name for p in (tmp_path / "sorted").glob("*.parquet"))
    assert len(files) == 3
    parts = [spark.read.parquet(f"{path}/{f}").collect() for f in files]
    assert max(map(len, parts)) < 24_000
    found = [(r.k, r.v) for part in parts for r in part]
    assert found == sorted(((r.k, r.v) for r in df.collect()), key=lambda x: (x[0], x[1] is not None, x[1] or 0))
    assert Counter(map(str, spark.read.parquet(path).collect())) == Counter(map(str, df.collect()))
