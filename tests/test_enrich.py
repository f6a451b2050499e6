import json
from collections import Counter
from datetime import datetime

import pytest

from siltstone.operators import enrich
from siltstone.plans.medallion import RefinedSpec, refined_rows
from siltstone.sources import landing

BRONZE = (
    "key int, name string, made struct<year: int, by: struct<name: string, place: struct<town: string, "
    "`post-code`: string>>>, ingestion_timestamp timestamp, source_system string, "
    "file_name string, year int, month int"
)
ROWS = [
    (1, "Ardon", (1910, ("North & Co", ("Vell", "V1")))),
    (2, "Brask", (1920, ("South & Co", ("Morn", "M1")))),
    (3, "Crail", (1930, ("Edge & Co", None))),
]
COLUMNS = {
    "key": "key",
    "name": "name",
    "made_in": "made.year",
    "maker": "made.by.name",
    "town": "made.by.place.town",
    "post_code": "made.by.place.post-code",
    "ingestion_timestamp": "ingestion_timestamp",
    "source_system": "source_system",
}


@pytest.fixture
def bronze(spark):
    rows = [(*r, None, "src", "pots.json", 2025, 1) for r in ROWS]
    return spark.createDataFrame(rows, BRONZE)


def test_enrich_adds_load_columns(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "name string, id int")
    rows = enrich.enrich(df, "src", "2025-03-04 05:06:07").collect()
    assert len(rows) == 3
    assert {r.source_system for r in rows} == {"src"}
    assert {(r.year, r.month) for r in rows} == {(2025, 3)}
    assert {r.ingestion_timestamp for r in rows} == {datetime(2025, 3, 4, 5, 6, 7)}
    assert {r.file_name for r in rows} == {""}


def test_enrich_uses_the_clock_once(spark):
    df = enrich.enrich(spark.range(1000).repartition(8), "src")
    assert df.select("ingestion_timestamp").distinct().count() == 1
    assert df.filter("ingestion_timestamp IS NULL OR year IS NULL OR month IS NULL").isEmpty()


def test_enrich_works_on_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id": 1}\n{"id": 2}\n')
    stream = spark.readStream.schema("id int").json(str(tmp_path / "in"))
    query = (
        enrich.enrich(stream, "src")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination(60)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.id for r in rows) == [1, 2]
    assert all(r.file_name.endswith("a.json") for r in rows)


def test_refined_rows_flatten_and_drop(bronze):
    spec = RefinedSpec(columns=COLUMNS, required=["town"], key=["key"])
    result = refined_rows(bronze, spec)
    assert set(result.columns) == set(COLUMNS)
    rows = {r.key: r for r in result.collect()}
    assert set(rows) == {1, 2}
    assert (rows[1].town, rows[1].post_code) == ("Vell", "V1")


def test_null_parent_gives_null_children(bronze):
    row = enrich.flatten(bronze, COLUMNS).filter("key = 3").first()
    assert row.maker == "Edge & Co"
    assert row.town is None and row.post_code is None


def test_blank_required_field_passes(spark):
    from siltstone.operators.filters import require_fields

    df = spark.createDataFrame([("",), ("  ",), (None,)], "code string")
    assert require_fields(df, ["code"]).count() == 2


def test_flatten_all_follows_the_schema(bronze):
    flat = enrich.flatten_all(bronze)
    assert "made_by_place_town" in flat.columns
    assert "made_by_place_post-code" in flat.columns
    assert flat.count() == 3


def test_flatten_all_refuses_colliding_names(spark):
    df = spark.sql("SELECT named_struct('b', 1) AS a, 2 AS a_b")
    with pytest.raises(ValueError, match="flatten to one name"):
        enrich.flatten_all(df)
    assert enrich.flatten_all(df, ".").columns == ["a.b", "a_b"]


def test_flatten_reads_only_the_leaves(spark, bronze, tmp_path):
    bronze.write.parquet(str(tmp_path / "b"))
    flat = enrich.flatten(spark.read.parquet(str(tmp_path / "b")), {"town": COLUMNS["town"]})
    plan = flat.filter("town IS NOT NULL")._jdf.queryExecution().toString()
    schema = "ReadSchema: struct<made:struct<by:struct<place:struct<town:string>>>>"
    assert schema in plan
    assert "PushedFilters: [IsNotNull(made.by.place.town)]" in plan


ARRAY = """[
  {
    "id": 1,
    "name": "says \\"}\\" and\\n  }, done",
    "tags": {
      "a": 1
    }
  },
  {
    "id": 2,
    "name": null,
    "tags": {
      "a": 2
    }
  }
]
"""


def test_indented_array_is_read_by_record(spark, tmp_path):
    (tmp_path / "a.json").write_text(ARRAY)
    schema = "id int, name string, tags struct<a: int>"
    rows = landing.read_indented_array(spark, str(tmp_path), schema).orderBy("id").collect()
    whole = landing.read_json(spark, str(tmp_path), schema, multi_line=True).orderBy("id")
    assert rows == whole.collect()
    assert rows[0].name == 'says "}" and\n  }, done'


def test_indented_array_is_split(spark, tmp_path):
    records = [{"id": i, "name": "x" * 50} for i in range(2000)]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=2))
    bytes_per_task = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = landing.read_indented_array(spark, str(tmp_path), "id int, name string")
        assert df.rdd.getNumPartitions() > 4
        assert df.selectExpr("count(1)", "count(DISTINCT id)", "sum(id)").first() == (
            2000,
            2000,
            1999000,
        )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_per_task)


def test_an_array_read_as_lines_fails(spark, tmp_path):
    (tmp_path / "a.json").write_text(ARRAY)
    with pytest.raises(Exception, match="MALFORMED"):
        landing.read_json(spark, str(tmp_path), "id int").collect()
    kept = landing.read_json(spark, str(tmp_path), "id int", keep_malformed=True)
    assert kept.columns == ["id", landing.MALFORMED]


def _records(n):
    return [{"id": i, "name": f'n}} ]{i}'} for i in range(n)]


LAYOUTS = {
    "indent 2": json.dumps(_records(5), indent=2),
    "indent 4": json.dumps(_records(5), indent=4),
    "one line": json.dumps(_records(5)),
    "a record a line": "[\n" + ",\n".join(map(json.dumps, _records(5))) + "\n]\n",
    "empty first": json.dumps([{}, *_records(5)], indent=2),
    "empty last": json.dumps([*_records(5), {}], indent=2),
    "no record": "[]\n",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_every_record_of_an_array_is_kept(spark, tmp_path, name):
    (tmp_path / "a.json").write_text(LAYOUTS[name])
    rows = landing.read_indented_array(spark, str(tmp_path), "id int, name string").collect()
    expected = json.loads(LAYOUTS[name])
    assert Counter((r.id, r.name) for r in rows) == Counter((r.get("id"), r.get("name")) for r in expected)


@pytest.mark.parametrize(
    "text",
    [
        "\n".join(map(json.dumps, _records(3))),
        json.dumps(_records(2)) + "\n" + json.dumps(_records(2)),
        json.dumps(_records(3), indent=2) + "\nrest",
        json.dumps(_records(3), indent=2).replace('"id": 1', '"id": 1 1'),
        json.dumps([{"id": 1, "a": {"b": 1}}, {"id": 2, "a": {"b": 1}}], indent=1),
    ],
    ids=["lines", "two arrays", "text behind", "broken record", "nested at the indent"],
)
def test_what_is_no_such_array_is_refused(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="MALFORMED|no indented array"):
        landing.read_indented_array(spark, str(tmp_path), "id int, name string").collect()
