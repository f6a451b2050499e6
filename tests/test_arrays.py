"""Arrays of any layout against a whole-document parse."""

import json
import random
import re

import pytest

from siltstone.sources import landing

SCHEMA = "id bigint, note string, tags array<string>, more struct<deep: array<struct<x: bigint>>>"


def _records(n, seed):
    dice = random.Random(seed)
    notes = ["plain", "}", "{", "]", "[", '"', "\\", '\\"}', "}]", "a\nb", "é}ü", "", '"},{"', "\\\\"]
    return [
        {
            "id": i,
            "note": dice.choice(notes) + dice.choice(notes),
            "tags": dice.choices(notes, k=dice.randrange(4)),
            "more": {"deep": [{"x": dice.randrange(9)} for _ in range(dice.randrange(3))]},
        }
        for i in range(n)
    ]


def _layouts(records):
    yield "compact", json.dumps(records, separators=(",", ":"))
    yield "indented", json.dumps(records, indent=2)
    yield "wide", "\n [ " + " ,\n\t".join(json.dumps(r, indent=8 if r["id"] % 2 else None) for r in records) + "\n]\n\n"
    yield "escaped", json.dumps(records, ensure_ascii=False)


def _found(spark, path):
    found = landing.read_array(spark, str(path), SCHEMA)
    return sorted((r.asDict(recursive=True) for r in found.collect()), key=lambda r: r["id"])


@pytest.mark.parametrize("block", ["300", "4m"])
def test_equals_a_whole_document_parse(spark, tmp_path, block):
    records = _records(120, 3)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, block)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        for layout, text in _layouts(records):
            path = tmp_path / layout
            path.mkdir()
            (path / "a.json").write_text(text)
            if block == "300":
                assert landing._pieces(spark, str(path)).select("_block").distinct().count() > 10
            assert _found(spark, path) == records, layout
    finally:
        spark.conf.set(name, before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_several_files_empty_and_blank_ones(spark, tmp_path):
    records = _records(30, 4)
    (tmp_path / "a.json").write_text(json.dumps(records[:20]))
    (tmp_path / "b.json").write_text(json.dumps(records[20:], indent=4))
    (tmp_path / "c.json").write_text(" [ \n ] \n")
    (tmp_path / "d.json").write_text("")
    (tmp_path / "e.json").write_text("\n \n")
    assert _found(spark, tmp_path) == records


def test_a_record_longer_than_many_blocks(spark, tmp_path):
    records = [{"id": 1, "note": "x{}" * 2_000, "tags": ["}"] * 500, "more": None}, {"id": 2, "note": "", "tags": [], "more": None}]
    (tmp_path / "a.json").write_text(json.dumps(records))
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "200")
    try:
        assert _found(spark, tmp_path) == records
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize(
    "text",
    [
        '[{"id": 1}, 5]', '[{"id": 1} {"id": 2}]', '[{"id": 1}, {"id": 2}', '[{"id": 1}, x {"id": 2}]', '{"id": 1}',
        '[{"id": 1}]]', '[{"id": 1}] [{"id": 2}]', '[[{"id": 1}]]', '[{"id": 1},]', '[{"id": "a"}]', "[1]", '["}"]',
        '{"id": 1}\n{"id": 2}', '[,{"id": 1}]', '[{"id": 1}, {"note": "open}]',
    ],
)
def test_what_is_no_array_of_records_fails(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="no array of records|MALFORMED"):
        _found(spark, tmp_path)
    with pytest.raises(Exception, match="no array of records|MALFORMED"):
        landing.read_array(spark, str(tmp_path), SCHEMA).select("id").collect()


def test_indented_records_that_end_in_a_list(spark, tmp_path):
    records = [{"id": 1, "tags": ["a", "b"]}, {"id": 2, "tags": []}, {"id": 3, "tags": ["]"]}]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=2))
    found = landing.read_indented_array(spark, str(tmp_path), "id int, tags array<string>").orderBy("id").collect()
    assert [r.asDict() for r in found] == records


def test_pieces_stay_where_they_are_read(spark, tmp_path, capsys):
    (tmp_path / "a.json").write_text(json.dumps(_records(20, 9)))
    landing.read_array(spark, str(tmp_path), SCHEMA).explain("formatted")
    exchanges = re.findall(r"\n\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    assert exchanges
    assert not any(column.startswith("value#") for inputs in exchanges for column in inputs.split(", "))
