"""Every query against its SQL on DuckDB, over the same Parquet tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from siltstone.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_cell(row[i]) for i in order) for row in rows])


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, oracle, name):
    actual = QUERIES[name](spark, SF_DIR)
    expected = oracle.execute(ORACLES[name])
    names = [column[0] for column in expected.description]
    rows = expected.fetchall()
    assert sorted(actual.columns) == sorted(names)
    types = {column[0]: str(column[1]) for column in expected.description}
    for field in actual.schema.fields:
        assert TYPES[field.dataType.simpleString()] == types[field.name], field.name
    assert _sorted_rows(actual.columns, actual.collect()) == _sorted_rows(names, rows)
    if name == "gold_sorted":
        # The rows as they come, not only the number each one brings.
        assert [r.place for r in actual.collect()] == list(range(1, len(rows) + 1))
    assert rows
