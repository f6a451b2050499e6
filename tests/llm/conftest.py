import pytest

from siltstone.llm.shared import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def documents(spark):
    """A documents table from (id, text) pairs, with columns whose names the operators use themselves."""

    def make(rows, kind="long"):
        schema = f"doc_id {kind}, text string, kept string, score string, sequence_id int, component_id string, part int, slice int"
        return spark.createDataFrame([(i, t, "x", None, 1, "y", 2, 3) for i, t in rows], schema)

    return make
