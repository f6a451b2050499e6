"""One-row frames from values at hand."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType

from siltstone.functions import quoted


def one_row(spark: SparkSession, columns: Mapping[str, tuple[Any, str]]) -> DataFrame:
    """A row of ``{name: (value, SQL type)}``, as literals of the plan: no
    Python worker has to start to write it."""
    casts = [
        f"CAST(:value_{i} AS {kind}) AS {quoted(name)}"
        for i, (name, (_, kind)) in enumerate(columns.items())
    ]
    values = {f"value_{i}": value for i, (value, _) in enumerate(columns.values())}
    return spark.sql(f"SELECT {', '.join(casts)}", args=values)


def as_frame(spark: SparkSession, row: Row, schema: StructType) -> DataFrame:
    """A flat row read from a frame, as a frame again."""
    return one_row(
        spark,
        {
            field.name: (value, field.dataType.simpleString())
            for field, value in zip(schema.fields, row, strict=True)
        },
    )
