"""Schema contract: which top-level columns a frame must bring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class ContractError(ValueError):
    """A frame lacks declared columns, or has them with other types."""


@dataclass(frozen=True)
class ColumnDifference:
    """Column names on one side only, sorted."""

    missing: list[str]
    extra: list[str]


def column_difference(df: DataFrame, expected: Sequence[str]) -> ColumnDifference:
    present, declared = set(df.columns), set(expected)
    return ColumnDifference(sorted(declared - present), sorted(present - declared))


def check_contract(df: DataFrame, expected: Sequence[str] | StructType) -> list[str]:
    """Raise on missing columns; return the extra ones, which are accepted.

    Names are compared, top level only. Give a ``StructType`` to compare the
    types of the declared columns as well. Reads metadata, starts no job.
    """
    names = expected.fieldNames() if isinstance(expected, StructType) else expected
    difference = column_difference(df, names)
    if difference.missing:
        raise ContractError("missing columns: " + ", ".join(difference.missing))
    if isinstance(expected, StructType):
        wrong = [
            f"{f.name} is {df.schema[f.name].dataType.simpleString()}, "
            f"not {f.dataType.simpleString()}"
            for f in expected.fields
            if df.schema[f.name].dataType.simpleString() != f.dataType.simpleString()
        ]
        if wrong:
            raise ContractError("; ".join(wrong))
    return difference.extra


def contract_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """``(column_name, side, n_rows)``: a row for each missing or extra column,
    with the number of rows that are concerned."""
    difference = column_difference(df, expected)
    sides = [(name, "missing") for name in difference.missing] + [(name, "extra") for name in difference.extra]
    rows = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(s).alias("side")) for n, s in sides])
    empty = F.array().cast("array<struct<column_name: string, side: string>>")
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.inline(rows if sides else empty), "n_rows")
