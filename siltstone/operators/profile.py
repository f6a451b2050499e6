"""Null, duplicate and invalid-row profiles.

A row is *invalid* when any of its columns is null, and invalid rows are
counted as distinct rows. Everything here looks at invalid rows only, behind
one filter that reaches the Parquet scan: row groups whose statistics show no
null are skipped unread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField

from siltstone.functions import any_null, named, null_names, quoted

# Longer strings are compared by their SHA-256 digest.
INLINE_LENGTH = 64
# Null flags that fit one bigint.
MASK_BITS = 63


def comparable(field: StructField) -> str:
    """An expression that stands in for a column when rows are only compared.

    Long text and binary values are replaced by (length, digest), so that
    comparing whole rows does not send whole texts through the shuffle. Short
    values keep (length, value); the length keeps the two kinds apart. Nulls
    stay null.
    """
    column = quoted(field.name)
    if not isinstance(field.dataType, StringType | BinaryType):
        return column
    raw = f"CAST({column} AS BINARY)"
    value = f"IF(length({raw}) <= {INLINE_LENGTH}, {raw}, unhex(sha2({raw}, 256)))"
    pair = f"named_struct('length', length({raw}), 'value', {value})"
    return f"IF({column} IS NULL, NULL, {pair})"


def invalid_rows(df: DataFrame) -> DataFrame:
    """Rows with any null, repeated ones included."""
    return df.filter(any_null(df.columns))


def distinct_invalid_rows(df: DataFrame) -> DataFrame:
    return invalid_rows(df).dropDuplicates()


def null_masks(columns: Sequence[str]) -> list[str]:
    """Expressions ``mask_0``... with one bit per column, set where it is null."""
    bits = [
        f"shiftleft(CAST({quoted(c)} IS NULL AS BIGINT), {i % MASK_BITS})"
        for i, c in enumerate(columns)
    ]
    starts = range(0, len(bits), MASK_BITS)
    return [f"{' | '.join(bits[s : s + MASK_BITS])} AS mask_{j}" for j, s in enumerate(starts)]


def invalid_groups(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per batch and distinct invalid row: the batch as ``by_0``...,
    the row's ``copies``, and its null columns as ``mask_0``...

    Partial aggregation collapses repeated rows before the shuffle.
    """
    batch = [f"by_{i}" for i in range(len(by))]
    cells = [f"cell_{i}" for i in range(len(df.columns))]
    return (
        invalid_rows(df)
        .selectExpr(
            *[f"{quoted(b)} AS {alias}" for b, alias in zip(by, batch, strict=True)],
            *[f"{comparable(f)} AS {c}" for f, c in zip(df.schema.fields, cells, strict=True)],
        )
        .groupBy(*batch, *cells)
        .agg(F.count(F.lit(1)).alias("copies"))
        .selectExpr(*batch, "copies", *null_masks(cells))
    )


def invalid_row_count(df: DataFrame) -> DataFrame:
    """One row: distinct invalid rows, and how many rows they stand for."""
    return invalid_groups(df).selectExpr(
        "count(1) AS null_records", "coalesce(sum(copies), 0) AS invalid_row_total"
    )


def null_profile(df: DataFrame) -> DataFrame:
    """One row with the null count of every column, under the column's name."""
    return invalid_rows(df).selectExpr(
        *[f"count_if({quoted(c)} IS NULL) AS {quoted(c)}" for c in df.columns]
    )


def columns_with_null(df: DataFrame) -> DataFrame:
    """``(column_name, null_count)`` of the columns that hold a null."""
    profile = null_profile(df).unpivot([], list(df.columns), "column_name", "null_count")
    return profile.filter("null_count > 0")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their ``copies``; null is a key
    like any other. Reads the key columns alone."""
    counted = df.groupBy(*map(named, key)).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter("copies > 1")


def invalid_row_detail(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key and null column names of every distinct invalid row."""
    rest = [comparable(f) for f in df.schema.fields if f.name not in key]
    names = F.array_join(null_names(df.columns), ", ").alias("null_columns")
    cells = [F.expr(f"{cell} AS cell_{i}") for i, cell in enumerate(rest)]
    return (
        invalid_rows(df)
        .groupBy(*map(named, key), names, *cells)
        .agg(F.count(F.lit(1)).alias("copies"))
        .select(*map(quoted, key), "null_columns")
    )


def null_slices(df: DataFrame) -> DataFrame:
    """The rows of ``df`` once per null column, that column named.

    The same rows as the union of one filtered scan per column, from one scan.
    """
    return invalid_rows(df).withColumn("null_column", F.explode(null_names(df.columns)))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole rows without their repeats; nulls compare equal."""
    return df.dropDuplicates()
