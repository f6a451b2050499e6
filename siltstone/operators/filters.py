"""Required fields, rejected rows and what they add up to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import any_null, blank, broken_rule


def require_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows with all ``fields`` present. Blank strings pass."""
    return df.filter(~any_null(fields))


def rejected_rows(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The rows ``require_fields`` drops, kept for inspection."""
    return df.filter(any_null(fields))


#: The same rows, asked for as a profile of invalid ones.
rows_with_any_null = rejected_rows


def rows_with_blank_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(blank(key))


def rows_breaking_rule(df: DataFrame, key: str, measure: str) -> DataFrame:
    return df.filter(broken_rule(key, measure))


def dropped_rows(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row: rows in, rows kept by ``require_fields``, rows dropped.

    One aggregate over the required columns alone.
    """
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~any_null(fields)).alias("rows_kept"),
        F.count_if(any_null(fields)).alias("rows_dropped"),
    )


def check_not_empty(df: DataFrame, what: str) -> None:
    """Raise ``ValueError`` on an empty frame; stops at the first row found."""
    if df.isEmpty():
        raise ValueError(f"no records found in {what}")
