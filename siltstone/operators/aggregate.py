"""Grouped counts, their roll-ups, and the ordered views on them.

``groupBy`` aggregates inside each task before the shuffle, so a group that
holds most of the rows still sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import named


def count_by(df: DataFrame, keys: Sequence[str], counted: str, alias: str = "total") -> DataFrame:
    """Rows per key with a non-null ``counted`` column. On a grouped table that
    is the number of its groups per coarser key."""
    return df.groupBy(*map(named, keys)).agg(F.count(named(counted)).alias(alias))


def total_by(df: DataFrame, keys: Sequence[str], measure: str, alias: str) -> DataFrame:
    """Sum of a measure per key: the roll-up of an already grouped table."""
    return df.groupBy(*map(named, keys)).agg(F.sum(named(measure)).alias(alias))


def in_order(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ascending, nulls first. Sort where the rows are read, not before a
    write: a table keeps no order across files."""
    return df.orderBy(*map(named, keys))


def first_rows(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in order: each task keeps ``n``, no full sort."""
    return in_order(df, keys).limit(n)
