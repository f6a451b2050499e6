"""Quality reports and the gate on them.

A report is one row, or one row per batch when ``by`` is given. It stays a
DataFrame until the caller reads that row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import (
    blank,
    broken_rule,
    named,
    negative,
    percent_valid,
    quoted,
    status,
    zero,
)
from siltstone.operators.profile import MASK_BITS, invalid_groups

MESSAGE_ROWS = 20


class QualityGateError(ValueError):
    """A report violates an enabled gate."""


def _aliases(columns: Sequence[str], prefix: str) -> list[str]:
    return [f"{quoted(c)} AS {prefix}_{i}" for i, c in enumerate(columns)]


def _batch_names(by: Sequence[str]) -> list[str]:
    return [f"by_{i} AS {quoted(b)}" for i, b in enumerate(by)]


def _total(*names: str) -> list[str]:
    return [f"coalesce(sum({n}), 0) AS {n}" for n in names]


def _exprs(texts: Sequence[str]) -> list[Column]:
    return [F.expr(text) for text in texts]


def graded(counts: DataFrame, total: str, duplicates: str, invalid: str) -> DataFrame:
    """Add ``quality`` and ``status`` to a frame of counts."""
    quality = percent_valid(f"{total} - {invalid}", total)
    return counts.withColumn("quality", quality).withColumn(
        "status", status(duplicates, invalid, "quality")
    )


def quality_report(df: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Records, valid and null records, duplicate keys, percentage, status.

    Two scans in one action. The first reads the key columns only and gives
    rows and duplicate keys; the second reads the invalid rows only and gives
    the distinct invalid rows and the null count of each column (a row without
    nulls adds to none). Both collapse equal keys or rows before they shuffle,
    and the final step adds up one row per task and batch.
    """
    batch = [f"by_{i}" for i in range(len(by))]
    keys = [f"key_{i}" for i in range(len(key))]
    keyed = (
        df.selectExpr(*_aliases(by, "by"), *_aliases(key, "key"))
        .groupBy(*batch, *keys)
        .agg(F.expr("count(1) AS copies"))
        .groupBy(*batch)
        .agg(*_exprs(["sum(copies) AS records", "count_if(copies > 1) AS duplicates"]))
    )
    masks = [f"mask_{j}" for j in range(-(-len(df.columns) // MASK_BITS))]
    broken = (
        invalid_groups(df, by)
        .groupBy(*batch)
        .agg(
            *_exprs(["count(1) AS null_records", "sum(copies) AS invalid_row_total"]),
            *_exprs([f"bit_or({m}) AS {m}" for m in masks]),
        )
    )
    counts = (
        keyed.unionByName(broken, allowMissingColumns=True)
        .groupBy(*batch)
        .agg(
            *_exprs(_total("records", "duplicates", "null_records", "invalid_row_total")),
            *_exprs([f"coalesce(bit_or({m}), 0) AS {m}" for m in masks]),
        )
    )
    return quality_columns(counts, by, masks)


def quality_columns(counts: DataFrame, by: Sequence[str], masks: Sequence[str]) -> DataFrame:
    """The report's columns from the counts of each batch."""
    return graded(counts, "records", "duplicates", "null_records").selectExpr(
        *_batch_names(by),
        "records",
        "records - null_records AS valid_records",
        "null_records",
        "duplicates",
        "quality",
        "status",
        " + ".join(f"bit_count({m})" for m in masks) + " AS columns_with_null",
        "invalid_row_total",
    )


def rule_report(df: DataFrame, key: str, measure: str, by: Sequence[str] = ()) -> DataFrame:
    """Key and measure rules of a grouped table, in one scan and one shuffle.

    Unlike ``quality_report`` this counts invalid rows, not distinct ones.
    """
    batch = [f"by_{i}" for i in range(len(by))]
    per_key = (
        df.select(
            *_exprs(_aliases(by, "by")),
            named(key).alias("key"),
            blank(key).alias("blank"),
            negative(measure).alias("negative"),
            zero(measure).alias("zero"),
            broken_rule(key, measure).alias("broken"),
        )
        .groupBy(*batch, "key")
        .agg(
            *_exprs(
                [
                    "count(1) AS total",
                    "count_if(blank) AS null_keys",
                    "count_if(negative) AS negative_totals",
                    "count_if(zero) AS zero_totals",
                    "count_if(broken) AS invalid_records",
                ]
            )
        )
    )
    return rule_columns(per_key, batch, by)


def rule_columns(per_key: DataFrame, batch: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The report's columns from the counts of each key; ``batch`` are the columns that stand for ``by``."""
    sums = _total("total", "null_keys", "negative_totals", "zero_totals", "invalid_records")
    counts = per_key.groupBy(*batch).agg(*_exprs(["count_if(total > 1) AS duplicate_keys", *sums]))
    return graded(counts, "total", "duplicate_keys", "invalid_records").selectExpr(
        *_batch_names(by),
        "total",
        "duplicate_keys",
        "null_keys",
        "negative_totals",
        "zero_totals",
        "invalid_records",
        "quality",
        "status",
    )


def gate(
    report: DataFrame, fail_on_nulls: bool = False, fail_on_duplicates: bool = False
) -> DataFrame:
    """Add ``violations`` to a quality report: the enabled gates each batch
    breaks, comma-joined, empty for none. Both gates are off by default."""
    nulls = f"IF({fail_on_nulls} AND null_records > 0, 'nulls', NULL)"
    duplicates = f"IF({fail_on_duplicates} AND duplicates > 0, 'duplicates', NULL)"
    return report.withColumn("violations", F.expr(f"concat_ws(', ', {nulls}, {duplicates})"))


def check_gate(gated: DataFrame) -> None:
    """Raise when a batch of a gated report has violations."""
    violating = gated.filter("violations <> ''")
    shown = violating.limit(MESSAGE_ROWS).collect()
    if shown:
        listed = "; ".join(str(row.asDict()) for row in shown)
        raise QualityGateError(f"{len(shown)} of {violating.count()} batches that break a gate: {listed}")
