"""Reports over data that is appended to, from stored states.

A state is what a report needs of some rows and can be added to others: how
often each key is there, each distinct invalid row with the columns it lacks,
and for rule reports the counts per key. A run stores the state of the rows it
appends, under ``run_id=...``; a report adds up the states of all runs and
reads none of their rows. A repeated run replaces its own state.

Keys and rows stand as 128 bits of a SHA-256 over their values as text, so a
state has no more than 40 bytes for each distinct key and invalid row, however
wide these are. States of one folder are of one shape: the same columns, keys
and batches.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, FloatType, StructField

from siltstone.functions import blank, broken_rule, negative, quoted, zero
from siltstone.operators.profile import invalid_rows, null_masks
from siltstone.operators.reports import quality_columns, rule_columns


def _text(field: StructField) -> str:
    """A value as text; equal values read alike, and no value reads like a null."""
    column = quoted(field.name)
    if isinstance(field.dataType, BinaryType):
        value = f"hex({column})"
    elif isinstance(field.dataType, DoubleType | FloatType):
        # Zero and minus zero are one value to a group.
        value = f"CAST({column} + 0 AS STRING)"
    else:
        value = f"CAST({column} AS STRING)"
    return f"coalesce(concat(octet_length({value}), ':', {value}), '-')"


def _digest(df: DataFrame, columns: Sequence[str]) -> str:
    texts = ", ".join(_text(df.schema[c]) for c in columns)
    return f"unhex(substring(sha2(concat({texts}), 256), 1, 32))"


def _batches(by: Sequence[str]) -> list[str]:
    return [f"{quoted(b)} AS by_{i}" for i, b in enumerate(by)]


def quality_state(df: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``invalid, by_0..., digest, mask_0..., n``: keys (``invalid`` false, no masks) and invalid rows with their number.

    Equal keys and rows collapse inside each task before they are shuffled.
    """
    batch = [f"by_{i}" for i in range(len(by))]
    keys = df.selectExpr(*_batches(by), f"{_digest(df, key)} AS digest")
    keys = keys.groupBy(*batch, "digest").agg(F.count(F.lit(1)).alias("n"))
    masks = null_masks(df.columns)
    names = [mask.rsplit(" AS ", 1)[1] for mask in masks]
    broken = invalid_rows(df).selectExpr(*_batches(by), f"{_digest(df, df.columns)} AS digest", *masks)
    broken = broken.groupBy(*batch, "digest", *names).agg(F.count(F.lit(1)).alias("n"))
    return keys.withColumn("invalid", F.lit(False)).unionByName(broken.withColumn("invalid", F.lit(True)), allowMissingColumns=True)


def rule_state(df: DataFrame, key: str, measure: str, by: Sequence[str] = ()) -> DataFrame:
    """``by_0..., digest, total, null_keys, negative_totals, zero_totals, invalid_records``: the counts of each key."""
    counted = df.selectExpr("*", f"{_digest(df, [key])} AS digest").select(
        *[F.expr(b) for b in _batches(by)], "digest", blank(key).alias("blank"), negative(measure).alias("negative"),
        zero(measure).alias("zero"), broken_rule(key, measure).alias("broken"),
    )
    return counted.groupBy(*[f"by_{i}" for i in range(len(by))], "digest").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("blank").alias("null_keys"),
        F.count_if("negative").alias("negative_totals"),
        F.count_if("zero").alias("zero_totals"),
        F.count_if("broken").alias("invalid_records"),
    )


def _store(state: DataFrame, path: str, run_id: str, shape: dict) -> None:
    # The same text in every row, which Parquet keeps once a file.
    rows = state.withColumn("shape", F.lit(json.dumps(shape, sort_keys=True)))
    rows.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def add_quality_state(df: DataFrame, path: str, run_id: str, key: Sequence[str], by: Sequence[str] = ()) -> None:
    """Store the state of the rows a run appends."""
    shape = {"columns": df.columns, "key": list(key), "by": list(by)}
    _store(quality_state(df, key, by), path, run_id, shape)


def add_rule_state(df: DataFrame, path: str, run_id: str, key: str, measure: str, by: Sequence[str] = ()) -> None:
    shape = {"key": key, "measure": measure, "by": list(by)}
    _store(rule_state(df, key, measure, by), path, run_id, shape)


def _stored(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    states = spark.read.option("basePath", path).parquet(f"{path}/run_id=*")
    shapes = [row["shape"] for row in states.select("shape").distinct().limit(2).collect()]
    if len(shapes) > 1:
        raise ValueError(f"{path} has states of different shapes: {' and '.join(shapes)}")
    return states.drop("shape"), json.loads(shapes[0]) if shapes else {}


def stored_quality_report(spark: SparkSession, path: str) -> DataFrame:
    """``reports.quality_report`` over the rows of all runs, from their states."""
    states, shape = _stored(spark, path)
    batch = [c for c in states.columns if c.startswith("by_")]
    masks = [c for c in states.columns if c.startswith("mask_")]
    added = states.groupBy("invalid", *batch, "digest").agg(
        F.sum("n").alias("n"), *[F.bit_or(m).alias(m) for m in masks]
    )
    counts = added.groupBy(*batch).agg(
        F.expr("coalesce(sum(n) FILTER (WHERE NOT invalid), 0) AS records"),
        F.expr("count_if(NOT invalid AND n > 1) AS duplicates"),
        F.expr("count_if(invalid) AS null_records"),
        F.expr("coalesce(sum(n) FILTER (WHERE invalid), 0) AS invalid_row_total"),
        *[F.expr(f"coalesce(bit_or({m}), 0) AS {m}") for m in masks],
    )
    return quality_columns(counts, shape.get("by", []), masks)


def stored_rule_report(spark: SparkSession, path: str) -> DataFrame:
    """``reports.rule_report`` over the rows of all runs, from their states."""
    states, shape = _stored(spark, path)
    batch = [c for c in states.columns if c.startswith("by_")]
    sums = ["total", "null_keys", "negative_totals", "zero_totals", "invalid_records"]
    added = states.groupBy(*batch, "digest").agg(*[F.sum(c).alias(c) for c in sums])
    return rule_columns(added, batch, shape.get("by", []))
