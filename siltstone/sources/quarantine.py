"""Gated writes: batches that pass their gate are loaded, the others stored apart.

    <table>/run_id=<run>/accepted=true/*.parquet
    <table>/run_id=<run>/accepted=false/*.parquet

One write routes all rows. The verdict on a batch comes from its report, which
reads key columns and invalid rows; the rows themselves are read once, and
counted on both sides while they are written. A repeated run replaces what it
wrote, whatever the verdicts were before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import named, quoted
from siltstone.operators.reports import gate, quality_report

VIOLATIONS = "violations"
_ACCEPTED = "accepted"


@dataclass(frozen=True)
class Routed:
    """Rows of one gated write."""

    loaded: int
    quarantined: int


def write_gated(
    df: DataFrame,
    path: str,
    run_id: str,
    key: Sequence[str],
    by: Sequence[str],
    fail_on_nulls: bool = False,
    fail_on_duplicates: bool = False,
) -> Routed:
    """Write a run's rows, each to the side its batch belongs to.

    ``by`` are the columns of a batch; null is a batch like any other. Rows
    that are set apart carry ``violations``. Both gates are off by default,
    and then every batch passes. The join with the verdicts is the session's:
    broadcast while they are small, else one that AQE splits where a batch is
    large.
    """
    taken = {VIOLATIONS, _ACCEPTED} & set(df.columns)
    if taken or not by:
        raise ValueError("a gated write needs batches" if not by else f"columns of the write's own: {', '.join(sorted(taken))}")
    report = gate(quality_report(df, key, by), fail_on_nulls, fail_on_duplicates)
    verdicts = report.select(*[named(b).alias(f"_by_{i}") for i, b in enumerate(by)], VIOLATIONS)
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & named(b).eqNullSafe(F.col(f"_by_{i}"))
    routed = df.join(verdicts, same, "left").select(
        *[quoted(c) for c in df.columns], VIOLATIONS, (F.col(VIOLATIONS) == "").alias(_ACCEPTED)
    )
    counted = Observation()
    (
        routed.observe(counted, F.count_if(_ACCEPTED).alias("loaded"), F.count_if(~F.col(_ACCEPTED)).alias("quarantined"))
        .write.mode("overwrite")
        .partitionBy(_ACCEPTED)
        .parquet(f"{path}/run_id={run_id}")
    )
    return Routed(counted.get["loaded"], counted.get["quarantined"])


def _read(spark: SparkSession, path: str, accepted: bool) -> DataFrame:
    rows = spark.read.option("basePath", path).parquet(f"{path}/run_id=*")
    return rows.filter(F.col(_ACCEPTED) == accepted).drop(_ACCEPTED)


def read_loaded(spark: SparkSession, path: str) -> DataFrame:
    """The rows of batches that passed, of all runs, with their ``run_id``."""
    return _read(spark, path, True).drop(VIOLATIONS)


def read_quarantined(spark: SparkSession, path: str) -> DataFrame:
    """The rows that were set apart, with what their batch violates."""
    return _read(spark, path, False)
